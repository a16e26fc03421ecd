"""reviewlake — a Spark-native review-analytics engine.

Raw app metadata and user reviews are cleaned, typed and merged into curated
tables with DataFrame operations only; read, profiling and run-monitoring
queries are lazy DataFrames that Catalyst plans and Spark runs in parallel.

Layout:
  functions/  column expressions (text, numbers, time) — no Python UDFs
  sources/    fixture views over the driver tables, files, landing feeds
  operators/  cleaning, table merges, reads, profiling, monitoring
  plans/      composite jobs (standard run, incremental run, join helpers)
  streaming/  Structured Streaming ingest (foreachBatch over the same ops)
"""

__all__ = ["session"]
