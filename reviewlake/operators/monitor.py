"""Run monitoring over the run-history table.

The source enriches one finished run at a time by scanning its history file
backwards.  Here the whole history is enriched in one window pass: the
previous run of the same (app, mode) is ``lag`` over the history in finish
order — one shuffle on (app_id, mode), whose rows are run summaries (a few per
app and day), not reviews.

Fixed values:
  status in {running, success, failed}; error stages create_schema,
  fetch_reviews, clean_reviews, insert_reviews, unhandled_exception;
  anomaly names, in report order: run_failed, material_fetched_drop,
  material_inserted_drop, zero_inserted_after_nonzero_baseline,
  zero_fetched_after_nonzero_baseline; a material drop is a change <= -80 %.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

MATERIAL_DROP_PCT = -80.0

MONITORING_TYPE = T.StructType([
    T.StructField("previous_run_id", T.StringType()),
    T.StructField("previous_status", T.StringType()),
    T.StructField("fetched_change_pct", T.DoubleType()),
    T.StructField("inserted_change_pct", T.DoubleType()),
    T.StructField("material_change_detected", T.BooleanType()),
    T.StructField("anomalies", T.ArrayType(T.StringType())),
])

HISTORY_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("db_path", T.StringType()),
    T.StructField("start_time_utc", T.TimestampNTZType()),
    T.StructField("end_time_utc", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("target_reviews", T.LongType()),
    T.StructField("fetch_app_info", T.BooleanType()),
    T.StructField("batches_processed", T.LongType()),
    T.StructField("total_reviews_fetched", T.LongType()),
    T.StructField("total_reviews_cleaned", T.LongType()),
    T.StructField("total_reviews_inserted", T.LongType()),
    T.StructField("total_duplicates_or_existing", T.LongType()),
    T.StructField("error_stage", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

HISTORY_WITH_MONITORING = T.StructType(HISTORY_SCHEMA.fields + [T.StructField("monitoring", MONITORING_TYPE)])


def _by_app_mode():
    return Window.partitionBy("app_id", "mode").orderBy(F.col("end_time_utc").asc(), F.col("run_id").asc())


def previous_run(history: DataFrame) -> DataFrame:
    """Each run with the id, status and counts of the previous run of its (app, mode).

    Status is ignored when choosing the baseline, so a failed run can be it.
    """
    w = _by_app_mode()
    return history.select(
        "*",
        F.lag("run_id").over(w).alias("previous_run_id"),
        F.lag("status").over(w).alias("previous_status"),
        F.lag("total_reviews_fetched").over(w).alias("previous_fetched"),
        F.lag("total_reviews_inserted").over(w).alias("previous_inserted"),
    )


def change_pct(cur, prev):
    """% change rounded to 2 digits; null when there is no positive baseline."""
    return F.when(prev > 0, F.round(((cur - prev).cast("double") / prev.cast("double")) * F.lit(100.0), 2))


def run_monitoring(history: DataFrame) -> DataFrame:
    """Previous run, % changes and anomaly flags for every run in the history."""
    return judge_runs(previous_run(history))


def judge_runs(p: DataFrame) -> DataFrame:
    """% changes and anomaly flags of runs that carry their previous run's columns."""
    fetched = F.coalesce(F.col("total_reviews_fetched"), F.lit(0))
    inserted = F.coalesce(F.col("total_reviews_inserted"), F.lit(0))
    has_prev = F.col("previous_run_id").isNotNull()
    fprev = F.coalesce(F.col("previous_fetched"), F.lit(0))
    iprev = F.coalesce(F.col("previous_inserted"), F.lit(0))
    p = p.withColumn("fetched_change_pct", F.when(has_prev, change_pct(fetched, fprev)))
    p = p.withColumn("inserted_change_pct", F.when(has_prev, change_pct(inserted, iprev)))
    flags = F.array(
        F.when(F.col("status") == F.lit("failed"), F.lit("run_failed")),
        F.when(has_prev & (F.col("fetched_change_pct") <= MATERIAL_DROP_PCT), F.lit("material_fetched_drop")),
        F.when(has_prev & (F.col("inserted_change_pct") <= MATERIAL_DROP_PCT), F.lit("material_inserted_drop")),
        F.when(has_prev & (inserted == 0) & (iprev > 0), F.lit("zero_inserted_after_nonzero_baseline")),
        F.when(has_prev & (fetched == 0) & (fprev > 0), F.lit("zero_fetched_after_nonzero_baseline")),
    )
    p = p.withColumn("anomalies", F.filter(flags, lambda x: x.isNotNull()))
    return p.withColumn("material_change_detected", F.size("anomalies") > 0)


def with_monitoring_struct(enriched: DataFrame) -> DataFrame:
    """History rows with the nested ``monitoring`` record of the run summary."""
    m = F.struct(
        F.col("previous_run_id"), F.col("previous_status"), F.col("fetched_change_pct"),
        F.col("inserted_change_pct"), F.col("material_change_detected"), F.col("anomalies"),
    ).cast(MONITORING_TYPE)
    return enriched.select(*[F.col(f.name) for f in HISTORY_SCHEMA.fields], m.alias("monitoring"))


def latest_runs(history: DataFrame) -> DataFrame:
    """The last finished run per (app, mode) — the ``latest`` report."""
    w = Window.partitionBy("app_id", "mode").orderBy(F.col("end_time_utc").desc(), F.col("run_id").desc())
    return history.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def run_status(total_fetched, error_stage=None):
    """Outcome of an incremental run: failed iff nothing was fetched."""
    return F.when(total_fetched == 0, F.lit("failed")).otherwise(F.lit("success"))


def reference_status(total_inserted):
    """Compatibility flag: the source marks a standard run failed when it inserted nothing."""
    return F.when(total_inserted > 0, F.lit("success")).otherwise(F.lit("failed"))


def run_events(history: DataFrame) -> DataFrame:
    """Structured events of each run: ``run_started`` then ``run_completed`` or
    ``run_failed``; extras as a JSON payload."""
    ok = F.col("status") == F.lit("success")
    started = F.struct(
        F.lit(0).alias("seq"), F.lit("run_started").alias("event"),
        F.to_json(F.create_map(F.lit("target_reviews"), F.col("target_reviews").cast("string"))).alias("payload"),
    )
    ended = F.struct(
        F.lit(1).alias("seq"),
        F.when(ok, F.lit("run_completed")).otherwise(F.lit("run_failed")).alias("event"),
        F.to_json(F.create_map(
            F.lit("total_reviews_fetched"), F.col("total_reviews_fetched").cast("string"),
            F.lit("total_reviews_inserted"), F.col("total_reviews_inserted").cast("string"),
            F.lit("error_stage"), F.col("error_stage"),
        )).alias("payload"),
    )
    e = history.select("run_id", "mode", "app_id", F.explode(F.array(started, ended)).alias("e"))
    return e.select("run_id", "mode", "app_id", "e.seq", "e.event", "e.payload")


def batch_events(metrics: DataFrame) -> DataFrame:
    """Per-batch events of an incremental run: ``batch_processed`` with the
    counts, or ``batch_clean_empty`` when cleaning left nothing; plus the
    compatibility warning ``batch_insert_failed`` when rows survived cleaning
    but none was inserted (the source's success rule is "inserted > 0")."""
    empty = F.col("cleaned_count") == 0
    payload = F.to_json(F.create_map(
        F.lit("fetched_count"), F.col("fetched_count").cast("string"),
        F.lit("cleaned_count"), F.col("cleaned_count").cast("string"),
        F.lit("inserted_count"), F.col("inserted_count").cast("string"),
    ))
    events = F.array(
        F.when(empty, F.lit("batch_clean_empty")).otherwise(F.lit("batch_processed")),
        F.when(~empty & (F.col("inserted_count") == 0), F.lit("batch_insert_failed")),
    )
    e = metrics.select("batch_no", F.explode(F.filter(events, lambda x: x.isNotNull())).alias("event"),
                       payload.alias("payload"))
    return e
