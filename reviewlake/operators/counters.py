"""Run counters from one narrow aggregate of the feed.

The counters of the cleaner and of a run depend on three facts per review id: how many
copies arrived, and the score and app of the first.  One aggregate by id yields them; no
row is joined back, no window is used and no text is read.  A hot id is a counter per map
task, and so are the rows without an id or score, which share the null key.

``order_col`` is unique per id (as in ``clean_reviews``); an empty feed counts 0 everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.coerce import to_double
from reviewlake.operators import monitor as M


def per_id(raw: DataFrame, by: list[str] | None = None, order_col: str = "arrival_seq", keep: list[str] | None = None) -> DataFrame:
    """(by..., id, n, valid, keep...): copies of each id, whether the first one's score is 1..5,
    and the first one's ``keep`` columns.  Rows that lack an id or a score are the null id's copies."""
    by, keep = by or [], keep or []
    ok = F.col("reviewId").isNotNull() & F.col("score").isNotNull()
    valid = F.coalesce(to_double(F.col("score")).between(1.0, 5.0), F.lit(False))
    first = F.struct(F.col(order_col).alias("at"), valid.alias("valid"), *[F.col(c) for c in keep])
    rows = raw.select(*by, F.when(ok, F.col("reviewId")).alias("id"), F.when(ok, first).alias("first"))
    g = rows.groupBy(*by, "id").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first"))
    return g.select(*by, "id", "n", F.coalesce(F.col("first.valid"), F.lit(False)).alias("valid"), *[F.col(f"first.{c}").alias(c) for c in keep])


def _sum(col, name: str):
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint").alias(name)


def cleaning_counts(raw: DataFrame, by: list[str] | None = None, order_col: str = "arrival_seq") -> DataFrame:
    """The counters of ``cleaning_stats``: one scan, one shuffle of one row per id and map task."""
    by = by or []
    p = per_id(raw, by, order_col)
    has = F.col("id").isNotNull()
    return p.groupBy(*by).agg(
        _sum(F.col("n"), "total_records"),
        F.count_if(F.col("valid")).alias("valid_records"),
        _sum(F.col("n") - F.col("valid").cast("bigint"), "invalid_records"),
        _sum(F.when(has, F.col("n") - 1), "duplicates_removed"),
        _sum(F.when(~has, F.col("n")), "missing_required_removed"),
        F.count_if(has & ~F.col("valid")).alias("invalid_score_removed"),
    )


def batch_counts(raw_batched: DataFrame, order_col: str = "arrival_seq") -> DataFrame:
    """The counters of ``batch_metrics`` in one scan.  ``batch_no`` is never null.

    An id is inserted by the first batch that offers a valid copy.  Each (batch, id) adds its
    counts under its batch and, if valid, its batch under its id; the second aggregate by
    (batch or id) sums the ones and takes the least of the others, so that an id found
    in every batch stays a partial minimum.
    """
    p = per_id(raw_batched, ["batch_no"], order_col)
    none = F.lit(None)
    of_batch = F.struct(
        F.col("batch_no").alias("b"), none.cast("string").alias("id"), F.col("n"),
        F.col("valid").cast("bigint").alias("c"), none.cast("bigint").alias("first"))
    of_id = F.struct(
        none.cast("bigint").alias("b"), F.col("id").cast("string").alias("id"), F.lit(0).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("c"), F.col("batch_no").cast("bigint").alias("first"))
    p = p.withColumn("batch_no", F.col("batch_no").cast("bigint"))
    both = p.select(F.explode(F.when(F.col("valid"), F.array(of_batch, of_id)).otherwise(F.array(of_batch))).alias("x")).select("x.*")
    g = both.groupBy("b", "id").agg(F.sum("n").alias("n"), F.sum("c").alias("c"), F.min("first").alias("first"))
    m = g.groupBy(F.coalesce("b", "first").alias("batch_no")).agg(
        F.sum("n").alias("fetched_count"), F.sum("c").alias("cleaned_count"), F.count("first").alias("inserted_count"))
    return m.select(
        F.col("batch_no").cast(raw_batched.schema["batch_no"].dataType).alias("batch_no"),
        "fetched_count", "cleaned_count", "inserted_count",
        (F.col("cleaned_count") - F.col("inserted_count")).alias("duplicates_or_existing"),
        (F.col("cleaned_count") == 0).alias("clean_empty"),
    )


def standard_counts(raw: DataFrame, apps: DataFrame, existing: DataFrame, order_col: str = "arrival_seq") -> DataFrame:
    """The counters of ``standard_run_summary``: the feed is scanned once, and one narrow row
    per id meets the app keys and the stored keys."""
    p = per_id(raw, order_col=order_col, keep=["app_id"])
    known = apps.select("app_id").distinct().withColumn("known", F.lit(True))
    stored = existing.select(F.col("review_id").alias("id")).distinct().withColumn("stored", F.lit(True))
    j = p.join(stored, "id", "left").join(known, "app_id", "left")
    ok = F.col("valid") & F.col("known").isNotNull()
    fetched, cleaned, inserted = F.col("total_reviews_fetched"), F.col("total_reviews_cleaned"), F.col("total_reviews_inserted")
    t = j.agg(
        _sum(F.col("n"), "total_reviews_fetched"),
        F.count_if(F.col("valid")).alias("total_reviews_cleaned"),
        F.count_if(F.col("valid") & F.col("known").isNull()).alias("total_orphans"),
        F.count_if(ok & F.col("stored").isNull()).alias("total_reviews_inserted"),
    )
    return t.select(
        "*", (cleaned - inserted).alias("total_duplicates_or_existing"),
        M.run_status(fetched).alias("status"), M.reference_status(inserted).alias("reference_status"),
    )
