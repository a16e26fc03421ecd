"""Ingest runs as whole-feed DataFrame jobs.

Standard run: clean the feed once, map, keep rows whose app exists, insert the
keys not yet stored.

Incremental run: the feed arrives in batches; each batch is cleaned on its own
and inserted with insert-or-ignore, so the result depends on batch
boundaries (an invalid first copy shadows a later valid copy only inside its
own batch).  Instead of a driver loop over batches, the whole run is one plan:

  1. ``row_number() over (batch_no, reviewId order by arrival_seq) = 1``
     — per-batch first copy;
  2. score gate;
  3. ``row_number() over (reviewId order by batch_no, arrival_seq) = 1``
     — the first batch to offer a valid copy wins, as sequential inserts do.

Both windows are hash-partitioned on the review id (plus batch), never on the
app, and both are ``= 1`` filters that Spark pre-limits before the shuffle.
The streaming form (``reviewlake.streaming.ingest``) runs the same steps per
micro-batch against the stored table and yields the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.operators import monitor as M
from reviewlake.operators.clean import clean_reviews
from reviewlake.operators.tables import accepted_by_fk, first_writer_wins, insert_new, map_reviews, orphans_by_fk


def bound_batches(raw_batched: DataFrame, max_batches: int | None) -> DataFrame:
    """The run's batch limit: only batches ``0 .. max_batches-1`` (0/None = all).

    Batches are numbered from 0 at the run's resume point, so the bound is a
    plain (pushed) filter.
    """
    if not max_batches:
        return raw_batched
    return raw_batched.where(F.col("batch_no") < F.lit(int(max_batches)))


def incremental_clean(raw_batched: DataFrame, as_of, time_col: str = "at") -> DataFrame:
    """Per-batch cleaned rows (steps 1-2)."""
    return clean_reviews(raw_batched, as_of, time_col=time_col, batch_col="batch_no")


def incremental_inserted(cleaned_batched: DataFrame) -> DataFrame:
    """Rows the sequential run inserts (step 3), still in cleaned form."""
    return first_writer_wins(cleaned_batched, "reviewId", ["batch_no", "arrival_seq"])


def incremental_reviews(raw_batched: DataFrame, as_of, run_ts, time_col: str = "at",
                        max_batches: int | None = None) -> DataFrame:
    """Stored rows of the incremental run, with the batch that inserted each
    (``max_batches``: 0/None = every batch)."""
    ins = incremental_inserted(incremental_clean(bound_batches(raw_batched, max_batches), as_of, time_col))
    return map_reviews(ins, run_ts, keep=["batch_no"])


def batch_metrics(raw_batched: DataFrame, cleaned_batched: DataFrame, inserted: DataFrame) -> DataFrame:
    """Per batch: fetched, cleaned, inserted, duplicates-or-existing.

    Three partial aggregations keyed by batch number, joined on it (one row
    per batch on each side).
    """
    f = raw_batched.groupBy("batch_no").agg(F.count(F.lit(1)).alias("fetched_count"))
    c = cleaned_batched.groupBy("batch_no").agg(F.count(F.lit(1)).alias("cleaned_count"))
    i = inserted.groupBy("batch_no").agg(F.count(F.lit(1)).alias("inserted_count"))
    j = f.join(c, "batch_no", "left").join(i, "batch_no", "left")
    cleaned = F.coalesce(F.col("cleaned_count"), F.lit(0))
    ins = F.coalesce(F.col("inserted_count"), F.lit(0))
    return j.select(
        "batch_no",
        "fetched_count",
        cleaned.cast("bigint").alias("cleaned_count"),
        ins.cast("bigint").alias("inserted_count"),
        F.greatest(cleaned - ins, F.lit(0)).cast("bigint").alias("duplicates_or_existing"),
        (cleaned == 0).alias("clean_empty"),
    )


def run_totals(metrics: DataFrame) -> DataFrame:
    """Run summary over the batch metrics: totals, status and the compatibility status."""
    a = metrics.agg(
        F.count(F.lit(1)).alias("batches_processed"),
        F.sum("fetched_count").cast("bigint").alias("total_reviews_fetched"),
        F.sum("cleaned_count").cast("bigint").alias("total_reviews_cleaned"),
        F.sum("inserted_count").cast("bigint").alias("total_reviews_inserted"),
        F.sum("duplicates_or_existing").cast("bigint").alias("total_duplicates_or_existing"),
    )
    return a.select(
        "*",
        M.run_status(F.coalesce(F.col("total_reviews_fetched"), F.lit(0))).alias("status"),
        M.reference_status(F.coalesce(F.col("total_reviews_inserted"), F.lit(0))).alias("reference_status"),
    )


def standard_run(raw: DataFrame, apps: DataFrame, existing: DataFrame, as_of, run_ts,
                 time_col: str = "at", incoming_rows: int | None = None) -> dict:
    """One standard run as one plan: clean -> map -> FK split -> insert-or-ignore.

    Returns the frames of the run: ``cleaned``, ``orphans`` (quarantined, app
    missing) and ``inserted`` (rows to append).  The app keys are broadcast
    behind the row check; the stored reviews are probed on the review id.
    """
    cleaned = clean_reviews(raw, as_of, time_col=time_col)
    mapped = map_reviews(cleaned, run_ts)
    accepted = accepted_by_fk(mapped, apps)
    return {
        "cleaned": cleaned,
        "orphans": orphans_by_fk(mapped, apps),
        "inserted": insert_new(existing, accepted, incoming_rows=incoming_rows),
    }


def standard_run_summary(raw: DataFrame, run: dict) -> DataFrame:
    """Counters of a standard run (fetched is always counted) and its status."""
    f = raw.agg(F.count(F.lit(1)).alias("n")).select(F.lit("fetched").alias("k"), "n")
    c = run["cleaned"].agg(F.count(F.lit(1)).alias("n")).select(F.lit("cleaned").alias("k"), "n")
    o = run["orphans"].agg(F.count(F.lit(1)).alias("n")).select(F.lit("orphans").alias("k"), "n")
    i = run["inserted"].agg(F.count(F.lit(1)).alias("n")).select(F.lit("inserted").alias("k"), "n")
    u = f.unionByName(c).unionByName(o).unionByName(i)
    # pivot of four one-row aggregates (a four-row frame)
    w = u.groupBy().pivot("k", ["fetched", "cleaned", "orphans", "inserted"]).agg(F.first("n"))
    fetched, cleaned, inserted = (F.coalesce(F.col(x), F.lit(0)).cast("bigint") for x in ("fetched", "cleaned", "inserted"))
    return w.select(
        fetched.alias("total_reviews_fetched"),
        cleaned.alias("total_reviews_cleaned"),
        F.coalesce(F.col("orphans"), F.lit(0)).cast("bigint").alias("total_orphans"),
        inserted.alias("total_reviews_inserted"),
        F.greatest(cleaned - inserted, F.lit(0)).cast("bigint").alias("total_duplicates_or_existing"),
        M.run_status(fetched).alias("status"),
        M.reference_status(inserted).alias("reference_status"),
    )
