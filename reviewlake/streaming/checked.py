"""The incremental run with the stored tables' promises.

The source is ``feed_batches`` (``reviewlake.streaming.source``): a micro-batch is a range of
batch numbers, read from the landing folders of these numbers.  Each one is a commit of the
ledger (``reviewlake.plans.ledger``), named by its batches and not by Spark's epoch, so that a
lost checkpoint cannot make two commits of one batch:

  clean per feed batch -> NOT NULL, score, foreign key, key among the stored ids ->
  rows, rejects, metrics and events of the commit -> append -> commit record

Reviews whose app is not stored are quarantined with their commit.  ``readmit`` replays exactly
those whose app has arrived since, in feed order, as a commit of its own.  A run that raises leaves
a failed history row with the stage it failed in; the next run first mends the
commit that was under way.

``max_batches`` bounds a run's last offset.  A batch that lands behind a processed one is refused
(``LateBatch``), because insert-or-ignore depends on feed order.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators import monitor as M
from reviewlake.operators.clean import clean_reviews, ts_literal
from reviewlake.operators.tables import BROADCAST_ROWS, REVIEW_COLUMNS, map_reviews, validate_reviews
from reviewlake.plans import ledger as L
from reviewlake.plans.jobs import record_run
from reviewlake.plans.store import stage_table
from reviewlake.session import drop_folder
from reviewlake.streaming.ingest import LANDING_SCHEMA, MICRO_BATCH_BYTES
from reviewlake.streaming.source import BatchNumbers, LateBatch, batches_per_trigger, landed_batches
from reviewlake.warehouse import ReviewWarehouse

METRICS = "run_id string, batch_no bigint, app_id string, fetched_count bigint, cleaned_count bigint, inserted_count bigint, orphan_count bigint"
EVENTS = "run_id string, batch_no bigint, event string, payload string"
RESOLVED = "quarantined string, batch_no bigint, arrival_seq bigint"
SKIPPED = ("existing_key", "duplicate_key")  # ignored as insert-or-ignore does, not rejected


def _schema(wh: ReviewWarehouse):
    return wh.reviews().schema


def _rejects_schema(wh: ReviewWarehouse) -> str:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(wh))
    return fields + ", batch_no bigint, arrival_seq bigint, reject_reason string"


class Run:
    """One run: what its micro-batches share, and the stage it is in."""

    def __init__(self, spark: SparkSession, landing: str, root: str, as_of, run_ts, run_id: str, time_col: str):
        self.spark, self.landing, self.root, self.as_of, self.run_ts, self.run_id, self.time_col = spark, landing, root.rstrip("/"), as_of, run_ts, run_id, time_col
        self.wh = ReviewWarehouse(spark, root)
        self.stage = "create_schema"

    def landed(self, numbers: list[int]) -> DataFrame:
        paths = [f"{self.landing}/batch_no={k}" for k in numbers]
        return self.spark.read.schema(LANDING_SCHEMA).option("basePath", self.landing).json(paths)

    def judge(self, mapped: DataFrame, stage: str, keep: list[str]) -> DataFrame:
        """``keep`` and the reject reason of every mapped row, against the key buckets and the live apps;
        told from the rows without their texts."""
        order = F.struct("batch_no", "arrival_seq").alias("__order")
        given = F.when(F.col("content").isNotNull(), F.lit("")).alias("content")
        facts = mapped.select(*dict.fromkeys(["review_id", "app_id", "score", *keep]), given, order)
        keys = L.stored_keys(self.spark, self.root, mapped)
        judged = validate_reviews(facts, keys, self.wh.apps(), "__order", incoming_rows=mapped.count())
        return stage_table(judged.select(*keep, "reject_reason"), stage)

    def commit(self, numbers: list[int]) -> None:
        """Takes one micro-batch in; a mended or repeated one ends in the same state."""
        name = f"{numbers[0]:012d}-{numbers[-1]:012d}"
        if L.is_committed(self.spark, self.root, name):
            return
        mended = L.is_prepared(self.spark, self.root, name)
        if not mended:
            work = f"{self.root}/_stage/{self.run_id}/{name}"
            self.stage = "fetch_reviews"
            raw = self.landed(numbers)
            fetched = raw.groupBy("batch_no", "app_id").agg(F.count("*").alias("fetched_count"))
            fetched = stage_table(fetched, f"{work}/fetched")
            self.stage = "clean_reviews"
            cleaned = clean_reviews(raw, self.as_of, time_col=self.time_col, batch_col="batch_no", bounded=True)
            staged = stage_table(cleaned.withColumn("__row", F.monotonically_increasing_id()), f"{work}/cleaned")
            mapped = map_reviews(staged, self.run_ts, keep=["batch_no", "arrival_seq", "__row"], capture=cleaned.columns)
            self.stage = "insert_reviews"
            judged = self.judge(mapped, f"{work}/judged", ["__row", "batch_no", "app_id"])
            reason = F.col("reject_reason")
            per = judged.groupBy("batch_no", "app_id").agg(
                F.count("*").alias("cleaned_count"), F.count_if(reason.isNull()).alias("inserted_count"),
                F.count_if(reason == "orphan_app").alias("orphan_count"))
            metrics = fetched.join(per, ["batch_no", "app_id"], "left").fillna(0, ["cleaned_count", "inserted_count", "orphan_count"])
            metrics = stage_table(metrics.withColumn("run_id", F.lit(self.run_id)), f"{work}/metrics")
            by_batch = metrics.groupBy("batch_no").agg(*[F.sum(c).alias(c) for c in ("fetched_count", "cleaned_count", "inserted_count")])
            events = M.batch_events(by_batch).select(F.lit(self.run_id).alias("run_id"), "batch_no", "event", "payload")
            keep = [*REVIEW_COLUMNS, "batch_no", "arrival_seq", "reject_reason"]
            few = judged.count() <= BROADCAST_ROWS

            def told(which: DataFrame) -> DataFrame:
                which = which.select("__row", "reject_reason")
                return mapped.join(F.broadcast(which) if few else which, "__row")

            L.prepare(self.spark, self.root, name, {
                "rows": told(judged.where(reason.isNull())).select(*REVIEW_COLUMNS),
                "rejects": told(judged.where(reason.isNotNull() & ~reason.isin(*SKIPPED))).select(*keep),
                "metrics": metrics, "events": events,
            })
            drop_folder(self.spark, work)
        self.stage = "insert_reviews"
        L.finish(self.spark, self.root, name, self.run_id, "batches", numbers, _schema(self.wh), mended)
        self.stage = "fetch_reviews"

    def drain(self, max_batches: int | None, step: int | None) -> None:
        spark, root = self.spark, self.root
        self.stage = "fetch_reviews"
        there = landed_batches(spark, self.landing)
        # a commit under way when a run died ends as it began, however large this run's micro-batches are
        for numbers in L.open_batches(spark, root):
            self.commit(numbers)
        done = {k for r in L.commits(spark, root).select("batches").collect() for k in r.batches}
        after = max(done, default=-1)
        if late := [k for k in there if k <= after and k not in done]:
            raise LateBatch(f"batches {late[:10]} landed behind batch {after}")
        todo = [k for k in there if k > after][: max_batches or None]
        step = step or batches_per_trigger(spark, self.landing, len(there), MICRO_BATCH_BYTES)
        # also without new batches: the checkpoint may hold a micro-batch that was not finished
        spark.dataSource.register(BatchNumbers)
        src = spark.readStream.format("feed_batches").options(after=after, last=todo[-1] if todo else after, step=step).load()
        landed = set(there)

        def take(df: DataFrame, _epoch: int) -> None:
            numbers = [r.batch_no for r in df.orderBy("batch_no").collect()]  # at most ``step`` numbers
            numbers = [k for k in numbers if k in landed]
            if numbers:
                self.commit(numbers)

        q = src.writeStream.foreachBatch(take).option("checkpointLocation", f"{root}/_checkpoints/feed_batches").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()


def checked_incremental_job(
    spark: SparkSession, landing: str, root: str, as_of, run_ts, run_id: str, raw_apps: DataFrame | None = None,
    max_batches: int | None = None, step: int | None = None, time_col: str = "at",
) -> DataFrame:
    """One incremental run with history; ``max_batches``: 0 or None for all that has landed.

    ``step``: batches a micro-batch; None for as many as make up ``MICRO_BATCH_BYTES``.

    Returns the run's history rows, one per app.  If the run raises, a failed row per app
    with the stage and the message is recorded first.
    """
    started = time.perf_counter()
    run = Run(spark, landing, root, as_of, run_ts, run_id, time_col)
    error = None
    try:
        if raw_apps is not None:
            run.wh.upsert_apps(raw_apps, run_ts, version=run_id)
            readmit(spark, root, run_ts, run_id)
        run.drain(max_batches, step)
    except Exception as e:  # recorded, then raised again
        error = e
    m = L.part(spark, root, "metrics", METRICS).where(F.col("run_id") == run_id)
    counts = m.groupBy("app_id").agg(
        F.sum("fetched_count").alias("fetched"), F.sum("cleaned_count").alias("cleaned"),
        F.sum("inserted_count").alias("inserted"), F.count_distinct("batch_no").alias("batches"))
    counts = run.wh.apps().select("app_id").join(counts, "app_id", "full_outer")
    if error is not None and counts.isEmpty():  # a run without any app still leaves its row
        counts = spark.createDataFrame([(None, 0, 0, 0, 0)], "app_id string, fetched bigint, cleaned bigint, inserted bigint, batches bigint")
    rows = record_run(
        spark, root, counts, run_id, "incremental", run_ts, time.perf_counter() - started, f"{root}/_stage/{run_id}",
        error=(run.stage, f"{type(error).__name__}: {error}"[:500]) if error else None, fetch_app_info=raw_apps is not None)
    if error is not None:
        raise error
    return rows


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """Rejected rows of all commits, with reason and commit; readmitted ones are gone."""
    wh = ReviewWarehouse(spark, root)
    q = L.part(spark, root, "rejects", _rejects_schema(wh))
    done = L.part(spark, root, "resolved", RESOLVED).select(F.col("quarantined").alias("commit"), "batch_no", "arrival_seq")
    return q.join(done, ["commit", "batch_no", "arrival_seq"], "left_anti")


def readmit(spark: SparkSession, root: str, run_ts, run_id: str) -> int:
    """Replays the quarantined reviews whose app is stored now; returns the rows inserted.

    Of several copies the first in feed order goes in, unless its id has been stored since.
    """
    name = f"readmit-{run_id}"
    run = Run(spark, "", root, None, run_ts, run_id, "")
    if L.is_committed(spark, root, name):
        return 0
    mended = L.is_prepared(spark, root, name)
    if not mended:
        work = f"{root}/_stage/{run_id}/{name}"
        waiting = quarantined(spark, root).where("reject_reason = 'orphan_app'")
        arrived = waiting.join(run.wh.apps().select("app_id"), "app_id", "left_semi")
        # their texts are read again for those that go in; an id comes once in a batch
        given = F.when(F.col("content").isNotNull(), F.lit("")).alias("content")
        facts = stage_table(arrived.select("commit", "batch_no", "arrival_seq", "review_id", "app_id", "score", given), f"{work}/arrived")
        if facts.isEmpty():
            return 0
        by = ["commit", "batch_no", "review_id"]
        judged = run.judge(facts, f"{work}/judged", by)
        into = judged.where("reject_reason IS NULL").select(*by)
        ts = ts_literal(run_ts)
        new = waiting.join(F.broadcast(into) if into.count() <= BROADCAST_ROWS else into, by, "left_semi")
        new = new.withColumns({"created_at": ts, "updated_at": ts})
        payload = F.to_json(F.struct(F.count("*").cast("string").alias("readmitted_count")))
        events = facts.groupBy("batch_no").agg(payload.alias("payload"))
        L.prepare(spark, root, name, {
            "rows": new.select(*REVIEW_COLUMNS),
            "resolved": facts.select(F.col("commit").alias("quarantined"), "batch_no", "arrival_seq"),
            "events": events.select(F.lit(run_id).alias("run_id"), "batch_no", F.lit("orphans_readmitted").alias("event"), "payload"),
        })
        drop_folder(spark, work)
    L.finish(spark, root, name, run_id, "readmit", [], _schema(run.wh), mended)
    return L.commits(spark, root).where(F.col("commit") == name).select("rows").collect()[0].rows


def events(spark: SparkSession, root: str) -> DataFrame:
    """The stored events of all commits."""
    return L.part(spark, root, "events", EVENTS)


def metrics(spark: SparkSession, root: str) -> DataFrame:
    """The stored counters per (run, batch, app) of all commits."""
    return L.part(spark, root, "metrics", METRICS)
