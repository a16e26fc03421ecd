"""Raw feed views derived from the driver tables (the engine's test input).

``raw_reviews`` turns ``events`` (+ ``documents`` prose) into a dirty review
feed with every trap the cleaner must handle: every document is the text of some review, whole;
one that only meets events whose text is replaced comes once more in a review of its own, after
the events.  ``raw_apps`` turns every ``part`` row into app metadata.  The same derivation exists as SQL text in
``reviewlake.oracle_sql`` for the independent DuckDB check.

Fixed values (the dirt patterns, chosen once for the fixture):
  review id: null when event_id % 97 = 0; copy of the id 600 rows back when
  event_id % 26 = 0 and event_id > 600; copy of the previous id when
  event_id % 13 = 0; else 'r' || event_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _when_chain(*pairs, otherwise):
    expr = None
    for cond, val in pairs:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(otherwise)


# An event whose id is divisible by one of these has its text replaced.
TEXT_DIRT = (71, 70, 69, 31, 37, 29, 23, 19, 17, 16)


def _shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with the document each one shows, and the reviews of the documents that none shows.

    Such a review is the event of the document's own number, moved behind the last event;
    ``plain`` marks it: its text is not replaced.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    ids = table(spark, sf_dir, "documents").select("doc_id")
    # the numbers of documents and events are read from the files' metadata
    n, behind = max(ids.count(), 1), e.count()
    clean = e.where(" AND ".join(f"event_id % {m} <> 0" for m in TEXT_DIRT)).select((F.col("event_id") % n).alias("doc_id")).distinct()
    hidden = ids.join(clean, "doc_id", "left_anti").withColumnRenamed("doc_id", "event_id")
    own = e.join(hidden, "event_id", "left_semi")
    shown = e.select("*", (F.col("event_id") % n).alias("shows"), F.lit(False).alias("plain"))
    return shown.union(own.select((F.col("event_id") + behind).alias("event_id"), *e.columns[1:], F.col("event_id"), F.lit(True)))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty review feed, one row per event and per document no event shows; ``arrival_seq`` is the feed order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("doc_text"))
    # the join is left to the optimiser, which shuffles both sides when the texts are large
    e = _shown(spark, sf_dir)
    j = e.join(docs, e.shows == docs.doc_id, "inner")

    eid, uid = F.col("event_id"), F.col("user_id")
    s = lambda x: x.cast("string")
    review_id = _when_chain(
        (eid % 97 == 0, F.lit(None).cast("string")),
        ((eid % 26 == 0) & (eid > 600), F.concat(F.lit("r"), s(eid - 600))),
        (eid % 13 == 0, F.concat(F.lit("r"), s(eid - 1))),
        otherwise=F.concat(F.lit("r"), s(eid)),
    )
    user_name = _when_chain(
        (uid % 11 == 0, F.lit(None).cast("string")),
        (uid % 11 == 1, F.lit("nan")),
        (uid % 11 == 2, F.lit("  ")),
        otherwise=F.concat(F.lit(" user"), s(uid), F.lit(" ")),
    )
    score = _when_chain(
        (eid % 41 == 0, F.lit(None).cast("string")),
        (eid % 43 == 0, F.lit("bad")),
        (eid % 47 == 0, F.lit("0.6")),
        (eid % 53 == 0, F.lit("5.4")),
        (eid % 59 == 0, F.lit("4.5")),
        (eid % 61 == 0, F.lit("2.5")),
        (eid % 67 == 0, F.lit(" 3 ")),
        otherwise=s(F.lit(1) + uid % 5),
    )
    content = _when_chain(
        (F.col("plain"), F.concat(F.lit(" "), F.col("doc_text"), F.lit(" "))),
        (eid % 71 == 0, F.lit(None).cast("string")),
        (eid % 70 == 0, F.lit(" ")),
        (eid % 69 == 0, F.lit("nan")),
        (eid % 31 == 0, F.lit("很好用的应用")),
        (eid % 37 == 0, F.lit("Отличное приложение")),
        (eid % 29 == 0, F.lit("تطبيق رائع جدا")),
        (eid % 23 == 0, F.lit("Great app 😀🚀")),
        (eid % 19 == 0, F.lit("ñandú àéîõü ok")),
        (eid % 17 == 0, F.lit("50% off_a\\b")),
        (eid % 16 == 0, F.lit("\u00a0two\u3000words\u00a0")),
        otherwise=F.concat(F.lit(" "), F.col("doc_text"), F.lit(" ")),
    )
    at_text = _when_chain(
        (eid % 73 == 0, F.lit("garbage")),
        (eid % 79 == 0, F.lit(None).cast("string")),
        otherwise=s(F.col("ts")),
    )
    thumbs = _when_chain(
        (uid % 9 == 0, F.lit(None).cast("string")),
        (uid % 9 == 1, F.lit("n/a")),
        otherwise=s(uid % 50),
    )
    version = F.when(uid % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("1."), s(uid % 20))
    )
    return j.select(
        eid.alias("arrival_seq"),
        F.concat(F.lit("com."), F.col("event_type")).alias("app_id"),
        review_id.alias("reviewId"),
        user_name.alias("userName"),
        score.alias("score"),
        content.alias("content"),
        at_text.alias("at_text"),
        thumbs.alias("thumbsUpCount"),
        version.alias("reviewCreatedVersion"),
        F.lit(None).cast("string").alias("replyContent"),
        F.lit(None).cast("string").alias("repliedAt"),
        F.col("props").alias("extra"),
    )


def _apps_from_parts(spark: SparkSession, sf_dir: str, skip_type: str, key_offset: int, last_updated: str) -> DataFrame:
    """One app per ``part`` row.  The event types (except ``skip_type``), numbered in name
    order, name the parts ``key_offset + number``; every other part is an app of its own,
    without reviews in the feed.  The numbering is a window over the distinct types only.
    """
    types = (
        table(spark, sf_dir, "events").select("event_type")
        .where(F.col("event_type") != F.lit(skip_type)).distinct()
    )
    t = types.withColumn("k", (F.row_number().over(Window.orderBy("event_type")) + F.lit(key_offset)).cast("bigint"))
    p = table(spark, sf_dir, "part")
    j = p.join(t, p.p_partkey == t.k, "left")
    return j.select(
        F.concat(F.lit("com."), F.coalesce("event_type", F.concat(F.lit("part"), F.col("p_partkey").cast("string")))).alias("appId"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("developer"),
        F.col("p_type").alias("genre"),
        F.col("p_size").cast("string").alias("score"),
        (F.col("p_partkey") * 100).cast("string").alias("ratings"),
        F.lit("Jan 20, 2026").alias("released"),
        F.lit(last_updated).alias("lastUpdatedOn"),
        F.col("p_retailprice").cast("string").alias("price"),
    )


def raw_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One app per part; four of them are those of the feed (its event types except ``error``)."""
    return _apps_from_parts(spark, sf_dir, "error", 0, "2026-01-20 10:30:00")


def with_batch_no(raw: DataFrame, batch_rows: int = 500) -> DataFrame:
    """Slice the feed into batches of ``batch_rows`` consecutive arrival numbers."""
    return raw.withColumn("batch_no", F.floor(F.col("arrival_seq") / F.lit(batch_rows)).cast("bigint"))


def raw_apps_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later app-metadata pull: every event type except ``view`` (so ``error``
    is new and ``view`` is untouched), numbered in name order and matched to
    the ``part`` rows 10 keys further on (changed titles, scores, prices); every
    other part comes again under its own name."""
    return _apps_from_parts(spark, sf_dir, "view", 10, "2026-01-25T08:00:00Z")


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run summary per app and feed day, derived from the review feed.

    mode: ``incremental`` for com.view, else ``standard``.  The day of month
    scales the counts: x0 when divisible by 7 (an empty, failed run), x1 when
    divisible by 5 (a material drop), else x20.
    """
    from reviewlake.functions.coerce import to_double, to_timestamp_ntz

    r = raw_reviews(spark, sf_dir).select(
        "app_id", "reviewId",
        to_timestamp_ntz("at_text").alias("at_ts"),
        to_double("score").between(1.0, 5.0).alias("ok"),
    ).where(F.col("at_ts").isNotNull())
    g = r.groupBy("app_id", F.to_date("at_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("ok")).alias("n_ok"),
        F.count_distinct(F.when(F.col("ok"), F.col("reviewId"))).alias("n_new"),
    )
    dom = F.dayofmonth("day")
    factor = F.when(dom % 7 == 0, F.lit(0)).when(dom % 5 == 0, F.lit(1)).otherwise(F.lit(20))
    mode = F.when(F.col("app_id") == F.lit("com.view"), F.lit("incremental")).otherwise(F.lit("standard"))
    start = F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 2 HOURS")
    fetched = (F.col("n") * factor).cast("bigint")
    cleaned = (F.col("n_ok") * factor).cast("bigint")
    inserted = (F.col("n_new") * factor).cast("bigint")
    failed = fetched == 0
    return g.select(
        F.concat_ws("-", F.col("app_id"), mode, F.date_format("day", "yyyyMMdd")).alias("run_id"),
        mode.alias("mode"),
        F.col("app_id"),
        F.lit("warehouse/reviews").alias("db_path"),
        start.alias("start_time_utc"),
        F.timestamp_add("SECOND", F.col("n"), start).alias("end_time_utc"),
        F.col("n").cast("double").alias("duration_seconds"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.lit(None).cast("bigint").alias("target_reviews"),
        F.lit(True).alias("fetch_app_info"),
        F.when(failed, F.lit(0)).otherwise(F.ceil(F.col("n") / F.lit(100))).cast("bigint").alias("batches_processed"),
        fetched.alias("total_reviews_fetched"),
        cleaned.alias("total_reviews_cleaned"),
        inserted.alias("total_reviews_inserted"),
        F.greatest(cleaned - inserted, F.lit(0)).cast("bigint").alias("total_duplicates_or_existing"),
        F.when(failed, F.lit("fetch_reviews")).alias("error_stage"),
        F.when(failed, F.lit("No reviews fetched")).alias("error_message"),
    )
