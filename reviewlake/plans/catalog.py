"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through the fixture views) in full and
returns a lazy DataFrame.  Parameters (as-of time, run time, load cutoff,
batch size, app ids, keywords) are fixed here and mirrored in the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import coerce as C
from reviewlake.functions import text as T
from reviewlake.functions import timeparts as TP
from reviewlake.operators import clean as CL
from reviewlake.operators import counters as CN
from reviewlake.operators import monitor as M
from reviewlake.operators import profile as P
from reviewlake.operators import reads as R
from reviewlake.operators import tables as TB
from reviewlake.plans import ingest as IG
from reviewlake.plans import jobs as JB
from reviewlake.plans import store as ST
from reviewlake.session import scratch_dir
from reviewlake.sources import files as FL
from reviewlake.streaming import checked as CK
from reviewlake.streaming import ingest as SI
from reviewlake.streaming import source as SRC
from reviewlake.warehouse import ReviewWarehouse
from reviewlake.sources import feed as FD
from reviewlake.sources import fixture as FX

AS_OF = "2024-02-01 00:00:00"
RUN_TS = "2024-02-01 06:00:00"
RUN_TS2 = "2024-02-02 06:00:00"
CUTOFF = "2024-01-16 00:00:00"
BATCH_ROWS = 500
TIME_COL = "at_text"


# ---------------------------------------------------------------- derived frames
def raw(spark, d) -> DataFrame:
    return FX.raw_reviews(spark, d)


def typed(spark, d) -> DataFrame:
    """Raw feed with coerced score/time/thumbs for data-quality profiling."""
    return raw(spark, d).select(
        "*",
        C.to_double("score").alias("score_num"),
        C.to_timestamp_ntz(TIME_COL).alias("at_ts"),
        C.to_double("thumbsUpCount").alias("thumbs_num"),
    )


def clean(spark, d) -> DataFrame:
    return CL.clean_reviews(raw(spark, d), AS_OF, time_col=TIME_COL)


def reviews_full(spark, d) -> DataFrame:
    return TB.map_reviews(clean(spark, d), RUN_TS)


def reviews(spark, d) -> DataFrame:
    """The curated reviews table (without the JSON capture column)."""
    return reviews_full(spark, d).drop("raw_data")


def apps_full(spark, d) -> DataFrame:
    return TB.map_apps(CL.clean_apps(FX.raw_apps(spark, d)), RUN_TS)


def apps(spark, d) -> DataFrame:
    return apps_full(spark, d).drop("raw_data")


def no_raw(df: DataFrame) -> DataFrame:
    return df.drop("raw_data") if "raw_data" in df.columns else df


# ---------------------------------------------------------------- queries
Q: dict = {}


def q(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# scans, cleaning, expressions
@q("raw_scan")
def _(spark, d):
    return raw(spark, d)


@q("clean_reviews")
def _(spark, d):
    return clean(spark, d)


@q("dedupe_first")
def _(spark, d):
    r = raw(spark, d).where(F.col("reviewId").isNotNull() & F.col("score").isNotNull())
    return TB.first_writer_wins(r, "reviewId", ["arrival_seq"]).select("reviewId", "arrival_seq", "score")


@q("cleaning_stats")
def _(spark, d):
    return CN.cleaning_counts(raw(spark, d))


@q("clean_apps")
def _(spark, d):
    return CL.clean_apps(FX.raw_apps(spark, d))


@q("word_counts")
def _(spark, d):
    return clean(spark, d).select("reviewId", T.word_count("content").alias("word_count"))


@q("text_normalized")
def _(spark, d):
    return raw(spark, d).select(
        "arrival_seq",
        T.clean_text("userName", blank_to_null=True).alias("user_name_clean"),
        T.clean_text(F.coalesce(F.col("content"), F.lit("")), blank_to_null=False).alias("content_clean"),
        T.clean_text("content", blank_to_null=True).alias("content_or_null"),
    )


@q("script_class")
def _(spark, d):
    return clean(spark, d).select("reviewId", T.script_class("content").alias("script"))


@q("has_emoji")
def _(spark, d):
    return clean(spark, d).select("reviewId", T.has_emoji("content").alias("has_emoji"))


@q("coerce_numeric")
def _(spark, d):
    t = typed(spark, d)
    return t.select("arrival_seq", "score_num", C.round_half_even_int("score_num").alias("score_rounded"), "thumbs_num")


@q("coerce_timestamp")
def _(spark, d):
    return typed(spark, d).select("arrival_seq", "at_ts")


@q("date_parts")
def _(spark, d):
    t = typed(spark, d).where(F.col("at_ts").isNotNull())
    return t.select(
        "arrival_seq", TP.day_of("at_ts").alias("review_day"), TP.day_text("at_ts").alias("review_date"),
        TP.weekday_name("at_ts").alias("weekday"), TP.hour_of("at_ts").alias("hour"),
    )


# ratings
@q("rating_distribution")
def _(spark, d):
    return P.rating_distribution(clean(spark, d))


@q("rating_distribution_filled")
def _(spark, d):
    return P.rating_distribution_filled(spark, typed(spark, d), "score_num")


@q("rating_moments")
def _(spark, d):
    return P.rating_moments(clean(spark, d))


@q("rating_skew")
def _(spark, d):
    return P.rating_skew(clean(spark, d))


@q("sentiment_breakdown")
def _(spark, d):
    return P.sentiment_breakdown(clean(spark, d))


# text
@q("word_count_stats")
def _(spark, d):
    return P.word_count_stats(clean(spark, d))


@q("word_count_hist")
def _(spark, d):
    return P.word_count_hist(clean(spark, d))


@q("word_count_hist_head")
def _(spark, d):
    return P.word_count_hist(clean(spark, d), head=10)


@q("char_length_stats")
def _(spark, d):
    return P.char_length_stats(clean(spark, d))


@q("language_mix")
def _(spark, d):
    return P.language_mix(clean(spark, d))


@q("emoji_share")
def _(spark, d):
    return P.emoji_share(clean(spark, d))


# time
@q("temporal_validity")
def _(spark, d):
    return P.temporal_validity(typed(spark, d), "at_ts")


@q("temporal_range")
def _(spark, d):
    return P.temporal_range(typed(spark, d), "at_ts")


@q("daily_counts")
def _(spark, d):
    return P.daily_counts(typed(spark, d), "at_ts")


@q("daily_count_stats")
def _(spark, d):
    return P.daily_count_stats(typed(spark, d), "at_ts")


@q("date_distribution")
def _(spark, d):
    # days that the cleaner only filled in are no part of the distribution
    return P.date_distribution(clean(spark, d).where(~F.col("reviewed_at_imputed")), "reviewed_at")


@q("day_of_week_counts")
def _(spark, d):
    return P.day_of_week_counts(typed(spark, d), "at_ts")


@q("hour_counts")
def _(spark, d):
    return P.hour_counts(typed(spark, d), "at_ts")


@q("hour_counts_head")
def _(spark, d):
    return P.hour_counts(typed(spark, d), "at_ts", head=5)


# data quality
@q("column_profile")
def _(spark, d):
    return P.column_profile(raw(spark, d))


@q("numeric_summary")
def _(spark, d):
    return P.numeric_summary(typed(spark, d), ["score_num", "thumbs_num"])


@q("numeric_summary_distributed")
def _(spark, d):
    """The same summary with the distributed exact quantiles (bounded state per task)."""
    return P.numeric_summary(typed(spark, d), ["score_num", "thumbs_num"], method="distributed")


@q("field_completeness")
def _(spark, d):
    return P.field_completeness(raw(spark, d))


@q("duplicate_ids")
def _(spark, d):
    return P.duplicate_ids(raw(spark, d))


@q("invalid_scores")
def _(spark, d):
    return P.invalid_scores(typed(spark, d), "score_num")


@q("empty_content")
def _(spark, d):
    return P.empty_content(raw(spark, d))


# ---------------------------------------------------------------- tables
@q("reviews_mapped")
def _(spark, d):
    return reviews(spark, d)


@q("apps_mapped")
def _(spark, d):
    return apps(spark, d)


@q("raw_json")
def _(spark, d):
    r = reviews_full(spark, d)
    j = lambda p: F.get_json_object("raw_data", p)
    return r.select(
        "review_id",
        j("$.reviewId").alias("j_review_id"), j("$.score").alias("j_score"), j("$.content").alias("j_content"),
        j("$.userName").alias("j_user_name"), j("$.arrival_seq").alias("j_arrival_seq"), j("$.app_id").alias("j_app_id"),
    )


@q("raw_json_variant")
def _(spark, d):
    """The JSON capture parsed once into a VARIANT, fields read with their types."""
    v = reviews_full(spark, d).select("review_id", F.parse_json("raw_data").alias("v"))
    g = lambda p, t: F.try_variant_get("v", p, t)
    return v.select(
        "review_id", g("$.score", "int").alias("v_score"), g("$.arrival_seq", "bigint").alias("v_arrival_seq"),
        g("$.thumbsUpCount", "double").alias("v_thumbs"), g("$.reviewed_at_imputed", "boolean").alias("v_imputed"),
    )


@q("raw_json_apps")
def _(spark, d):
    a = apps_full(spark, d)
    j = lambda p: F.get_json_object("raw_data", p)
    return a.select("app_id", j("$.appId").alias("j_app_id"), j("$.title").alias("j_title"), j("$.ratings").alias("j_ratings"))


@q("app_summary")
def _(spark, d):
    return apps(spark, d).select(
        "app_id", "title", "developer", "genre", "score", "ratings", "reviews_count", "installs", "released", "last_updated"
    )


# ---------------------------------------------------------------- reads
@q("reviews_all")
def _(spark, d):
    return R.get_reviews(reviews(spark, d))


@q("reviews_by_app")
def _(spark, d):
    return R.get_reviews(reviews(spark, d), app_id="com.view")


@q("reviews_latest")
def _(spark, d):
    return R.get_reviews(reviews(spark, d), limit=100)


@q("reviews_by_date_range")
def _(spark, d):
    return R.reviews_by_date_range(reviews(spark, d), "com.click", "2024-01-10", "2024-01-12 12:00:00")


@q("reviews_by_score_range")
def _(spark, d):
    return R.reviews_by_score(reviews(spark, d), "com.purchase", 2, 4)


@q("reviews_recent")
def _(spark, d):
    return R.recent_reviews(reviews(spark, d), "com.view", AS_OF, days=7)


@q("search_reviews")
def _(spark, d):
    return R.search_reviews(reviews(spark, d), "com.signup", "50% OFF_")


@q("search_reviews_like")
def _(spark, d):
    return R.search_reviews(reviews(spark, d), "com.signup", "gr_at%app", mode="like")


@q("app_lookup")
def _(spark, d):
    return R.app_info(apps(spark, d), "com.view")


@q("review_count_by_app")
def _(spark, d):
    return R.review_count(reviews(spark, d), "com.view")


@q("preview")
def _(spark, d):
    c = clean(spark, d).orderBy("arrival_seq").limit(3)
    return c.select("reviewId", "userName", "score", "reviewed_at", "content")


SAMPLE_ROWS = 5000  # the source's language-analysis sample size (min(5000, n))


def _sample(spark, d):
    """Repeatable sample: the rows with the smallest md5 of the (unique) review id."""
    return R.smallest_hashes(clean(spark, d), "reviewId", SAMPLE_ROWS)


@q("sample_reviews")
def _(spark, d):
    return _sample(spark, d).select("reviewId", "content", T.script_class("content").alias("script"))


@q("language_mix_sample")
def _(spark, d):
    """The script mix on a repeatable half of the reviews, chosen by md5 of the id (the
    default ``language_mix`` uses every review): the sample grows with the table."""
    return P.language_mix(clean(spark, d).where(F.md5(F.col("reviewId")) < "8"))


@q("feed_order_rating")
def _(spark, d):
    return R.feed_order(reviews(spark, d), "RATING").limit(200)


@q("feed_order_relevant")
def _(spark, d):
    return R.feed_order(reviews(spark, d), "MOST_RELEVANT").limit(200)


# ---------------------------------------------------------------- statistics
@q("table_counts")
def _(spark, d):
    a = apps(spark, d).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("apps").alias("table_name"), "row_count")
    r = reviews(spark, d).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("reviews").alias("table_name"), "row_count")
    return a.unionByName(r)


@q("reviews_by_app_counts")
def _(spark, d):
    return reviews(spark, d).groupBy("app_id").agg(F.count(F.lit(1)).alias("review_count"))


@q("reviews_by_score_counts")
def _(spark, d):
    return reviews(spark, d).groupBy("score").agg(F.count(F.lit(1)).alias("review_count")).orderBy("score")


@q("statistics")
def _(spark, d):
    return P.table_statistics(reviews(spark, d), apps(spark, d))


# ---------------------------------------------------------------- merges
def _loads(spark, d):
    """The feed as two loads split at the cutoff time (unparsable times go to the later load)."""
    r = raw(spark, d)
    t = C.to_timestamp_ntz(TIME_COL)
    first = r.where(t < CL.ts_literal(CUTOFF))
    second = r.where(t.isNull() | (t >= CL.ts_literal(CUTOFF)))
    return first, second


@q("insert_new_reviews")
def _(spark, d):
    first, second = _loads(spark, d)
    existing = TB.map_reviews(CL.clean_reviews(first, AS_OF, time_col=TIME_COL), RUN_TS)
    incoming = TB.map_reviews(CL.clean_reviews(second, AS_OF, time_col=TIME_COL), RUN_TS2)
    return no_raw(TB.insert_new(existing, incoming))


@q("insert_new_reviews_bucketed")
def _(spark, d):
    """Insert-or-ignore against a stored table bucketed by review id: the stored
    side is read in place, only the incoming ids and the rows that may clash are shuffled into its buckets."""
    import uuid

    first, second = _loads(spark, d)
    existing = TB.map_reviews(CL.clean_reviews(first, AS_OF, time_col=TIME_COL), RUN_TS)
    incoming = TB.map_reviews(CL.clean_reviews(second, AS_OF, time_col=TIME_COL), RUN_TS2)
    name = "reviews_" + uuid.uuid4().hex[:16]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ST.save_bucketed(existing, name, scratch_dir(spark, "tables", name), buckets)
    return no_raw(TB.insert_new(spark.table(name), incoming, keys_first=True))


@q("upsert_apps")
def _(spark, d):
    old = apps_full(spark, d)
    new = TB.map_apps(CL.clean_apps(FX.raw_apps_update(spark, d)), RUN_TS2)
    return no_raw(TB.upsert(old, new, RUN_TS2))


@q("accepted_reviews")
def _(spark, d):
    return TB.accepted_by_fk(reviews(spark, d), apps(spark, d))


@q("orphan_reviews")
def _(spark, d):
    return TB.orphans_by_fk(reviews(spark, d), apps(spark, d))


@q("constraint_rejects")
def _(spark, d):
    first, _second = _loads(spark, d)
    existing = reviews_from(first, spark)
    r = raw(spark, d)
    incoming = r.select(
        "arrival_seq",
        F.col("reviewId").alias("review_id"),
        "app_id",
        C.to_double("score").alias("score"),
        F.col("content"),
    )
    v = TB.validate_reviews(incoming, existing, apps(spark, d), order_col="arrival_seq")
    return v.select("arrival_seq", "review_id", "app_id", "reject_reason")


def reviews_from(raw_df, spark):
    return TB.map_reviews(CL.clean_reviews(raw_df, AS_OF, time_col=TIME_COL), RUN_TS).drop("raw_data")


def _deleted_apps(spark, d):
    """Apps scored below 25 are withdrawn (a data rule, not a list of ids)."""
    return apps(spark, d).where(F.col("score") < 25).select("app_id")


@q("cascade_delete_apps")
def _(spark, d):
    a, _r = TB.cascade_delete(apps(spark, d), reviews(spark, d), _deleted_apps(spark, d))
    return a


@q("cascade_delete_reviews")
def _(spark, d):
    _a, r = TB.cascade_delete(apps(spark, d), reviews(spark, d), _deleted_apps(spark, d))
    return r.select("review_id", "app_id", "score")


# ---------------------------------------------------------------- incremental run
def batched(spark, d):
    return FX.with_batch_no(raw(spark, d), BATCH_ROWS)


@q("incremental_ingest")
def _(spark, d):
    return no_raw(IG.incremental_reviews(batched(spark, d), AS_OF, RUN_TS, time_col=TIME_COL))


def _metrics(spark, d):
    return CN.batch_counts(batched(spark, d))


@q("batch_metrics")
def _(spark, d):
    return _metrics(spark, d)


@q("run_status")
def _(spark, d):
    return IG.run_totals(_metrics(spark, d))


@q("feed_slice")
def _(spark, d):
    s = FD.feed_slice(raw(spark, d), token=None, count=200)
    return s.select("arrival_seq", "reviewId", "app_id", "next_token")


@q("feed_slice_resume")
def _(spark, d):
    feed = raw(spark, d)
    token = FD.next_token(FD.feed_slice(feed, token=None, count=200))
    s = FD.feed_slice(feed, token=token, count=200)
    return s.select("arrival_seq", "reviewId", "app_id", "next_token")


@q("pages_union")
def _(spark, d):
    b = batched(spark, d)
    even = b.where(F.col("batch_no") % 2 == 0)
    odd = b.where(F.col("batch_no") % 2 == 1).drop("extra", "reviewCreatedVersion")
    return FD.pages_union([even, odd])


@q("required_field_conformance")
def _(spark, d):
    return FD.required_field_conformance(batched(spark, d), ["app_id", "batch_no"])


@q("batch_events")
def _(spark, d):
    e = M.batch_events(_metrics(spark, d))
    return e.select(
        "batch_no", "event",
        F.get_json_object("payload", "$.inserted_count").cast("bigint").alias("inserted_count"),
    )


def _standard(spark, d):
    first, second = _loads(spark, d)
    existing = TB.map_reviews(CL.clean_reviews(first, AS_OF, time_col=TIME_COL), RUN_TS)
    return second, IG.standard_run(second, apps(spark, d), existing, AS_OF, RUN_TS2, time_col=TIME_COL)


@q("standard_run")
def _(spark, d):
    _raw, run = _standard(spark, d)
    return no_raw(run["inserted"])


@q("standard_run_summary")
def _(spark, d):
    first, second = _loads(spark, d)
    return CN.standard_counts(second, apps(spark, d), reviews_from(first, spark))


# ---------------------------------------------------------------- monitoring
def history(spark, d):
    return FX.run_history(spark, d)


@q("previous_run")
def _(spark, d):
    return M.previous_run(history(spark, d)).select(
        "run_id", "app_id", "mode", "previous_run_id", "previous_status", "previous_fetched", "previous_inserted"
    )


@q("run_change_pct")
def _(spark, d):
    return M.run_monitoring(history(spark, d)).select("run_id", "fetched_change_pct", "inserted_change_pct")


@q("run_anomalies")
def _(spark, d):
    m = M.run_monitoring(history(spark, d))
    return m.select("run_id", F.array_join("anomalies", ",").alias("anomaly_list"), "material_change_detected")


@q("latest_run")
def _(spark, d):
    return M.latest_runs(history(spark, d)).select("app_id", "mode", "run_id", "end_time_utc", "status")


@q("run_events")
def _(spark, d):
    e = M.run_events(history(spark, d))
    return e.select(
        "run_id", "seq", "event",
        F.get_json_object("payload", "$.total_reviews_fetched").cast("bigint").alias("fetched"),
        F.get_json_object("payload", "$.error_stage").alias("error_stage"),
    )


# ---------------------------------------------------------------- files and stores
@q("csv_roundtrip")
def _(spark, d):
    r = raw(spark, d)  # dirty text, with its outer white space
    path = scratch_dir(spark, "csv", "reviews")
    FL.write_csv(r, path)
    return FL.read_csv(spark, path, r.schema)


@q("csv_roundtrip_apps")
def _(spark, d):
    a = apps(spark, d)
    path = scratch_dir(spark, "csv", "apps")
    FL.write_csv(a, path)
    return FL.read_csv(spark, path, a.schema)


@q("landing_json_scan")
def _(spark, d):
    """Ragged landing batches: odd batches lack two keys; the schema read fills nulls."""
    b = batched(spark, d)
    path = scratch_dir(spark, "landing", "json")
    FL.write_json_lines(b.where(F.col("batch_no") % 2 == 0).drop("batch_no"), path, packed=True)
    FL.write_json_lines(b.where(F.col("batch_no") % 2 == 1).drop("batch_no", "extra", "reviewCreatedVersion"), path, packed=True)
    return FL.read_landing(spark, path, FL.RAW_REVIEW_SCHEMA)


@q("reviews_table_scan")
def _(spark, d):
    path = scratch_dir(spark, "tables", "reviews")
    rv = reviews(spark, d)
    ST.create_reviews(rv, path, scratch_dir(spark, "tables", "sliced"))
    return ST.read_reviews(spark, path, rv.schema).select(*[c for c in TB.REVIEW_COLUMNS if c != "raw_data"])


@q("reviews_table_read_pruned")
def _(spark, d):
    """A read method against the stored layout: app partition pruned, time filter pushed."""
    path = scratch_dir(spark, "tables", "reviews")
    rv = reviews(spark, d)
    ST.create_reviews(rv, path, scratch_dir(spark, "tables", "sliced"))
    return R.reviews_by_date_range(ST.read_reviews(spark, path, rv.schema), "com.click", "2024-01-10", "2024-01-12 12:00:00")


def _monitored_history(spark, d):
    return M.with_monitoring_struct(M.run_monitoring(history(spark, d)))


def _flat_history(h):
    return h.select(
        "run_id", "app_id", "mode", "status", "start_time_utc", "total_reviews_fetched", "total_reviews_inserted",
        F.col("monitoring.previous_run_id").alias("previous_run_id"),
        F.col("monitoring.fetched_change_pct").alias("fetched_change_pct"),
        F.array_join("monitoring.anomalies", ",").alias("anomaly_list"),
    )


@q("run_history_roundtrip")
def _(spark, d):
    path = scratch_dir(spark, "history")
    FL.write_json_lines(_monitored_history(spark, d), path)
    return _flat_history(FL.read_run_history(spark, path, M.HISTORY_WITH_MONITORING))


@q("run_history_scan")
def _(spark, d):
    """History with blank and malformed lines appended: they are skipped on read."""
    path = scratch_dir(spark, "history")
    h = _monitored_history(spark, d)
    FL.write_json_lines(h, path)
    # damaged lines derived from the history itself: a truncated copy of each failed run, and a blank line
    bad = h.where(F.col("status") == F.lit("failed")).select(
        F.concat(F.lit('{"run_id": "'), F.col("run_id"), F.lit('", "mode": ')).alias("value"))
    bad.unionByName(bad.limit(1).select(F.lit("").alias("value"))).write.mode("append").text(path)
    return _flat_history(FL.read_run_history(spark, path, M.HISTORY_WITH_MONITORING))


@q("standard_job_replay")
def _(spark, d):
    """Two persisted standard runs of the same feed: the replay inserts nothing,
    and the history flags it against the first run."""
    root = scratch_dir(spark, "warehouse")
    r, a = raw(spark, d), FX.raw_apps(spark, d)
    JB.standard_job(spark, r, a, root, AS_OF, RUN_TS, "run-1", time_col=TIME_COL)
    JB.standard_job(spark, r, a, root, AS_OF, RUN_TS2, "run-2", time_col=TIME_COL)
    h = JB.read_history(spark, root)
    return h.select(
        "run_id", "app_id", "status", "total_reviews_fetched", "total_reviews_cleaned", "total_reviews_inserted",
        "total_duplicates_or_existing", F.col("monitoring.previous_run_id").alias("previous_run_id"),
        F.col("monitoring.inserted_change_pct").alias("inserted_change_pct"),
        F.array_join("monitoring.anomalies", ",").alias("anomaly_list"),
    )


@q("standard_job_tables")
def _(spark, d):
    """The stored reviews after a run and its replay (equal to one run's insert)."""
    root = scratch_dir(spark, "warehouse")
    r, a = raw(spark, d), FX.raw_apps(spark, d)
    JB.standard_job(spark, r, a, root, AS_OF, RUN_TS, "run-1", time_col=TIME_COL)
    JB.standard_job(spark, r, a, root, AS_OF, RUN_TS2, "run-2", time_col=TIME_COL)
    return no_raw(spark.read.parquet(f"{root}/reviews")).select(*[c for c in TB.REVIEW_COLUMNS if c != "raw_data"])


# ---------------------------------------------------------------- streaming
def _stream(spark, d):
    root = scratch_dir(spark, "stream")
    landing, table, metrics, ckpt = (f"{root}/{x}" for x in ("landing", "reviews", "metrics", "checkpoint"))
    SI.write_landing(batched(spark, d), landing)
    SI.run_ingest(spark, landing, table, metrics, ckpt, AS_OF, RUN_TS, time_col=TIME_COL)
    return table, metrics


@q("incremental_job_history")
def _(spark, d):
    """Two persisted incremental runs over one landing folder: the first drains
    it, the second finds nothing new and is recorded as failed with flags."""
    root = scratch_dir(spark, "warehouse")
    landing = f"{root}/landing"
    SI.write_landing(batched(spark, d), landing)
    a = FX.raw_apps(spark, d)
    for run_id, ts in (("inc-1", RUN_TS), ("inc-2", RUN_TS2)):
        JB.incremental_job(spark, landing, root, AS_OF, ts, run_id, raw_apps=a, time_col=TIME_COL)
    h = JB.read_history(spark, root)
    return h.select(
        "run_id", "app_id", "mode", "status", "batches_processed", "total_reviews_fetched", "total_reviews_cleaned",
        "total_reviews_inserted", F.col("monitoring.previous_run_id").alias("previous_run_id"),
        F.array_join("monitoring.anomalies", ",").alias("anomaly_list"),
    )


@q("stream_ingest")
def _(spark, d):
    table, _m = _stream(spark, d)
    return no_raw(spark.read.parquet(table))


@q("stream_batch_metrics")
def _(spark, d):
    _t, metrics = _stream(spark, d)
    return SI.batch_metrics(spark, metrics)


# ---------------------------------------------------------------- incremental run with the tables' promises
def _checked(spark, d, root, run_id, ts, apps=None, **kw):
    return CK.checked_incremental_job(spark, f"{root}/landing", root, AS_OF, ts, run_id, raw_apps=apps, time_col=TIME_COL, **kw)


@q("stream_quarantine")
def _(spark, d):
    """Reviews of the incremental run whose app is not stored."""
    root = scratch_dir(spark, "warehouse")
    SRC.land_batches(batched(spark, d), f"{root}/landing")
    _checked(spark, d, root, "run-1", RUN_TS, FX.raw_apps(spark, d))
    return CK.quarantined(spark, root).select("review_id", "app_id", "score", "batch_no", "arrival_seq", "reject_reason")


@q("stream_readmission")
def _(spark, d):
    """The stored reviews after a later pull of apps has let the quarantined ones in."""
    root = scratch_dir(spark, "warehouse")
    SRC.land_batches(batched(spark, d), f"{root}/landing")
    _checked(spark, d, root, "run-1", RUN_TS, FX.raw_apps(spark, d))
    _checked(spark, d, root, "run-2", RUN_TS2, FX.raw_apps_update(spark, d))
    rows = ReviewWarehouse(spark, root).reviews()
    return rows.select(*[c for c in TB.REVIEW_COLUMNS if c != "raw_data"])


@q("stream_max_batches")
def _(spark, d):
    """Two runs over one landing folder, the first bounded to one batch: which run took which batch."""
    root = scratch_dir(spark, "warehouse")
    SRC.land_batches(batched(spark, d), f"{root}/landing")
    _checked(spark, d, root, "run-1", RUN_TS, FX.raw_apps(spark, d), max_batches=1)
    _checked(spark, d, root, "run-2", RUN_TS2)
    m = CK.metrics(spark, root)
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("fetched_count", "cleaned_count", "inserted_count", "orphan_count")]
    return m.groupBy("run_id", "batch_no").agg(*sums)


@q("stream_events")
def _(spark, d):
    """The stored events of a run and of the readmission that follows it."""
    root = scratch_dir(spark, "warehouse")
    SRC.land_batches(batched(spark, d), f"{root}/landing")
    _checked(spark, d, root, "run-1", RUN_TS, FX.raw_apps(spark, d))
    _checked(spark, d, root, "run-2", RUN_TS2, FX.raw_apps_update(spark, d))
    count = lambda k: F.get_json_object("payload", f"$.{k}").cast("bigint")
    return CK.events(spark, root).select(
        "run_id", "batch_no", "event", count("inserted_count").alias("inserted_count"), count("readmitted_count").alias("readmitted_count"))


@q("failed_run_history")
def _(spark, d):
    """A batch that lands behind processed ones is refused: the run fails and leaves its rows."""
    root = scratch_dir(spark, "warehouse")
    b = batched(spark, d)
    SRC.land_batches(b.where("batch_no > 0"), f"{root}/landing")
    _checked(spark, d, root, "run-1", RUN_TS, FX.raw_apps(spark, d))
    SRC.land_batches(b.where("batch_no = 0"), f"{root}/landing")
    try:
        _checked(spark, d, root, "run-2", RUN_TS2)
    except SRC.LateBatch:
        pass
    h = JB.read_history(spark, root)
    return h.select(
        "run_id", "app_id", "status", "fetch_app_info", "batches_processed", "total_reviews_fetched", "total_reviews_inserted", "error_stage",
        F.substring_index("error_message", ":", 1).alias("error_kind"), F.array_join("monitoring.anomalies", ",").alias("anomaly_list"))
