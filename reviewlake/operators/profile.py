"""Profiling queries: ratings, text, scripts, time patterns, data quality.

Each is one aggregation plan with partial (map-side) aggregation, so a hot
app or score value only grows a counter.  Windows such as ``sum() over ()``
run only on already-aggregated frames (a handful of groups).  Exact medians
use Spark's ``median``/``percentile``, whose per-task state is one counter per
*distinct* value — bounded for scores, word counts and day counts; use
``approx_percentile`` for unbounded continuous columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.functions import text as T
from reviewlake.functions import timeparts as TP

PCT_DIGITS = 4
STAT_DIGITS = 6

# Field classes of the completeness report.
CRITICAL_FIELDS = ["reviewId", "content", "score"]
NON_CRITICAL_FIELDS = ["reviewCreatedVersion", "replyContent", "repliedAt"]


def ALL():
    """Whole-frame window: only ever applied to small aggregated frames."""
    return Window.partitionBy()


def _pct(n, total):
    """Share in percent; null (not an error, also under ANSI) when the total is 0."""
    return F.round(F.try_divide(n.cast("double") * F.lit(100.0), total.cast("double")), PCT_DIGITS)


def _r(c):
    return F.round(c.cast("double"), STAT_DIGITS)


def share_of_total(counts: DataFrame, n: str = "review_count") -> DataFrame:
    return counts.withColumn("pct", _pct(F.col(n), F.sum(n).over(ALL())))


# ---------------------------------------------------------------- ratings
def rating_distribution(df: DataFrame, score: str = "score") -> DataFrame:
    """Rows per score with % of *all* rows (null scores count in the denominator)."""
    g = df.groupBy(score).agg(F.count(F.lit(1)).alias("review_count"))
    g = g.withColumn("pct", _pct(F.col("review_count"), F.sum("review_count").over(ALL())))
    return g.where(F.col(score).isNotNull()).orderBy(score)


def rating_distribution_filled(spark: SparkSession, df: DataFrame, score: str = "score") -> DataFrame:
    """Buckets 1..5, zero-filled; other scores count only in the denominator."""
    g = df.groupBy(score).agg(F.count(F.lit(1)).alias("n"))
    g = g.withColumn("total", F.sum("n").over(ALL()))
    buckets = spark.range(1, 6).select(F.col("id").cast("int").alias(score))
    j = buckets.join(g, score, "left")
    total = F.max("total").over(ALL())  # 5 rows
    return j.select(
        F.col(score),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("review_count"),
        _pct(F.coalesce(F.col("n"), F.lit(0)), total).alias("pct"),
    ).orderBy(score)


def rating_moments(df: DataFrame, score: str = "score") -> DataFrame:
    s = F.col(score)
    return df.agg(
        _r(F.avg(s)).alias("mean_score"),
        _r(F.median(s)).alias("median_score"),
        F.mode(s, True).alias("mode_score"),
        _r(F.stddev_samp(s)).alias("std_score"),
    )


def rating_skew(df: DataFrame, score: str = "score") -> DataFrame:
    """Biased (population) skewness g1 and its label at +/-0.5."""
    k = df.agg(F.skewness(F.col(score)).alias("sk"))
    label = (
        F.when(F.col("sk") < -0.5, F.lit("negative"))
        .when(F.col("sk") > 0.5, F.lit("positive"))
        .otherwise(F.lit("balanced"))
    )
    return k.select(_r(F.col("sk")).alias("skewness"), label.alias("skew_label"))


def sentiment_breakdown(df: DataFrame, score: str = "score") -> DataFrame:
    s = F.col(score)
    total = F.count(F.lit(1))
    a = df.agg(
        F.count_if(s >= 4).alias("positive"),
        F.count_if(s == 3).alias("neutral"),
        F.count_if(s <= 2).alias("negative"),
        total.alias("total"),
    )
    return a.select(
        "positive", "neutral", "negative",
        _pct(F.col("positive"), F.col("total")).alias("positive_pct"),
        _pct(F.col("neutral"), F.col("total")).alias("neutral_pct"),
        _pct(F.col("negative"), F.col("total")).alias("negative_pct"),
    )


# ---------------------------------------------------------------- text
def word_count_stats(df: DataFrame, content: str = "content") -> DataFrame:
    w = T.word_count(content)
    return df.agg(
        _r(F.avg(w)).alias("mean_words"),
        _r(F.median(w)).alias("median_words"),
        F.min(w).alias("min_words"),
        F.max(w).alias("max_words"),
    )


def word_count_hist(df: DataFrame, content: str = "content", head: int | None = None) -> DataFrame:
    """Rows per word count with %; ``head`` keeps the first lengths in length order."""
    g = df.groupBy(T.word_count(content).alias("word_count")).agg(F.count(F.lit(1)).alias("review_count"))
    g = share_of_total(g).orderBy("word_count")
    return g.limit(head) if head else g


def char_length_stats(df: DataFrame, content: str = "content") -> DataFrame:
    n = T.char_length(content)
    a = df.agg(F.avg(n).alias("a"), F.max(n).alias("mx"), F.min(n).alias("mn"))
    return a.select(
        _r(F.coalesce(F.col("a"), F.lit(0.0))).alias("avg_length"),
        F.coalesce(F.col("mx"), F.lit(0)).cast("bigint").alias("max_length"),
        F.coalesce(F.col("mn"), F.lit(0)).cast("bigint").alias("min_length"),
    )


def language_mix(df: DataFrame, content: str = "content") -> DataFrame:
    g = df.groupBy(T.script_class(content).alias("script")).agg(F.count(F.lit(1)).alias("review_count"))
    return share_of_total(g)


def emoji_share(df: DataFrame, content: str = "content") -> DataFrame:
    a = df.agg(F.count_if(T.has_emoji(content)).alias("with_emoji"), F.count(F.lit(1)).alias("total"))
    return a.select("with_emoji", "total", _pct(F.col("with_emoji"), F.col("total")).alias("pct"))


# ---------------------------------------------------------------- time
def temporal_validity(df: DataFrame, ts: str) -> DataFrame:
    a = df.agg(F.count(F.col(ts)).alias("valid_timestamps"), F.count(F.lit(1)).alias("total"))
    return a.select("valid_timestamps", "total", _pct(F.col("valid_timestamps"), F.col("total")).alias("pct"))


def temporal_range(df: DataFrame, ts: str) -> DataFrame:
    a = df.where(F.col(ts).isNotNull()).agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"))
    return a.select("earliest", "latest", TP.whole_days_between("earliest", "latest").cast("bigint").alias("span_days"))


def daily_counts(df: DataFrame, ts: str) -> DataFrame:
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(TP.day_of(ts).alias("review_day"))
        .agg(F.count(F.lit(1)).alias("review_count"))
    )


def daily_count_stats(df: DataFrame, ts: str) -> DataFrame:
    d = daily_counts(df, ts)  # one row per day present: small
    n = F.col("review_count")
    return d.agg(
        _r(F.avg(n)).alias("mean_per_day"),
        _r(F.median(n)).alias("median_per_day"),
        F.min(n).alias("min_per_day"),
        F.max(n).alias("max_per_day"),
        F.count(F.lit(1)).alias("days_present"),
    )


def date_distribution(df: DataFrame, ts: str) -> DataFrame:
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(TP.day_text(ts).alias("review_date"))
        .agg(F.count(F.lit(1)).alias("review_count"))
        .orderBy("review_date")
    )


def day_of_week_counts(df: DataFrame, ts: str) -> DataFrame:
    g = (
        df.where(F.col(ts).isNotNull())
        .groupBy(TP.weekday_number(ts).alias("weekday_no"), TP.weekday_name(ts).alias("weekday"))
        .agg(F.count(F.lit(1)).alias("review_count"))
    )
    return share_of_total(g).orderBy("weekday_no")


def hour_counts(df: DataFrame, ts: str, head: int | None = None) -> DataFrame:
    g = df.where(F.col(ts).isNotNull()).groupBy(TP.hour_of(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("review_count")
    )
    g = share_of_total(g).orderBy("hour")
    return g.limit(head) if head else g


# ---------------------------------------------------------------- quality
def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null count, % missing — one aggregation pass, then unpivot."""
    cols = df.columns
    a = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    stack = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(f"__nn_{i}").alias("non_null"))
            for i, c in enumerate(cols)
        ])
    ).alias("s")
    u = a.select(F.col("__total").alias("total_rows"), stack)
    return u.select(
        "s.column_name", "s.data_type", "s.non_null", "total_rows",
        _pct(F.col("total_rows") - F.col("s.non_null"), F.col("total_rows")).alias("missing_pct"),
    )


def numeric_summary(df: DataFrame, cols: list[str], method: str = "exact") -> DataFrame:
    """count, mean, std, min, quartiles, max per column.

    Quartiles are exact with linear interpolation:
      * ``exact``: Spark's ``percentile`` — state is one counter per distinct
        value, merged in one task (fine for scores, counts, word counts);
      * ``distributed``: ``operators.quantiles.exact_quantiles_of`` — same values,
        bounded state, all columns in one pass a round, for continuous columns at any size;
      * ``approx``: the mergeable quantile sketch (``percentile_approx``).
    """
    quartiles = None
    if method == "distributed":
        from reviewlake.operators.quantiles import exact_quantiles_of

        quartiles = exact_quantiles_of(df, cols, [0.25, 0.5, 0.75])
    probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        if quartiles:
            q = F.array(*[F.lit(v).cast("double") for v in quartiles[c]])
        else:
            q = F.percentile_approx(x, probs, 10000) if method == "approx" else F.percentile(x, probs)
        aggs += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"), q.alias(f"q{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    a = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), _r(F.col(f"m{i}")).alias("mean"),
            _r(F.col(f"s{i}")).alias("std"), _r(F.col(f"lo{i}")).alias("min"),
            _r(F.col(f"q{i}")[0]).alias("p25"), _r(F.col(f"q{i}")[1]).alias("p50"), _r(F.col(f"q{i}")[2]).alias("p75"),
            _r(F.col(f"hi{i}")).alias("max"),
        ) for i, c in enumerate(cols)
    ])).alias("s")
    return a.select(rows).select("s.*")


def field_completeness(df: DataFrame) -> DataFrame:
    prof = column_profile(df)
    cls = (
        F.when(F.col("column_name").isin(CRITICAL_FIELDS), F.lit("critical"))
        .when(F.col("column_name").isin(NON_CRITICAL_FIELDS), F.lit("non_critical"))
        .otherwise(F.lit("other"))
    )
    comp = _pct(F.col("non_null"), F.col("total_rows"))
    return prof.select(
        "column_name", "non_null", "total_rows", comp.alias("completeness_pct"),
        cls.alias("field_class"), (F.col("non_null") == F.col("total_rows")).alias("is_complete"),
    )


def duplicate_ids(df: DataFrame, id_col: str = "reviewId") -> DataFrame:
    """Copies after the first of each id; null ids count as equal to each other."""
    c = F.col(id_col)
    a = df.agg(F.count(c).alias("nn"), F.count_distinct(c).alias("nd"), F.count_if(c.isNull()).alias("nnull"))
    return a.select(
        (F.col("nn") - F.col("nd") + F.greatest(F.col("nnull") - 1, F.lit(0))).cast("bigint").alias("duplicate_ids")
    )


def invalid_scores(df: DataFrame, score: str = "score") -> DataFrame:
    s = F.col(score)
    return df.agg(F.count_if((s < 1) | (s > 5)).alias("invalid_scores"))


def empty_content(df: DataFrame, content: str = "content") -> DataFrame:
    blank = T.ustrip(F.coalesce(F.col(content), F.lit(""))) == F.lit("")
    a = df.agg(F.count_if(blank).alias("empty_content"), F.count(F.lit(1)).alias("total"))
    return a.select("empty_content", "total", _pct(F.col("empty_content"), F.col("total")).alias("pct"))


# ---------------------------------------------------------------- statistics bundle
def table_statistics(reviews: DataFrame, apps: DataFrame) -> DataFrame:
    """App count, review count, reviews per app and per score — as (section, item, value).

    The three review figures come from one pass: ``cube(app_id, score)`` with
    ``grouping_id`` (0 = both keys, 1 = per app, 2 = per score, 3 = total);
    the pair level is dropped.  The app count is one more (small) scan.
    """
    c = reviews.cube("app_id", "score").agg(F.count(F.lit(1)).alias("value"), F.grouping_id().alias("gid"))
    section = (F.when(F.col("gid") == 1, F.lit("app")).when(F.col("gid") == 2, F.lit("score"))
               .otherwise(F.lit("table")))
    item = (F.when(F.col("gid") == 1, F.col("app_id")).when(F.col("gid") == 2, F.col("score").cast("string"))
            .otherwise(F.lit("reviews")))
    r = c.where(F.col("gid") > 0).select(section.alias("section"), item.alias("item"), "value")
    a = apps.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("table").alias("section"), F.lit("apps").alias("item"), "value")
    return a.unionByName(r)
