"""Cleaning of raw reviews and app metadata as one lazy DataFrame plan.

Review cleaning, in this order (the order changes the result):
  1. drop rows with a null review id or null score; null content -> ""
  2. keep the first copy of each review id in feed order (per batch, if given)
  3. parse the review time; unparsable or missing -> ``as_of`` (flagged)
  4. score: plain number within 1..5 (tested before rounding), rounded half-even
  5. text: "nan" -> "", strip Unicode white space; blank user name / reply -> null
  6. thumbs-up count: plain number or null
  7. preferred column order, extra columns kept after it

Step 2 is the only shuffle (hash-partitioned on the review id, never on the
app id, so a popular app does not land in one task).  ``row_number() = 1`` lets
Spark insert a partial WindowGroupLimit before the exchange: each map task
forwards only its first copy of a key, so a hot duplicated id costs at most one
row per task in the shuffle.  Texts of ids that come once are not shuffled: see
``first_copies``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.functions.coerce import round_half_even_int, to_double, to_timestamp_ntz
from reviewlake.functions.text import clean_text

# The preferred column order of a cleaned review.
REVIEW_ORDER = [
    "reviewId",
    "userName",
    "userImage",
    "score",
    "content",
    "reviewed_at",
    "reviewCreatedVersion",
    "appVersion",
    "thumbsUpCount",
    "replyContent",
    "repliedAt",
]
# Numeric fields of app metadata.
APP_NUMERIC = ["score", "ratings", "reviews", "realInstalls", "minInstalls", "price"]
APP_TIMES = ["released", "lastUpdatedOn"]

DROP_MISSING = "missing_required"
DROP_DUPLICATE = "duplicate"
DROP_SCORE = "invalid_score"


def ts_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from text or a naive datetime."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).try_cast("timestamp_ntz")


# Bits of the set of repeated keys: 64 a word, so at most a million words are broadcast, whatever the input.
SLOTS = 1 << 26


def split_marked(rows: DataFrame, few: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose key may be among the keys of ``few``, and those whose key is not.

    The keys of ``few`` are marked in a bit set of fixed size that every task gets; no row is
    shuffled.  A false mark puts a row into the first part, so that part is to be joined exactly.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS))
    word, place = F.shiftright(slot, 6), F.pmod(slot, F.lit(64)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    marks = few.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    marked = rows.withColumn("__word", word).join(F.broadcast(marks), "__word", "left")
    marked = marked.withColumn("__again", F.coalesce(F.getbit("__bits", place) == 1, F.lit(False)))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return marked.where("__again").select(*columns), marked.where("NOT __again").select(*columns)


def first_copies(rows: DataFrame, keys: list[str], order_cols: list[str], bounded: bool = False) -> DataFrame:
    """The first row per key (``keys``) in ``order_cols`` order, at the price of the repeated rows only.

    The keys are counted by themselves, without the other columns.  Those that come more than once
    are marked in a bit set of fixed size that every task gets.  A row whose bit is clear is the
    only one of its key and stays where it is; the others meet in a window by key, as all rows
    would without the marks, so a false mark costs a row's shuffle and never changes the result.

    ``bounded``: the rows are few (a micro-batch); the window over all of them costs less.
    """
    def windowed(df: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order_cols])
        return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")

    if bounded:
        return windowed(rows)
    repeated = rows.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    again, once = split_marked(rows, repeated, keys)
    return windowed(again).union(once)


def _finish(df: DataFrame, time_col: str, as_of) -> DataFrame:
    """Steps 3-7 on rows that passed steps 1-2."""
    parsed = to_timestamp_ntz(F.col(time_col)) if time_col in df.columns else F.lit(None).cast("timestamp_ntz")
    out = (
        df.withColumn("reviewed_at", F.coalesce(parsed, ts_literal(as_of)))
        .withColumn("reviewed_at_imputed", parsed.isNull())
        .withColumn("score", round_half_even_int(F.col("__score_num")))
        .withColumn("content", clean_text(F.col("content"), blank_to_null=False))
    )
    for c in ("userName", "replyContent"):
        if c in out.columns:
            out = out.withColumn(c, clean_text(F.col(c), blank_to_null=True))
    if "thumbsUpCount" in out.columns:
        out = out.withColumn("thumbsUpCount", to_double(F.col("thumbsUpCount")))
    drop = {time_col, "__score_num", "__ok"}
    ordered = [c for c in REVIEW_ORDER if c in out.columns]
    rest = [c for c in out.columns if c not in ordered and c not in drop]
    return out.select(*ordered, *rest)


def clean_reviews(
    raw: DataFrame,
    as_of,
    time_col: str = "at",
    order_col: str = "arrival_seq",
    batch_col: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Cleaned reviews (see module doc).  ``order_col`` must be in the data:
    Spark rows have no intrinsic order, so "first" is defined by it.
    ``bounded``: ``raw`` is a micro-batch (see ``first_copies``)."""
    # the numeric gate is evaluated once, below the shuffle, and carried as a
    # column (8 bytes) instead of being re-evaluated by the filter and projection
    df = raw.where(F.col("reviewId").isNotNull() & F.col("score").isNotNull()).select(
        *[F.col(c) for c in raw.columns if c != "content"],
        F.coalesce(F.col("content"), F.lit("")).alias("content"),
        to_double(F.col("score")).alias("__score_num"),
    )
    df = first_copies(df, ([batch_col] if batch_col else []) + ["reviewId"], [order_col], bounded)
    df = df.where(F.col("__score_num").between(1.0, 5.0))
    return _finish(df, time_col, as_of)


def tag_reviews(
    raw: DataFrame,
    order_col: str = "arrival_seq",
    batch_col: str | None = None,
) -> DataFrame:
    """Every raw row with ``drop_reason`` (null = kept), in the cleaner's step order.

    All rows are kept, so the ``= 1`` pre-limit of ``clean_reviews`` does not
    apply.  Skew-proof formulation: the first arrival number per id is a
    partial ``min`` aggregation (a hot id becomes one counter per task), and
    rows are matched back on (id, arrival number) — unique per row, so the rows
    of a hot id spread over all tasks instead of meeting in one.  A matched row
    is the first copy; an unmatched one a duplicate.  Rows failing step 1 (null
    ids among them) bypass the join.  ``order_col`` is unique per id.
    """
    keys = ([batch_col] if batch_col else []) + ["reviewId"]
    ok = F.col("reviewId").isNotNull() & F.col("score").isNotNull()
    good = raw.where(ok)
    first = (good.groupBy(*keys).agg(F.min(order_col).alias(order_col))
             .withColumn("__first", F.lit(True)))
    good = good.join(first, keys + [order_col], "left")
    reason = (
        F.when(F.col("__first").isNull(), F.lit(DROP_DUPLICATE))
        .when(~F.coalesce(to_double(F.col("score")).between(1.0, 5.0), F.lit(False)), F.lit(DROP_SCORE))
    )
    good = good.withColumn("drop_reason", reason).drop("__first")
    bad = raw.where(~ok).withColumn("drop_reason", F.lit(DROP_MISSING))
    return good.unionByName(bad)


def cleaning_stats(tagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of the cleaning run (one pass over the tagged rows)."""
    by = by or []
    r = F.col("drop_reason")
    return tagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(r.isNull()).alias("valid_records"),
        F.count_if(r.isNotNull()).alias("invalid_records"),
        F.count_if(r == F.lit(DROP_DUPLICATE)).alias("duplicates_removed"),
        F.count_if(r == F.lit(DROP_MISSING)).alias("missing_required_removed"),
        F.count_if(r == F.lit(DROP_SCORE)).alias("invalid_score_removed"),
    )


def clean_apps(raw_apps: DataFrame) -> DataFrame:
    """Typed app metadata: dates to ``timestamp_ntz`` and numbers to double (bad -> null).

    All other fields are kept as they are; absent numeric/time fields stay absent.
    """
    out = raw_apps
    for c in APP_TIMES:
        if c in out.columns:
            out = out.withColumn(c, to_timestamp_ntz(F.col(c)))
    for c in APP_NUMERIC:
        if c in out.columns:
            out = out.withColumn(c, to_double(F.col(c)))
    return out
