"""Read queries over the curated ``reviews`` / ``apps`` tables.

All are lazy: the ``app_id`` predicate becomes a partition filter on a table
written partitioned by app id (or a pushed Parquet filter otherwise), the time
and score predicates become pushed row-group filters, and ``orderBy().limit()``
plans as a distributed top-k (``TakeOrderedAndProject``), never a full sort.

Invalid arguments return an empty frame with the table's schema, as the
source's read methods return empty results.  Ordering is newest first with the
review id as tie-break, so a limited read is deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.functions.text import contains_ci, like_ci
from reviewlake.operators.clean import ts_literal

def _newest_first_keys():
    return [F.col("reviewed_at").desc_nulls_last(), F.col("review_id").asc()]


def _empty(df: DataFrame) -> DataFrame:
    return df.where(F.lit(False))


def _app(df: DataFrame, app_id: str | None) -> DataFrame:
    return df.where(F.col("app_id") == F.lit(app_id)) if app_id else df


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(*_newest_first_keys())


def get_reviews(reviews: DataFrame, app_id: str | None = None, limit: int | None = None) -> DataFrame:
    """All reviews (optionally of one app), newest first; ``limit`` 0/None = all."""
    df = newest_first(_app(reviews, app_id))
    return df.limit(int(limit)) if limit else df


def _parse_bound(value):
    if value is None:
        return None
    if isinstance(value, _dt.datetime):
        return _utc(value)
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    text = str(value).strip()
    if not text:
        return None
    try:
        return _utc(_dt.datetime.fromisoformat(text.replace("/", "-")))
    except ValueError:
        pass
    for fmt in ("%b %d, %Y", "%d %b %Y", "%B %d, %Y"):
        try:
            return _dt.datetime.strptime(text, fmt)
        except ValueError:
            continue
    raise ValueError(f"not a date or time: {value!r}")


def _utc(value: _dt.datetime) -> _dt.datetime:
    """Without offset as it is, with an offset in UTC; stored times have no zone and mean UTC."""
    return value if value.tzinfo is None else value.astimezone(_dt.timezone.utc).replace(tzinfo=None)


def reviews_by_date_range(reviews: DataFrame, app_id: str, start, end) -> DataFrame:
    """Reviews with ``start <= reviewed_at <= end`` (both inclusive; a bare date is midnight)."""
    s, e = _parse_bound(start), _parse_bound(end)
    if s is None or e is None:
        return _empty(reviews)
    df = _app(reviews, app_id).where(F.col("reviewed_at").between(ts_literal(s), ts_literal(e)))
    return newest_first(df)


def reviews_by_score(reviews: DataFrame, app_id: str, min_score: int = 1, max_score: int = 5) -> DataFrame:
    """Reviews with a score in ``[min_score, max_score]``; an invalid range -> empty."""
    if min_score < 1 or max_score > 5 or min_score > max_score:
        return _empty(reviews)
    return newest_first(_app(reviews, app_id).where(F.col("score").between(min_score, max_score)))


def recent_reviews(reviews: DataFrame, app_id: str, as_of, days: int = 7) -> DataFrame:
    """Reviews of the last ``days`` days before ``as_of`` (explicit, not the wall clock)."""
    if days < 1:
        return _empty(reviews)
    now = _parse_bound(as_of)
    if now is None:
        raise ValueError("as_of is needed")
    start = now - _dt.timedelta(days=int(days))
    return newest_first(_app(reviews, app_id).where(F.col("reviewed_at") >= ts_literal(start)))


def search_reviews(reviews: DataFrame, app_id: str, keyword: str, mode: str = "literal") -> DataFrame:
    """Case-insensitive keyword search in ``content``; blank keyword -> empty.

    ``mode="literal"`` (default) matches the keyword as text; ``mode="like"``
    keeps the wildcard meaning of ``%`` and ``_`` for compatibility.
    """
    if keyword is None or not keyword.strip():
        return _empty(reviews)
    pred = contains_ci("content", keyword) if mode == "literal" else like_ci("content", keyword)
    return newest_first(_app(reviews, app_id).where(pred))


def app_info(apps: DataFrame, app_id: str) -> DataFrame:
    """Point lookup of one app (zero or one row), columns by name."""
    return apps.where(F.col("app_id") == F.lit(app_id))


def review_count(reviews: DataFrame, app_id: str) -> DataFrame:
    return _app(reviews, app_id).agg(F.count(F.lit(1)).alias("review_count"))


def feed_order(raw: DataFrame, sort: str) -> DataFrame:
    """Feed orders: NEWEST (time), RATING (score), MOST_RELEVANT (thumbs-up), each
    newest-first within ties and then by id.  Other names raise ``ValueError``."""
    keys = {
        "NEWEST": [F.col("reviewed_at").desc_nulls_last()],
        "RATING": [F.col("score").desc_nulls_last(), F.col("reviewed_at").desc_nulls_last()],
        "MOST_RELEVANT": [F.col("thumbs_up_count").desc_nulls_last(), F.col("reviewed_at").desc_nulls_last()],
    }
    if sort not in keys:
        raise ValueError(f"unknown sort order {sort!r}; expected one of {sorted(keys)}")
    return raw.orderBy(*keys[sort], F.col("review_id").asc())


def smallest_hashes(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest md5 of ``key`` (ties by key), as a repeatable sample.

    The rows are first counted by the first four hex digits of the hash, without their other columns;
    only rows up to the digits at which the count reaches ``n`` then meet in the final
    top-n, about ``n`` in all however many tasks there are.
    """
    h = F.md5(F.col(key))
    digits = F.substring(h, 1, 4)
    per = df.select(F.coalesce(digits, F.lit("")).alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # 65,537 rows at most
    reached = per.select("d", F.sum("c").over(upto).alias("s")).where(F.col("s") >= n)
    last = reached.agg(F.min("d").alias("d")).first().d
    near = df if last is None else df.where(F.col(key).isNull() | (digits <= F.lit(last)))
    return near.orderBy(h, key).limit(n)
