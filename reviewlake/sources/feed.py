"""The landing feed: resumable page reads, page assembly, field contracts.

The source's paged remote reader becomes a read of an ordered landing table:
a page is ``arrival_seq > token`` in ``arrival_seq`` order, ``count`` rows; the
next token is the page's last ``arrival_seq``.  ``orderBy().limit()`` plans as
a distributed top-k, so a page costs one scan with a pushed filter, not a sort
of the feed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fields every review must carry.
REQUIRED_FIELDS = ["reviewId", "content", "score"]


def feed_slice(feed: DataFrame, token=None, count: int = 200, seq: str = "arrival_seq") -> DataFrame:
    """Up to ``count`` rows after ``token`` (None = from the start) with ``next_token``.

    ``count <= 0`` gives an empty page; an exhausted feed gives an empty page.
    """
    if count is None or count <= 0:
        return feed.where(F.lit(False)).withColumn("next_token", F.col(seq))
    page = feed if token is None else feed.where(F.col(seq) > F.lit(token))
    page = page.orderBy(F.col(seq).asc()).limit(int(count))
    # the window spans one page (at most ``count`` rows)
    return page.withColumn("next_token", F.max(seq).over(Window.partitionBy()))


def next_token(page: DataFrame, seq: str = "arrival_seq"):
    """The continuation token of a page (one value to the driver, as a resume token is)."""
    row = page.agg(F.max(seq).alias("t")).first()
    return None if row is None else row["t"]


def pages_union(pages: list[DataFrame]) -> DataFrame:
    """Assemble pages whose fields may differ: missing fields become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def required_field_conformance(feed: DataFrame, by: list[str], fields: list[str] = REQUIRED_FIELDS) -> DataFrame:
    """Per group: rows lacking each required field; ``all_missing`` when no row has it.

    One partial aggregation over the feed, then an unpivot of the small result.
    """
    present = [f for f in fields if f in feed.columns]
    aggs = [F.count(F.lit(1)).alias("total_rows")] + [F.count_if(F.col(f).isNull()).alias(f"__m_{f}") for f in present]
    g = feed.groupBy(*by).agg(*aggs)
    s = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"__m_{f}").alias("missing_rows")) for f in present
    ])).alias("s")
    u = g.select(*by, "total_rows", s)
    return u.select(
        *by, "s.field", "s.missing_rows", "total_rows",
        (F.col("s.missing_rows") == F.col("total_rows")).alias("all_missing"),
    )
