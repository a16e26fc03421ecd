"""Mixing sources to target weights by hash-threshold histograms (native columns only).

Every document has a hash of its id and text.  A source with the target of
r = whole + part times its size takes each document ``whole`` times and those
under a hash threshold once more.  The threshold is found by histograms: sizes are
summed by source and the leading hash bits; the bucket in which the running sum
crosses the budget is the only one refined by the next bits.  No rows are sorted;
the last filter is one comparison per row.  Raising a budget only raises the
threshold, so the mixes of growing budgets are nested.

Edge cases, all defined: a null text has size 0; a null source is a source, the
last in order; rows that equal in id and text share one hash and one fate; a
source whose size is 0 has target 0; an empty table gives an empty result; extra
columns are kept untouched beside the mix's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import numbered, stage

HASH_BITS = 60
STEP_BITS = 12  # bits refined at once: a histogram has at most 4096 buckets a source

WORDS = r"[^\x20\x09-\x0D]+"


def hash60(*cols: Column) -> Column:
    """The first 60 bits of an MD5 over the columns as text, null and empty told apart."""
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def ranked(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Adds the weight of each source: ``weights`` repeat along the sources in code-point
    order, null last.  The order number is a count of the smaller sources per range
    partition plus its own place there, so no task sees more than its range."""
    s = F.struct(F.col("source").isNull().alias("last"), F.col("source").alias("s"))
    ranged = stage(sources.withColumn("__k", s).repartitionByRange("__k").withColumn("__p", F.spark_partition_id()), "sources")
    parts = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("n"))
    first = parts.select(
        "__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("before")  # one row per partition
    )
    place = F.row_number().over(Window.partitionBy("__p").orderBy("__k")) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__i") % len(weights) + 1).cast("int"))
    return (
        ranged.withColumn("__r", place).join(first, "__p").withColumn("__i", F.col("before") + F.col("__r"))
        .withColumn("weight", w).drop("__k", "__p", "__r", "__i", "before")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Targets share ``share`` times the whole size by weight; a source stops at ``most``
    times its own size and the excess is shared again by weight until none is above.
    Every round is one aggregate; the level rises, so a source once stopped stays so.
    """
    t = stage(ranked(sizes, weights), "weights")
    total = (t.agg(F.sum("source_size")).first()[0] or 0) * share
    cap = F.col("source_size") * F.lit(most)
    level, stopped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= cap
        n, used, free = t.agg(
            F.count_if(full), F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if n == stopped or not free:
            break
        stopped, level = n, (total - used) / free
    full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= cap
    return t.select("source", "source_size", F.when(full, cap).otherwise(F.col("weight") * F.lit(level or 0.0)).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut): a row with hash < cut is taken, for budgets (source, budget).

    ``rows`` is a staged table of (source, size, h).  The cut after each round is the
    start of the bucket the budget falls into; ``left`` is what the budget still has
    there.  After the last bits the bucket is one hash value, which is taken if that
    brings the sum nearer.
    """
    state = stage(budgets.select("source", F.lit(0).cast("long").alias("cut"), F.col("budget").alias("left")), "cut")
    for used in range(0, HASH_BITS, STEP_BITS):
        width = 1 << (HASH_BITS - used - STEP_BITS)  # hash values per bucket of this round
        here = F.col("source").eqNullSafe(F.col("s2"))
        inside = rows if used == 0 else rows.join(
            F.broadcast(state.select(F.col("source").alias("s2"), "cut")) if _small(state) else state.select(F.col("source").alias("s2"), "cut"),
            here & (F.col("h") >= F.col("cut")) & (F.col("h") < F.col("cut") + F.lit(width << STEP_BITS)),
        ).drop("s2", "cut")
        hist = inside.groupBy("source", F.expr(f"h div {width}").alias("bucket")).agg(F.sum("size").alias("size"))
        w = Window.partitionBy("source").orderBy("bucket")
        run = hist.withColumn("upto", F.sum("size").over(w)).withColumn("before", F.col("upto") - F.col("size"))
        st = state.select(F.col("source").alias("s2"), "cut", "left")
        last = used + STEP_BITS >= HASH_BITS
        # the first bucket that the budget does not cover whole; none: everything is taken
        cross = (
            run.join(st, F.col("source").eqNullSafe(F.col("s2"))).where(F.col("upto") > F.col("left"))
            .groupBy("s2").agg(F.min_by(F.struct("bucket", "before", "size"), "bucket").alias("x"))
            .select(F.col("s2").alias("s3"), "x.*")
        )
        start = F.col("bucket") * F.lit(width)
        nearer = F.col("size") <= 2 * (F.col("left") - F.col("before"))
        state = stage(
            state.join(cross, F.col("source").eqNullSafe(F.col("s3")), "left").select(
                "source",
                F.when(F.col("bucket").isNull(), F.col("cut") + F.lit(width << STEP_BITS))
                .otherwise(start + F.when(nearer & F.lit(last), F.lit(width)).otherwise(F.lit(0))).alias("cut"),
                F.when(F.col("bucket").isNull(), F.lit(0.0)).otherwise(F.col("left") - F.col("before")).alias("left"),
            ),
            "cut",
        )
    return state.select("source", "cut")


def _small(df: DataFrame, rows: int = 100_000) -> bool:
    """Whether a staged table may be broadcast: its rows are counted, not assumed."""
    return df.limit(rows + 1).count() <= rows


def document_hash(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return hash60(F.col(f"`{id_col}`"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...], share: float, most: float, id_col: str, text_col: str, source_col: str
) -> tuple[DataFrame, DataFrame]:
    """(rows, plan): the narrow rows (id, source, size, h), and per source its size, target,
    how often it is taken whole and the cut below which a hash is taken once more."""
    rows = stage(
        docs.select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
            document_hash(id_col, text_col).alias("h"),
        ),
        "sizes",
    )
    t = stage(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    t = t.withColumn("whole", whole)
    budgets = t.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    cuts = thresholds(rows, budgets).withColumnRenamed("source", "s2")
    plan = t.join(cuts, F.col("source").eqNullSafe(F.col("s2"))).select(
        F.col("source").alias("__s"), "source_size", "target", F.col("whole").alias("__whole"), F.col("cut").alias("__cut")
    )
    return rows, stage(plan, "plan")


def _copies(h: Column, most: float) -> Column:
    more = F.when(h < F.col("__cut"), 1).otherwise(0)
    return F.least(F.col("__whole") + more, F.ceil(F.lit(most))).cast("long")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per document: id, source, size, source_size, target (its source's) and
    copies, how many times the mix takes it."""
    rows, plan = mix_plan(docs, weights, share, most, id_col, text_col, source_col)
    side = F.broadcast(plan) if _small(plan) else plan
    return rows.join(side, F.col("source").eqNullSafe(F.col("__s"))).select(
        "id", "source", "size", "source_size", "target", _copies(F.col("h"), most).alias("copies")
    )


def mix_rows(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``docs`` as the mix takes them: a row per copy, columns unchanged.

    The plan per source comes from the narrow rows; the documents themselves are
    filtered and repeated in place, without a shuffle of their texts.
    """
    columns = docs.columns
    docs, (id_col, text_col, source_col) = numbered(docs, id_col, text_col, source_col)
    _, plan = mix_plan(docs, weights, share, most, id_col, text_col, source_col)
    side = (F.broadcast(plan) if _small(plan) else plan).drop("source_size", "target")
    return (
        docs.withColumn("__h", document_hash(id_col, text_col))
        .join(side, F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col("__s")))
        .withColumn("__n", _copies(F.col("__h"), most).cast("int")).where("__n > 0")
        .withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n"))))
        .select(*docs.columns).toDF(*columns)
    )
