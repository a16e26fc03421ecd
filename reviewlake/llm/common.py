"""Helpers shared by the training-data operators: table reading and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a single-machine session (``local[...]``, as in tests) may go without the
    setting; any other session without it is an error, because executors could not
    see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="reviewlake-")
    return "/".join([base.rstrip("/"), "llm", *parts, uuid.uuid4().hex])


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps neither
    recompute it nor depend on the executors that made it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns can never clash with the operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named c0, c1, ..., and the new names of ``names``: no column of
    the caller can then clash with an operator's own."""
    new = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*new.values()), [new[n] for n in names]


def crc_bucket(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; a null value counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def connected(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of an undirected edge list (columns ``a``, ``b``, any order).

    Alternates large-star and small-star steps (each edge is re-pointed to the
    smallest neighbour) until every tree is a star; every round is staged in the shared
    folder.  Returns (node, comp) for every node that has an edge, comp being the
    smallest node of its component.
    """
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)

    def open_nodes(x: DataFrame) -> int:
        """Nodes that still have two smaller neighbours, or a smaller and a larger one; without any, all trees are stars."""
        ends = x.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(x.select("b", F.lit(0), F.lit(1)))
        by = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return by.where("up > 1 OR (up = 1 AND down = 1)").count()

    while open_nodes(e):
        # large star: every larger neighbour of u is linked to the smallest of u's neighbourhood
        both = e.union(e.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its smaller neighbours are linked to the smallest of them (both uses of `large` share its shuffle)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        e = stage(small, name)
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    )
