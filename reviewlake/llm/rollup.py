"""Token counts as delta-maintained rollups.

Totals (documents and tokens by source, language and tokenizer version) are additive, so
a change only has to add its difference: an insert adds the new count, a delete takes
the old one off, a revision does both.  A batch of changes is reduced to its signed sums
per group, map-side first, and committed as one folder named by the batch; a batch that
is already committed is skipped, so replays and retries change nothing.  Totals are the
sums over the committed batches.

A batch is committed when Spark's ``_SUCCESS`` mark is in its folder.  A folder without
it (a lost driver) is ignored by readers and written anew by the next try.

Edge cases, all defined: null sources, languages and texts are groups and empty texts of
their own; repeated rows count once each; a batch without rows commits nothing but its
name; groups whose documents and tokens are all gone are not returned; extra columns are
ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.tokens import slices, word_ids

KEYS = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, documents bigint, tokens bigint"
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def token_counts(docs: DataFrame, tokenizer: str, *text_cols: str) -> DataFrame:
    """``docs`` with the text columns replaced by their numbers of ids (null text: 0)."""
    keep = [c for c in docs.columns if c not in text_cols]
    src = docs.select(*keep, *text_cols)
    schema = T.StructType([*[docs.schema[c] for c in keep], *[T.StructField(c, T.LongType()) for c in text_cols]])

    def run(batches):
        enc = word_ids(tokenizer)
        for b in batches:
            counts = []
            for i in range(len(keep), b.num_columns):
                n: list[int] = []
                for texts in slices(b.column(i).to_pylist()):
                    n += [len(x) // 4 for x in enc.encode(texts)]
                counts.append(pa.array(n, pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *counts], names=schema.names)

    return src.mapInArrow(run, schema)


def signed(changes: DataFrame) -> DataFrame:
    """The difference each group makes.  ``changes`` has the keys and the columns ``before``
    and ``after``: a document's count before the change (null: it was not there) and after
    it (null: it is deleted)."""
    there = lambda c: F.when(F.col(c).isNotNull(), 1).otherwise(0)
    return changes.groupBy(*KEYS).agg(
        F.sum(there("after") - there("before")).cast("long").alias("documents"),
        F.sum(F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))).cast("long").alias("tokens"),
    )


class TokenRollup:
    """The committed batches below one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def committed(self) -> list[str]:
        """Names of the committed batches (folders, not data)."""
        fs, path = self._fs()
        if not fs.exists(path(self.root)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(self.root))]
        return sorted(n[6:] for n in names if n.startswith("batch=") and fs.exists(path(f"{self.root}/{n}/_SUCCESS")))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Commits a batch once; False if it was committed before."""
        if batch_id in self.committed():
            return False
        signed(changes).write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")
        return True

    def totals(self) -> DataFrame:
        paths = [f"{self.root}/batch={b}" for b in self.committed()]
        rows = self.spark.read.schema(TOTALS).parquet(*paths) if paths else self.spark.createDataFrame([], TOTALS)
        return rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where(
            "documents <> 0 OR tokens <> 0"
        )
