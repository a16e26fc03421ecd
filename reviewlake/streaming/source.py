"""A bounded, resumable stream source whose offset is the feed's own batch number.

``feed_batches`` yields batch numbers, ``step`` of them a micro-batch, from ``after`` (the
last one committed) to ``last`` (the run's bound).  The stream's checkpoint therefore holds
a batch number, never file times: a restart goes on at the right batch, and ``last`` is where
``max_batches`` ends a run.  The rows of a micro-batch are read by Spark from the landing
partitions of its numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from reviewlake.session import shuffles_freed


class LateBatch(RuntimeError):
    """A batch landed behind one that is already processed; taking it in now would break feed order."""


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class BatchNumberReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.after, self.last, self.step = (int(options[k]) for k in ("after", "last", "step"))
        self.at = self.after

    def initialOffset(self) -> dict:
        return {"batch_no": self.after}  # may be asked for after latestOffset()

    def latestOffset(self) -> dict:
        self.at = max(self.at, min(self.at + self.step, self.last))
        return {"batch_no": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at, end["batch_no"])  # a replayed micro-batch may lie ahead of ``after``
        return [_Range(start["batch_no"] + 1, end["batch_no"])]

    def read(self, partition: _Range):
        for k in range(partition.low, partition.high + 1):
            yield (k,)


class BatchNumbers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feed_batches"

    def schema(self) -> str:
        return "batch_no bigint"

    def streamReader(self, schema) -> BatchNumberReader:
        return BatchNumberReader(self.options)


def batches_per_trigger(spark: SparkSession, landing: str, batches: int, volume: int, least: int = 10) -> int:
    """Batches that make up about ``volume`` landed bytes (``least`` at least), by the landing folder's total."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    total = fs.getContentSummary(p).getLength() if batches else 0
    return max(least, batches * volume // max(total, 1)) if total else least


def land_batches(feed: DataFrame, landing: str) -> None:
    """Adds a feed with ``batch_no`` to the landing folder, one folder with a gzip file per batch."""
    with shuffles_freed(feed.sparkSession):
        feed.repartition("batch_no").write.mode("append").option("compression", "gzip").partitionBy("batch_no").json(landing)


def landed_batches(spark: SparkSession, landing: str) -> list[int]:
    """Numbers of the landed ``batch_no=<n>`` folders (a listing of names, no data)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = (st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"batch_no=(\d+)", n)))
