"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the engine relies on.  AQE re-plans joins and coalesces/splits
# shuffle partitions at run time; skew-join splitting covers a hot review id
# or app id on the shuffled joins.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "reviewlake") -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, ANSI on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The cluster names its shared folder in ``spark.checkpoint.dir``; it is read
    from the session.  Only a single-machine session (``local[...]``, as in tests)
    may go without it; then a local folder is chosen and registered.  Every call returns a new
    sub-folder so runs never clash.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local["):  # on a cluster a local folder would be one per machine
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="reviewlake-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # core settings may be read-only at run time; the context keeps it
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), "reviewlake", *parts, uuid.uuid4().hex])


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in it remove their shuffle files as they end, not when the driver next collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of staged files that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the engine settings to a session created elsewhere (driver, cluster)."""
    for k, v in ENGINE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings stay as the cluster has them
            pass
