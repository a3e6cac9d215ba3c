"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for. Shuffle width is left to the cluster: set
# `spark.sql.shuffle.partitions` high and let AQE coalesce.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can see, as the cluster names it.

    Only a local session without `spark.checkpoint.dir` falls back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tallyloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


# what `temporary_copies` will remove, innermost last
_watched: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_root(spark)}/tallyloom/{label}-{uuid.uuid4().hex}"
    if _watched:
        _watched[-1].append(path)
    return path


@contextlib.contextmanager
def temporary_copies(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what is stored in the shared folder inside; no result may depend on it then."""
    _watched.append([])
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in map(hadoop.Path, _watched.pop()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts lineage so that a lost executor re-reads files instead of recomputing, freezes
    values that depend on partitioning, and gives Catalyst real sizes for join choices.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
