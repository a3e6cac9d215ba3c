"""Publication in versions: each in a folder of its own, one switch of the catalog entry, older versions kept for readers."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.catalog import _checked

_FOLDER = re.compile(r"v(\d{6})-[0-9a-f]{8}")


@dataclass(frozen=True)
class Version:
    """A version's number, folder, and the rows that were written and read back."""

    number: int
    path: str
    rows: int | None = None


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[Version]:
    """The finished versions below `root`, oldest first."""
    fs, path = _folder(spark, root)
    if not fs.exists(path(root)):
        return []
    found = []
    for status in fs.listStatus(path(root)):
        name = status.getPath().getName()
        if (match := _FOLDER.fullmatch(name)) and fs.exists(path(f"{root}/{name}/_SUCCESS")):
            found.append(Version(int(match[1]), f"{root}/{name}"))
    return sorted(found, key=lambda v: (v.number, v.path))


def switch(spark: SparkSession, name: str, version: Version) -> None:
    """Let the catalog entry `name` stand for a version, in one change: readers find it before and after."""
    where = version.path.replace("`", "``")
    spark.sql(f"create or replace view {_checked(name)} as select * from parquet.`{where}`")


def publish_version(df: DataFrame, name: str, root: str, keep: int = 3) -> Version:
    """Write `df` as the next version below `root` and switch `name` to it once its rows are read back in full.

    No folder is renamed or written twice, so no reader finds the table absent, on object stores either, and one that began with
    an older version ends with it: the `keep` newest versions stay, the one published included. Columns may
    change from version to version. A write that fails leaves the published version as it is; its folder is removed with
    the next expiry. Publishing under one name is for one writer at a time.
    """
    if keep < 2:
        raise ValueError("readers of the version before need it: keep two at least")
    _checked(name)
    spark = df.sparkSession
    before = versions(spark, root)
    number = before[-1].number + 1 if before else 1
    path = f"{root}/v{number:06d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    written, read = seen.get["rows"], spark.read.parquet(path).count()
    if written != read:
        raise RuntimeError(f"{path}: wrote {written} rows but read {read}")
    version = Version(number, path, read)
    switch(spark, name, version)
    expire(spark, root, keep)
    return version


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove all but the `keep` newest finished versions, and unfinished ones older than these; the folders removed."""
    kept = versions(spark, root)[-keep:]
    if not kept:
        return []
    fs, path = _folder(spark, root)
    removed = []
    for status in fs.listStatus(path(root)):
        place = status.getPath()
        match = _FOLDER.fullmatch(place.getName())
        if match and int(match[1]) <= kept[-1].number and f"{root}/{place.getName()}" not in {v.path for v in kept}:
            fs.delete(place, True)
            removed.append(f"{root}/{place.getName()}")
    return removed


def roll_back(spark: SparkSession, name: str, root: str, number: int) -> Version:
    """Let `name` stand for an older version that was kept."""
    for version in versions(spark, root):
        if version.number == number:
            switch(spark, name, version)
            return version
    raise ValueError(f"{root} has no version {number}")
