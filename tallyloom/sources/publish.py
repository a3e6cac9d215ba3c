"""Writing tables: safe swap, verification, landing."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.sources.readers import load_with_schema, read_csv

TARGET_FILE_BYTES = 512 * 1024 * 1024
# files of partition values that a task keeps open at once; with more values it sorts the rows that are left
OPEN_VALUES = 16


@dataclass(frozen=True)
class Published:
    """What a publish wrote and what a fresh read of it found."""

    path: str
    rows_written: int
    rows_read: int | None
    files: int
    rows_rejected: int = 0

    @property
    def verified(self) -> bool:
        return self.rows_read == self.rows_written


def publish(
    df: DataFrame,
    path: str,
    compact: bool = False,
    target_file_bytes: int = TARGET_FILE_BYTES,
    partition_by: Sequence[str] = (),
    verify: bool = True,
) -> Published:
    """Write Parquet beside `path`, then put it in its place.

    A failed write leaves the old table where it is. The old table is renamed aside and the new one
    renamed in: between the two renames, and on object stores for as long as these take, readers
    find no table. `compact` and `partition_by` deal the rows out anew before the one write: into parts of
    about `target_file_bytes`, a small table into one file, a large one through many tasks; or by
    partition value, so that a value's rows are not spread over files from every task. The row count
    comes with the write itself; `verify` compares it with a count of the published files.
    """
    spark = df.sparkSession
    staged = _beside(path, "staged")
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        counted = counted.hint("rebalance", *partition_by)
    elif compact:
        counted = counted.hint("rebalance")
    writer = counted.write.mode("errorifexists")
    sizes = _part_sizes(target_file_bytes)
    if partition_by:
        sizes["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "true"
        sizes["spark.sql.maxConcurrentOutputFileWriters"] = str(OPEN_VALUES)
    with _settings(spark, sizes):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
    written = seen.get["rows"]
    _swap(spark, staged, path)
    files = _part_files(spark, path)
    read = spark.read.parquet(path).count() if verify else None
    result = Published(path, written, read, files)
    if verify and not result.verified:
        raise RuntimeError(f"{path}: wrote {written} rows but read {read}")
    return result


def _part_sizes(target: int) -> dict[str, str]:
    """Size before parallelism for the stage that writes; parts are measured as they are shuffled."""
    return {
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(min(target, 1 << 20)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
    }


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def write_rejects(df: DataFrame, path: str, as_csv: bool = False) -> None:
    """Keep rejected or duplicate rows for audit; Parquet unless a CSV is asked for."""
    writer = df.write.mode("overwrite")
    if as_csv:
        writer.options(
            header=True,
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
    else:
        writer.parquet(path)


@dataclass(frozen=True)
class RawTable:
    """A raw CSV source to land."""

    name: str
    path: str
    schema: StructType | str | None = None
    multi_line: bool = False


def land(
    spark: SparkSession, tables: Sequence[RawTable], zone: str, on_rejects: str = "record"
) -> list[Published]:
    """Land CSV sources as Parquet tables of a zone, each counted on the way in and out.

    Against a schema, lines with a value that does not convert or with the wrong number of fields do not
    land: they are kept, as text and with the columns at fault, in `<name>_rejects` beside the table,
    and counted in the result, so landed and rejected rows add up to the source. `on_rejects="fail"`
    raises once they are written. Without a schema the types are inferred and nothing is rejected.
    """
    if on_rejects not in ("record", "fail"):
        raise ValueError(f"on_rejects must be 'record' or 'fail', not {on_rejects!r}")
    landed = []
    for table in tables:
        path = f"{zone}/{table.name}.parquet"
        if table.schema is None:
            landed.append(publish(read_csv(spark, table.path, infer=True, multi_line=table.multi_line), path))
            continue
        schema = StructType.fromDDL(table.schema) if isinstance(table.schema, str) else table.schema
        good, bad = load_with_schema(spark, table.path, schema, table.multi_line)
        done = publish(good, path)
        seen = Observation()
        write_rejects(bad.observe(seen, F.count(F.lit(1)).alias("rows")), f"{zone}/{table.name}_rejects")
        landed.append(replace(done, rows_rejected=seen.get["rows"]))
        if on_rejects == "fail" and landed[-1].rows_rejected:
            raise ValueError(f"{table.path}: {landed[-1].rows_rejected} lines rejected, see {zone}/{table.name}_rejects")
    return landed


def _beside(path: str, label: str) -> str:
    return f"{path.rstrip('/')}.{label}-{uuid.uuid4().hex[:12]}"


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of `path`, so that any store Spark can write to works."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target, hadoop.Path


def _part_files(spark: SparkSession, path: str) -> int:
    fs, target, _ = _files(spark, path)
    found, count = fs.listFiles(target, True), 0
    while found.hasNext():
        count += found.next().getPath().getName().startswith("part-")
    return count


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    fs, target, make_path = _files(spark, path)
    previous = make_path(_beside(path, "previous"))
    had_previous = fs.exists(target)
    if had_previous and not fs.rename(target, previous):
        raise OSError(f"could not set aside {path}")
    if not fs.rename(make_path(staged), target):
        if had_previous:
            fs.rename(previous, target)
        raise OSError(f"could not move {staged} to {path}")
    if had_previous:
        fs.delete(previous, True)
