"""Files that tasks write to and read from the shared folder.

A task writes under a name of its own and reports it in a row; Spark commits the rows of the attempt
that counts, so files of lost or repeated attempts are never read. Paths are local or URIs that pyarrow
knows (file, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import inspect
import io
import pathlib
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import scratch_path, shared_root

MOST_READERS = 10_000


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def new_file(folder: str, suffix: str):
    """A path that no other attempt uses, and its open stream."""
    system, base = _at(folder)
    system.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", system.open_output_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20)


def open_file(path: str):
    """Random access."""
    system, base = _at(path)
    return system.open_input_file(base)


def open_stream(path: str):
    system, base = _at(path)
    return system.open_input_stream(base, compression=None, buffer_size=1 << 20)


def remove(path: str) -> None:
    system, base = _at(path)
    if system.get_file_info(base).type == fs.FileType.File:
        system.delete_file(base)


def one_each(files: DataFrame) -> DataFrame:
    """The rows dealt over tasks, one file a task where there are not too many."""
    return files.repartition(max(1, min(MOST_READERS, files.count())))


def default_folder(spark: SparkSession, folder: str | None, label: str) -> str:
    return folder or scratch_path(spark, label)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this library: its modules as one archive, added once to the session's context."""
    context = spark.sparkContext
    if getattr(context, "_tallyloom_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.writestr(str(path.relative_to(package.parent)), path.read_bytes())
    path, stream = new_file(f"{shared_root(spark)}/tallyloom", ".zip")
    with stream:
        stream.write(archive.getvalue())
    context.addPyFile(path)
    context._tallyloom_shipped = True


# the size Spark has by itself, and ours: a task holds a batch several times over, in the JVM and in Python
SPARK_BATCH, BATCH = f"{64 << 20}b", f"{4 << 20}b"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def _prepare(spark: SparkSession) -> None:
    """Workers that know this library, and Arrow batches of BATCH unless the session says otherwise."""
    ship(spark)
    if spark.conf.get(BATCH_CONF) == SPARK_BATCH:
        spark.conf.set(BATCH_CONF, BATCH)


_HELD: dict[str, dict] = {}


def held(name: str) -> dict:
    """A table that a worker process keeps from task to task, for tasks that say they use it."""
    return _HELD.setdefault(name, {})


def let_go(uses: str = "") -> None:
    """Empty the tables that are held for tasks of another kind: a worker serves one job after the other."""
    for name, table in _HELD.items():
        if name != uses:
            table.clear()


def in_arrow(df: DataFrame, function, schema, uses: str = "") -> DataFrame:
    """`mapInArrow`; a task keeps no table of a worker but the one it `uses`, and gives back its unused memory at the end."""
    _prepare(df.sparkSession)

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(uses)
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def in_pandas(grouped, spark: SparkSession, function, schema: str) -> DataFrame:
    """`applyInPandas` on workers that know this library, for functions of a frame, or of a key and a frame; no table is kept."""
    _prepare(spark)

    def of_frame(frame):
        let_go()
        return function(frame)

    def of_key(key, frame):
        let_go()
        return function(key, frame)

    return grouped.applyInPandas(of_key if len(inspect.signature(function).parameters) == 2 else of_frame, schema)
