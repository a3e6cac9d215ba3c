"""Incremental landing without repeats: files that arrive twice, or overlap, give each event once.

Landed keys are kept in an index, by the day of the event and a hash bucket of the key. A batch reads the cells of the index that
its own events fall into, and no others: the current days, and for late repeats the few buckets of older days that they hash to.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.session import materialise, temporary_copies

DAY, BUCKET, BATCH = "__day", "__bucket", "__batch"
MOST_CELLS = 2_000  # beyond that many cells a filter by day and bucket apart is shorter


def _day(event_time: str | None) -> Column:
    """The day as text, which names a folder; events without a time share one."""
    if event_time is None:
        return F.lit("all")
    return F.coalesce(F.date_format(F.col(f"`{event_time}`").cast("date"), "yyyy-MM-dd"), F.lit("none"))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = left[DAY] == right[f"_{DAY}"]
    for i, key in enumerate(keys):
        condition = condition & left[key].eqNullSafe(right[f"_k{i}"])
    return condition


def _cells_of(rows: DataFrame) -> Column:
    """The filter of the index that keeps the cells of `rows`: as many as days times buckets there at most."""
    cells = rows.select(DAY, BUCKET).distinct().collect()
    if len(cells) > MOST_CELLS:
        return F.col(DAY).isin(sorted({c[DAY] for c in cells})) & F.col(BUCKET).isin(sorted({c[BUCKET] for c in cells}))
    by_day: dict[str, list[int]] = {}
    for cell in cells:
        by_day.setdefault(cell[DAY], []).append(cell[BUCKET])
    out = F.lit(False)
    for day, buckets in sorted(by_day.items()):
        out = out | ((F.col(DAY) == day) & F.col(BUCKET).isin(sorted(buckets)))
    return out


def _index_schema(rows: DataFrame, keys: Sequence[str]) -> StructType:
    kinds = [f"k{i} {rows.schema[key].dataType.simpleString()}" for i, key in enumerate(keys)]
    return StructType.fromDDL(", ".join([*kinds, f"{DAY} string", f"{BUCKET} int", f"{BATCH} bigint"]))


def _landed_keys(rows: DataFrame, index: str, keys: Sequence[str], number: int) -> DataFrame:
    """Keys that batches before `number` landed, in the cells of `rows`."""
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(index)
    schema = _index_schema(rows, keys)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(index).where(_cells_of(rows)).where(F.col(BATCH) < number)


def land_batch(batch: DataFrame, number: int, target: str, index: str, keys: Sequence[str], event_time: str | None, buckets: int) -> None:
    """Land the rows of a batch whose key no earlier batch landed, one a key; running a batch again replaces what it wrote."""
    spark = batch.sparkSession
    with temporary_copies(spark):
        spot = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
        marked = batch.withColumns({DAY: _day(event_time), BUCKET: spot}).dropDuplicates([DAY, *keys])
        marked = materialise(marked, "batch")  # which of several equal keys stays is settled here
        known = _landed_keys(marked, index, keys, number)
        known = known.select(F.col(DAY).alias(f"_{DAY}"), *[F.col(f"k{i}").alias(f"_k{i}") for i in range(len(keys))])
        fresh = materialise(marked.join(known, _same(marked, known, keys), "left_anti"), "fresh")
        fresh.drop(DAY, BUCKET).write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")
        entries = fresh.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], DAY, BUCKET, F.lit(number).cast("bigint").alias(BATCH))
        # a cell's keys come together: one file a cell and batch
        writer = entries.repartition(DAY, BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY, BUCKET, BATCH).parquet(index)


def land_unique(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    event_time: str | None = None,
    buckets: int = 16,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    **options: object,
) -> None:
    """Append the events of unseen files of `source` to `target`, each once, then stop; `read_landed` reads them.

    Events are the same where their `keys` are, null being a key like any other, and, with `event_time`, their day. Repeats are
    taken to be equal, one of them stays. However late a repeat comes, it is found. A run that dies is repeated without loss or
    repeats: each batch replaces what its first attempt wrote. `buckets` is fixed for a target; without `event_time` a batch
    reads the buckets its keys fall into over all days.
    """
    if not keys or buckets < 1:
        raise ValueError("keys and a positive number of buckets are needed")
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source)
    if transform is not None:
        rows = transform(rows)

    def land(batch: DataFrame, number: int) -> None:
        land_batch(batch, number, f"{target}/events", f"{target}/keys", keys, event_time, buckets)

    query = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(land).start()
    query.awaitTermination()


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """The landed events, each once."""
    return spark.read.parquet(f"{target}/events").drop(BATCH)
