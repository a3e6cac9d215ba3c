"""Incremental landing: take up the files that arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    **options: object,
) -> None:
    """Append unseen files of `source` to the Parquet table `target`, then stop.

    A scheduler calls this once per period. The checkpoint records which files were taken and
    the sink's log which outputs count, so a run that dies half-way is repeated without loss or
    duplicates. `transform` may be any row-wise operator of this library.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source)
    if transform is not None:
        rows = transform(rows)
    query = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
