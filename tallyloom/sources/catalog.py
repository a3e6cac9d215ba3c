"""Publishing tables under a name and querying them with SQL."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# rows of about 150 bytes take some 300 MB of a task that sorts them; beyond 200 buckets, tasks that deal rows out sort theirs too
BUCKET_ROWS = 2_000_000

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def _checked(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return name


def publish_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A session view over a Parquet path; reads stay lazy and prune columns and rows."""
    spark.read.parquet(path).createOrReplaceTempView(_checked(name))
    return spark.table(name)


def create_external_table(spark: SparkSession, name: str, source: str, location: str) -> DataFrame:
    """Materialise a view or table as a Parquet table at a location, replacing an older entry.

    Dropping the entry leaves earlier files where they are; pass a fresh location per version.
    """
    where = location.replace("'", "\\'")
    spark.sql(f"drop table if exists {_checked(name)}")
    spark.sql(
        f"create table {name} using parquet options (compression 'snappy') "
        f"location '{where}' as select * from {_checked(source)}"
    )
    return spark.table(name)


def bucket_count(tables: Sequence[DataFrame], least: int = 8, rows: int = BUCKET_ROWS) -> int:
    """Buckets for tables that are joined by key: `least`, doubled until a bucket of the longest has about `rows` rows or fewer.

    A bucket is one task, so a fixed number of them lets tasks grow with the table. The tables are counted, Parquet ones from
    their footers. Pass fewer `rows` where they are wide.
    """
    if least < 1 or rows < 1:
        raise ValueError("positive numbers of buckets and rows are needed")
    longest, buckets = max(df.count() for df in tables), least
    while longest > buckets * rows:
        buckets *= 2
    return buckets


def create_bucketed_table(
    df: DataFrame, name: str, location: str, keys: Sequence[str], buckets: int, sort: bool = True
) -> DataFrame:
    """Store `df` as a table by the hash of `keys`, each bucket sorted by them, replacing an older entry.

    Joins and groupings by the keys of tables with equally many buckets need no exchange of them. Rows are dealt to buckets before the
    write, so that each is one file. Keys that fill a large share of the table belong in no bucket: a bucket is sorted and read by
    one task; `bucket_count` has a number of buckets that fits the tables. Dropping the entry leaves earlier files where they are; pass a fresh location per version.
    """
    spark = df.sparkSession
    spark.sql(f"drop table if exists {_checked(name)}")
    # the hash of the bucketed writer is that of the exchange
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    writer = dealt.write.format("parquet").option("path", location).option("compression", "snappy").bucketBy(buckets, *keys)
    (writer.sortBy(*keys) if sort else writer).saveAsTable(name)
    return spark.table(name)


def query_published(spark: SparkSession, statement: str) -> DataFrame:
    """Spark SQL over the published names."""
    return spark.sql(statement)
