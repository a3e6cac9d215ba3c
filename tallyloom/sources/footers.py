"""Row counts and extremes of Parquet tables from the footers of their files; no data page is read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, FloatType, IntegralType

_KEPT = (IntegralType, DoubleType, FloatType, BooleanType, DateType)


def _reader(spark: SparkSession) -> SparkSession:
    """A session beside the caller's in which the Parquet reader answers aggregates; settings of the caller's stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_aggregate(spark: SparkSession, path: str, extremes: Sequence[str] = ()) -> DataFrame:
    """One row, in a session of its own: row_count, and min_x and max_x of each column x of `extremes`.

    Footers keep extremes of numbers, booleans and dates; another type is an error.
    """
    rows = _reader(spark).read.parquet(path)
    for c in extremes:
        if not isinstance(rows.schema[c].dataType, _KEPT):
            raise ValueError(f"{c}: the reader has no extremes of {rows.schema[c].dataType.simpleString()}")
    ends: list[Column] = [f(c).alias(f"{name}_{c}") for c in extremes for name, f in (("min", F.min), ("max", F.max))]
    return rows.agg(F.count(F.lit(1)).alias("row_count"), *ends)


def footer_figures(spark: SparkSession, path: str, extremes: Sequence[str] = ()) -> DataFrame:
    """The row of `footer_aggregate`, read at once, in the caller's session. A table without rows has none in its footers: 0."""
    found = footer_aggregate(spark, path, extremes)
    row = found.first()
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return spark.createDataFrame([(row["row_count"] or 0, *row[1:])], kinds)


def footer_counts(spark: SparkSession, places: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Row counts of Parquet tables in several places, as `zone_counts` has them, from their footers.

    `places` maps a place to its tables' paths by name.
    """
    counted = [
        footer_figures(spark, path).select(F.lit(name).alias("table_name"), F.lit(place).alias("place"), F.col("row_count").alias("n"))
        for place, tables in places.items()
        for name, path in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, counted)
    columns = [F.max(F.when(F.col("place") == place, F.col("n"))).alias(f"{place}_rows") for place in places]
    status = F.when(F.min("n") == F.max("n"), "match").otherwise("mismatch")
    return rows.groupBy("table_name").agg(*columns, status.alias("status"))
