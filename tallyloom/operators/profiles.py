"""Profiles that grow with a table: figures of each landed part are kept and merged, old rows are not read again."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    MapType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from tallyloom.functions.numbers import percent
from tallyloom.operators.fitted import Figures, Fitted
from tallyloom.operators.stats import QUARTERS

QUANTILE_ITEMS = 400  # items of a quantile sketch: ranks are off by less than one per cent
SKETCH_BITS = 12  # 4096 registers: the estimate's standard error is 1.04 / 64, that is 1.6 per cent
SCHEMA = (
    "column_name string, position int, data_type string, row_count bigint, null_count bigint, min_value string, max_value string, "
    "mean double, spread double, sketch binary, quantiles binary, part string"
)


def _sketched(field: StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (IntegralType, StringType, BinaryType)):
        return value
    return F.to_json(F.struct(value)) if isinstance(field.dataType, MapType) else value.cast("string")


def part_profile(df: DataFrame, part: str) -> DataFrame:
    """Figures of one part, a row a column, that `merged_profile` can put together; one pass."""
    figures = []
    for position, field in enumerate(df.schema.fields, 1):
        value = F.col(f"`{field.name}`")
        numeric, ordered = isinstance(field.dataType, NumericType), not isinstance(field.dataType, MapType)
        number = value.cast("double") if numeric else F.lit(None).cast("double")
        figures.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(position).alias("position"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(value.isNull()).alias("null_count"),
                (F.min(value) if ordered else F.lit(None)).cast("string").alias("min_value"),
                (F.max(value) if ordered else F.lit(None)).cast("string").alias("max_value"),
                F.avg(number).alias("mean"),
                # the sum of squared distances from the mean
                (F.var_pop(number) * F.count(number)).alias("spread"),
                F.hll_sketch_agg(_sketched(field), F.lit(SKETCH_BITS)).alias("sketch"),
                (F.kll_sketch_agg_double(number, F.lit(QUANTILE_ITEMS)) if numeric else F.lit(None).cast("binary")).alias("quantiles"),
            )
        )
    return df.agg(F.array(*figures).alias("columns")).select(F.inline("columns")).withColumn("part", F.lit(part))


def store_part(df: DataFrame, part: str, path: str) -> None:
    """Keep a part's figures below `path`; storing a part again replaces its figures."""
    if not part or "/" in part:
        raise ValueError(f"not a part's name: {part!r}")
    part_profile(df, part).coalesce(1).write.mode("overwrite").parquet(f"{path}/{part}")


def stored_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def _typed_ends(stored: DataFrame) -> DataFrame:
    """Smallest and largest value per column, compared in the column's type."""
    kinds = [r["data_type"] for r in stored.select("data_type").distinct().collect()]  # the table's types
    parts = []
    for kind in kinds:
        own = stored.where(F.col("data_type") == kind)
        if kind.startswith(("map<", "array<", "struct<")):  # not read back from text; the text is compared
            least, most = F.min("min_value"), F.max("max_value")
        else:
            least, most = F.min(F.col("min_value").try_cast(kind)), F.max(F.col("max_value").try_cast(kind))
        parts.append(own.groupBy("column_name", "data_type").agg(least.cast("string").alias("min_value"), most.cast("string").alias("max_value")))
    return reduce(DataFrame.unionByName, parts)


def merged_profile(stored: DataFrame) -> DataFrame:
    """Per column over all parts: what `table_profile` of the whole table has, and distinct_estimate.

    All but the estimate are exact (mean and deviation up to rounding); it has a standard error of 1.6 per cent however many
    parts there are. The figures are read, no row of the table is.
    """
    figures = ["column_name", "position", "data_type", "row_count", "null_count", "min_value", "max_value", "mean", "stddev", "distinct_estimate", "null_pct"]
    if stored.isEmpty():
        types = {"position": "int", "row_count": "bigint", "null_count": "bigint", "distinct_estimate": "bigint", "mean": "double", "stddev": "double", "null_pct": "double"}
        return stored.sparkSession.createDataFrame([], ", ".join(f"{c} {types.get(c, 'string')}" for c in figures))
    key = ["column_name", "data_type"]
    n = F.col("row_count") - F.col("null_count")
    totals = stored.groupBy(*key).agg(
        F.min("position").alias("position"),
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.try_divide(F.sum(n * F.col("mean")), F.sum(F.when(F.col("mean").isNotNull(), n))).alias("mean"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )
    # a row a column: spreads of the parts around the mean of all
    centre = totals.select(*[F.col(c).alias(f"_{c}") for c in key], F.col("mean").alias("centre"))
    same = (F.col("column_name") == F.col("_column_name")) & (F.col("data_type") == F.col("_data_type"))
    apart = F.col("mean") - F.col("centre")
    spreads = stored.join(F.broadcast(centre), same).groupBy(*key).agg(F.sum(F.col("spread") + n * apart * apart).alias("spread"))
    ends = _typed_ends(stored)
    merged = totals.join(F.broadcast(spreads), key).join(F.broadcast(ends), key)
    values = F.col("row_count") - F.col("null_count")
    merged = merged.withColumns(
        {
            "stddev": F.when(values > 1, F.sqrt(F.col("spread") / (values - 1))),
            "null_pct": percent(F.col("null_count"), F.col("row_count")),
        }
    )
    return merged.select(*figures)


def grown_figures(stored: DataFrame, columns: Sequence[str] | None = None) -> Fitted:
    """Figures of numeric columns for `Fitted` to apply, from the stored parts alone.

    Counts, means, deviations and ends are those of the whole table; quartiles are estimates, values of the table whose
    rank is off by less than one per cent of the rows.
    """
    numeric = stored.where("mean is not null")
    if columns is not None:
        numeric = numeric.where(F.col("column_name").isin(list(columns)))
    merged = {r["column_name"]: r for r in merged_profile(numeric).collect()}  # a row a column
    shares = F.array(*[F.lit(s) for s in QUARTERS])
    sketches = numeric.where("quantiles is not null").groupBy("column_name").agg(F.kll_merge_agg_double("quantiles").alias("sketch"))
    quartiles = {r["column_name"]: r["q"] for r in sketches.select("column_name", F.kll_sketch_get_quantile_double("sketch", shares).alias("q")).collect()}
    out = {}
    for name, row in merged.items():
        kind = StructType.fromDDL(f"v {row['data_type']}")["v"].dataType
        typed = {FloatType: float, DoubleType: float}.get(type(kind), Decimal if isinstance(kind, DecimalType) else int)
        ends = tuple(typed(row[c]) for c in ("min_value", "max_value"))
        quarters = tuple(Decimal(str(q)).quantize(Decimal(1).scaleb(-kind.scale)) if typed is Decimal else typed(q) for q in quartiles[name])
        out[name] = Figures(row["data_type"], row["row_count"] - row["null_count"], row["mean"], row["stddev"], ends, quarters)
    return Fitted(out)
