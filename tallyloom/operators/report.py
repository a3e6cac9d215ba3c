"""Profiles and distributions. Each report reads its input once, however many columns it covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    FractionalType,
    MapType,
    NumericType,
    StructField,
    TimestampNTZType,
    TimestampType,
)

from tallyloom.functions.numbers import percent
from tallyloom.operators.scalars import with_scalar

_FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def null_profile(df: DataFrame, nan_is_null: bool = False) -> DataFrame:
    """Missing values per column: count and percentage.

    `nan_is_null` counts NaN of fractional columns as missing too.
    """
    per_column = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.count_if(_missing(field, nan_is_null)).alias("null_count"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for field in df.schema.fields
    ]
    counted = df.agg(F.array(*per_column).alias("columns")).select(F.inline("columns"))
    share = percent(F.col("null_count"), F.col("row_count"))
    return counted.select("column_name", "null_count", share.alias("null_pct"))


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, nulls, smallest and largest value as text, mean and deviation.

    Dates and text have a smallest and largest value as well; mean and deviation are numeric only.
    Fixed-width columns and the others form two aggregates over disjoint columns: a text minimum
    among them would keep all the numbers out of the generated hash aggregate.
    """
    fixed = [f for f in df.schema.fields if isinstance(f.dataType, _FIXED_WIDTH)]
    other = [f for f in df.schema.fields if not isinstance(f.dataType, _FIXED_WIDTH)]
    parts = [_profile(df, fields) for fields in (fixed, other) if fields]
    profiled = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    share = percent(F.col("null_count"), F.col("row_count"))
    return profiled.withColumn("null_pct", share)


def _profile(df: DataFrame, fields: Sequence[StructField]) -> DataFrame:
    per_column = []
    for field in fields:
        value = F.col(f"`{field.name}`")
        numeric = isinstance(field.dataType, NumericType)
        ordered = not isinstance(field.dataType, MapType)
        per_column.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(_missing(field, False)).alias("null_count"),
                (F.min(value) if ordered else F.lit(None)).cast("string").alias("min_value"),
                (F.max(value) if ordered else F.lit(None)).cast("string").alias("max_value"),
                (F.avg(value) if numeric else F.lit(None)).cast("double").alias("mean"),
                (F.stddev_samp(value) if numeric else F.lit(None)).cast("double").alias("stddev"),
            )
        )
    return df.agg(F.array(*per_column).alias("columns")).select(F.inline("columns"))


def summary_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, smallest and largest value of numeric columns, one row each."""
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("value_count"),
            F.avg(c).cast("double").alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min_value"),
            F.max(c).cast("double").alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(F.array(*per_column).alias("columns")).select(F.inline("columns"))


def with_share(counts: DataFrame, count: str = "row_count", name: str = "pct") -> DataFrame:
    """Add each group's share of all rows to a table of group counts.

    The total is a scalar subquery over the same grouped result, whose shuffle is reused; a
    window over all groups would put a high-cardinality result into one task.
    """
    total = counts.agg(F.sum(count)).scalar()
    return with_scalar(counts, total, lambda t: {name: percent(F.col(count), t)})


def value_distribution(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and share per combination of key values."""
    return with_share(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")))


def distribution_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and share per value, for several columns in one pass.

    Each row is unpivoted to one line per column, which partial aggregation shrinks again
    before the shuffle.
    """
    values = [F.col(c).cast("string").alias(c) for c in columns]
    long = df.select(*values).unpivot([], list(columns), "column_name", "value")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.call_function("div", F.sum("row_count"), F.lit(len(columns)))).scalar()
    return with_scalar(counts, total, lambda t: {"pct": percent(F.col("row_count"), t)})


def top_groups(df: DataFrame, keys: Sequence[str], k: int, largest: bool = True) -> DataFrame:
    """The `k` largest (or smallest) groups by row count; ties go to the smaller key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    order = F.col("row_count").desc() if largest else F.col("row_count").asc()
    return counts.orderBy(order, *keys).limit(k)


def frequent_values(df: DataFrame, column: str, measure: str, k: int = 10) -> DataFrame:
    """The `k` most frequent repeated values with the average of a measure."""
    groups = df.dropna(subset=[column]).groupBy(column)
    repeated = groups.agg(F.count(F.lit(1)).alias("frequency"), F.avg(measure).alias("avg_measure"))
    return repeated.filter("frequency > 1").orderBy(F.desc("frequency"), column).limit(k)


def problem_values(df: DataFrame, column: str, pattern: str = "[^a-zA-Z ]", shortest: int = 3) -> DataFrame:
    """Distinct values that match `pattern` or are too short."""
    value = F.col(column)
    return df.select(column).filter(value.rlike(pattern) | (F.length(value) < shortest)).distinct()


def problem_summary(df: DataFrame, column: str, is_problem: Column) -> DataFrame:
    """One row: distinct values, how many are problems, and both shares."""
    values = df.select(column).distinct()
    counts = values.agg(
        F.count(column).alias("distinct_values"), F.count_if(is_problem).alias("problem_values")
    )
    clean = F.col("distinct_values") - F.col("problem_values")
    return counts.select(
        "*",
        clean.alias("clean_values"),
        percent(F.col("problem_values"), F.col("distinct_values")).alias("problem_pct"),
        percent(clean, F.col("distinct_values")).alias("clean_pct"),
    )


def value_changes(df: DataFrame, before: str, after: str) -> DataFrame:
    """Distinct pairs of values that cleaning changed."""
    return df.select(before, after).filter(F.col(before) != F.col(after)).distinct()


def market_share(df: DataFrame, keys: Sequence[str], averages: Sequence[str] = ()) -> DataFrame:
    """Members per group, their share of all members, and rounded averages."""
    means = [F.round(F.avg(c), 2).alias(f"avg_{c}") for c in averages]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("members"), *means)
    return with_share(groups, "members", "market_share_pct")


def consolidation(before: DataFrame, after: DataFrame, column: str, after_column: str | None = None) -> DataFrame:
    """One row: distinct values before and after cleaning and the share that was merged away."""
    original = before.agg(F.count_distinct(column)).scalar()
    final = after.agg(F.count_distinct(after_column or column).alias("final_values"))
    merged = F.col("original_values") - F.col("final_values")
    return final.select(original.alias("original_values"), "final_values").select(
        "*", merged.alias("consolidated"), percent(merged, F.col("original_values")).alias("consolidation_pct")
    )


def review_stats(df: DataFrame, id_columns: Sequence[str], measure: str, text: str) -> DataFrame:
    """One row: reviews, distinct ids, average score, reviews with text.

    Grouping by id first keeps the distinct count a plain sum of groups.
    """
    per_id = df.groupBy(*id_columns).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(measure).cast("double")).alias("total"),
        F.count(measure).alias("scored"),
        F.count(text).alias("texts"),
    )
    return per_id.agg(
        F.sum("n").alias("total_reviews"),
        F.count(F.lit(1)).alias("unique_reviews"),
        F.try_divide(F.sum("total"), F.sum("scored")).alias("avg_score"),
        F.sum("texts").alias("reviews_with_text"),
    )


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, and per column the number and share of rows that have a value."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count(c).alias(f"{c}_rows") for c in columns]
    )
    shares = {f"{c}_pct": percent(F.col(f"{c}_rows"), F.col("total_rows")) for c in columns}
    return counted.withColumns(shares)


def _missing(field, nan_is_null: bool) -> Column:
    value = F.col(f"`{field.name}`")
    if nan_is_null and isinstance(field.dataType, FractionalType):
        return value.isNull() | F.isnan(value)
    return value.isNull()
