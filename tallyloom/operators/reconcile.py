"""Comparing copies of a table, and a data dictionary over several tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_reconcile(source: DataFrame, copy: DataFrame, table: str) -> DataFrame:
    """Row counts of both sides and whether they agree."""
    counts = source.agg(F.count(F.lit(1)).alias("source_rows"))
    counts = counts.withColumn("copy_rows", copy.agg(F.count(F.lit(1))).scalar())
    gap = F.col("copy_rows") - F.col("source_rows")
    status = F.when(gap == 0, "match").otherwise("mismatch")
    return counts.select(F.lit(table).alias("table_name"), "*", gap.alias("row_gap"), status.alias("status"))


def zone_counts(places: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Row counts of tables in several places, a row a table; `match` where all that have it agree.

    `places` maps a place to its tables by name. Columns: table_name, `<place>_rows` in the order given,
    status. Each count reads no column.
    """
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(place).alias("place"), "n")
        for place, tables in places.items()
        for name, df in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, counted)
    columns = [F.max(F.when(F.col("place") == place, F.col("n"))).alias(f"{place}_rows") for place in places]
    status = F.when(F.min("n") == F.max("n"), "match").otherwise("mismatch")
    return rows.groupBy("table_name").agg(*columns, status.alias("status"))


def distinct_values(df: DataFrame) -> DataFrame:
    """Exact number of distinct values per column, nulls apart.

    Columns of one type are unpivoted together to (column, value) pairs, in their own type, and
    partial aggregation shrinks the pairs before the shuffle. Each type reads its columns only.
    """
    by_type: dict[str, list[str]] = {}
    for field in df.schema.fields:
        by_type.setdefault(field.dataType.simpleString(), []).append(field.name)
    counts = None
    for names in by_type.values():
        quoted = [F.col(f"`{name}`") for name in names]
        pairs = df.select(*quoted).unpivot([], quoted, "column_name", "value").distinct()
        counted = pairs.groupBy("column_name").agg(F.count("value").alias("distinct_values"))
        counts = counted if counts is None else counts.unionByName(counted)
    return counts


def column_contents(df: DataFrame, distinct: str | None = "approx", checksum: bool = True) -> DataFrame:
    """Per column: type, rows, values, distinct values and an order-free checksum.

    `distinct="approx"` estimates distinct values in the same single pass as the rest, the same for the
    same values in any order; `"exact"` adds a shuffle of the distinct (column, value) pairs; `None`
    leaves them out. The checksum is the sum of the value hashes.
    """
    if distinct not in ("exact", "approx", None):
        raise ValueError(f"distinct must be 'exact', 'approx' or None, not {distinct!r}")
    per_column = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        measures = [
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("row_count"),
            F.count(value).alias("values"),
        ]
        if distinct == "approx":
            measures.append(F.approx_count_distinct(value).alias("distinct_values"))
        if checksum:
            hashed = F.when(value.isNotNull(), F.xxhash64(value).cast("decimal(20,0)"))
            measures.append(F.sum(hashed).alias("checksum"))
        per_column.append(F.struct(*measures))
    contents = df.agg(F.array(*per_column).alias("columns")).select(F.inline("columns"))
    if distinct == "exact":
        # both sides have one row per column
        contents = contents.join(F.broadcast(distinct_values(df)), "column_name", "left")
        contents = contents.withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))
    return contents


def column_reconcile(
    source: DataFrame, copy: DataFrame, distinct: str | None = "approx", checksum: bool = True
) -> DataFrame:
    """Both sides column by column, in one pass of each. Columns of one side only are reported as such."""
    left = column_contents(source, distinct, checksum)
    right = column_contents(copy, distinct, checksum)
    measures = [c for c in left.columns if c not in ("column_name", "row_count")]
    left = left.select("column_name", *[F.col(c).alias(f"source_{c}") for c in measures])
    right = right.select(
        F.col("column_name").alias("__column"), *[F.col(c).alias(f"copy_{c}") for c in measures]
    )
    joined = left.join(right, left["column_name"] == right["__column"], "full")
    same: Column = F.lit(True)
    for c in measures:
        same = same & F.col(f"source_{c}").eqNullSafe(F.col(f"copy_{c}"))
    status = (
        F.when(F.col("__column").isNull(), "missing in copy")
        .when(F.col("column_name").isNull(), "missing in source")
        .when(same, "match")
        .otherwise("mismatch")
    )
    return joined.select(
        F.coalesce("column_name", "__column").alias("column_name"),
        *[F.col(f"{side}_{c}") for c in measures for side in ("source", "copy")],
        status.alias("status"),
    )


def parity(left: DataFrame, right: DataFrame, category: str, names: tuple[str, str]) -> DataFrame:
    """Rows and distinct categories of two published objects, side by side."""

    def measured(df: DataFrame, name: str) -> DataFrame:
        groups = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
        return groups.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(category).alias("categories")
        ).select(F.lit(name).alias("object_name"), "*")

    return measured(left, names[0]).unionByName(measured(right, names[1]))


# an estimate of distinct values this far below the rows (four standard errors) rules a key out
KEY_SHARE = 0.8


def data_dictionary(tables: Mapping[str, DataFrame], distinct: str = "approx") -> DataFrame:
    """Table, column, position, type, rows, nulls, distinct values, and whether it could be a key.

    With estimates a column is no key (false) where it has nulls or far fewer values than rows, else that is open
    (null); `distinct="exact"` settles it, by a shuffle of the distinct values.
    """
    parts = []
    for table, df in tables.items():
        contents = column_contents(df, distinct, checksum=False)
        positions = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns, 1) for x in (c, i)])
        nulls = F.col("row_count") - F.col("values")
        if distinct == "exact":
            is_key = (nulls == 0) & (F.col("distinct_values") == F.col("row_count"))
        else:
            ruled_out = (nulls > 0) | (F.col("distinct_values") < KEY_SHARE * F.col("row_count"))
            is_key = F.when(ruled_out, F.lit(False))
        parts.append(
            contents.select(
                F.lit(table).alias("table_name"),
                "column_name",
                positions[F.col("column_name")].alias("position"),
                "data_type",
                "row_count",
                nulls.alias("null_count"),
                "distinct_values",
                is_key.alias("is_key"),
            )
        )
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined
