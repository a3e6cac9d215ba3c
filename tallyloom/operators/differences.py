"""Where two copies of a table differ: a tree of checksums, descended only where it differs.

Rows are dealt into buckets by a hash of their key, on several levels. A level's bucket has row counts and two sums of row
hashes; buckets whose figures agree on both sides are left behind, and only rows of the others are compared key by key. What
is shuffled is a row a bucket and task, and the rows of the buckets that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

BUCKETS = 1_024  # a level; two levels have a million at most, which are broadcast
SOURCE, COPY = 1, -1


def _shared(source: DataFrame, copy: DataFrame, keys: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    missing = [k for k in keys if k not in source.columns or k not in copy.columns]
    if missing:
        raise ValueError(f"keys that a side lacks: {missing}")
    wanted = source.columns if columns is None else columns
    return [c for c in wanted if c in copy.columns and c in source.columns and c not in keys]


def _comparable(df: DataFrame, like: DataFrame, name: str) -> Column:
    """A column as the source's type, maps as sorted entries."""
    kind, value = like.schema[name].dataType, F.col(f"`{name}`")
    if df.schema[name].dataType != kind:
        value = value.try_cast(kind)
    return F.array_sort(F.map_entries(value)) if isinstance(kind, MapType) else value


def _hashed(field: str, like: DataFrame, names: Sequence[str]) -> list[Column]:
    """What to hash for the fields of a struct: a hash passes over nulls, so these are marked."""
    out = []
    for name in names:
        value = F.col(f"{field}.`{name}`")
        nested = isinstance(like.schema[name].dataType, (ArrayType, MapType, StructType))
        out += [F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}) if nested else value, value.isNull()]
    return out


def _side(df: DataFrame, like: DataFrame, keys: Sequence[str], rest: Sequence[str], side: int, levels: int) -> DataFrame:
    """side, key, rest (structs), two hashes of the row, and its bucket on each level."""
    key = F.struct(*[_comparable(df, like, k).alias(k) for k in keys])
    values = F.struct(*[_comparable(df, like, c).alias(c) for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    named = df.select(F.lit(side).alias("side"), key.alias("key"), values.alias("rest"))
    own = _hashed("key", like, keys)
    whole = own + _hashed("rest", like, rest)
    spot = F.xxhash64(*own)
    buckets = [F.pmod(F.shiftrightunsigned(spot, 10 * level), F.lit(BUCKETS)).cast("int").alias(f"b{level}") for level in range(levels)]
    hashes = [F.xxhash64(*whole).cast("decimal(20,0)").alias("h1"), F.xxhash64(F.lit(7), *whole).cast("decimal(20,0)").alias("h2")]
    return named.select("*", *hashes, *buckets)


def _unequal(rows: DataFrame, buckets: Sequence[str]) -> DataFrame:
    """The buckets whose figures differ between the sides."""
    sums = rows.groupBy(*buckets).agg(
        F.sum("side").alias("n"), F.sum(F.col("side") * F.col("h1")).alias("s1"), F.sum(F.col("side") * F.col("h2")).alias("s2")
    )
    return sums.where("n <> 0 or s1 <> 0 or s2 <> 0").select(*buckets)


def suspect_rows(
    source: DataFrame, copy: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, levels: int = 2
) -> DataFrame:
    """side (1 source, -1 copy), key, rest, h1, h2 (hashes) of the rows in buckets that differ, from both sides.

    With more levels fewer equal rows are among them; each level reads the sides once more, filtered by the one before.
    """
    if not 1 <= levels <= 2:
        raise ValueError("one or two levels")
    rest = _shared(source, copy, keys, columns)
    both = _side(source, source, keys, rest, SOURCE, levels).unionByName(_side(copy, source, keys, rest, COPY, levels))
    left = both
    for level in range(levels):
        buckets = [f"b{i}" for i in range(level + 1)]
        # BUCKETS rows a level and unequal bucket at most
        left = both.join(F.broadcast(_unequal(left, buckets)), buckets, "left_semi")
    return left.select("side", "key", "rest", "h1", "h2")


def row_differences(
    source: DataFrame, copy: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, levels: int = 2
) -> DataFrame:
    """The keys in which two copies differ: the keys, source_rows, copy_rows, status, changed_columns.

    Statuses: `missing in copy`, `missing in source`, `changed`, and `rows differ` where a key that repeats has other rows or
    another number of them. changed_columns names the columns of a changed row, else it is null. Compared are the columns that
    both sides have, or those of `columns` among them; a copy's values are taken as the source's type, those that do
    not convert as null. Null is a key like any other. Order of rows does not matter.
    """
    rest = _shared(source, copy, keys, columns)
    rows = suspect_rows(source, copy, keys, columns, levels)
    here, there = F.col("side") == SOURCE, F.col("side") == COPY
    grouped = rows.groupBy("key").agg(
        F.count_if(here).alias("source_rows"),
        F.count_if(there).alias("copy_rows"),
        F.sum(F.col("side") * F.col("h1")).alias("s1"),
        F.sum(F.col("side") * F.col("h2")).alias("s2"),
        F.first(F.when(here, F.col("rest")), ignorenulls=True).alias("old"),
        F.first(F.when(there, F.col("rest")), ignorenulls=True).alias("new"),
    )
    differing = grouped.where("source_rows <> copy_rows or s1 <> 0 or s2 <> 0")
    single = (F.col("source_rows") == 1) & (F.col("copy_rows") == 1)
    changed = F.array(*[F.when(~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")), F.lit(c)) for c in rest])
    status = (
        F.when(F.col("copy_rows") == 0, "missing in copy")
        .when(F.col("source_rows") == 0, "missing in source")
        .when(single, "changed")
        .otherwise("rows differ")
    )
    names = F.when(single, F.array_compact(changed).cast("array<string>"))
    return differing.select(
        *[F.col(f"key.`{k}`").alias(k) for k in keys], "source_rows", "copy_rows", status.alias("status"), names.alias("changed_columns")
    )


def difference_summary(differences: DataFrame) -> DataFrame:
    """Keys, source rows and copy rows by status."""
    return differences.groupBy("status").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("source_rows").alias("source_rows"), F.sum("copy_rows").alias("copy_rows")
    )
