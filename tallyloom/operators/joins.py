"""Lookups, attached group figures and referential checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FractionalType,
    LongType,
    MapType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)


def key_type(left: DataType, right: DataType) -> DataType | None:
    """The type in which keys of two types are compared; None where they are of one type already.

    Text meets numbers as a number and dates as a date: `01310` is 1310, and a text that is neither
    matches nothing. Types without such a common one are an error.
    """
    if left == right:
        return None
    pair = (left, right)
    if all(isinstance(t, NumericType) for t in pair):
        return _widest(*pair)
    if any(isinstance(t, StringType) for t in pair):
        other = right if isinstance(left, StringType) else left
        if isinstance(other, NumericType):
            return _widest(other, LongType())
        if isinstance(other, (DateType, TimestampType, TimestampNTZType, StringType)):
            return other
    raise ValueError(f"keys of type {left.simpleString()} and {right.simpleString()} cannot be compared")


def _widest(left: NumericType, right: NumericType) -> DataType:
    kinds = {type(left), type(right)}
    if kinds & {DoubleType} or any(isinstance(t, FractionalType) and not isinstance(t, DecimalType) for t in (left, right)):
        return DoubleType()
    exact = [t for t in (left, right) if isinstance(t, DecimalType)]
    if not exact:
        return LongType()
    scale = max(t.scale for t in exact)
    whole = max([t.precision - t.scale for t in exact] + [19] * (len(exact) == 1))
    return DecimalType(min(38, whole + scale), scale)


def _as_key(value: Column, kind: DataType | None) -> Column:
    return value if kind is None else value.try_cast(kind)


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"__{key}"])
    return condition


def attach_by_key(df: DataFrame, figures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the figures of each key group to every row of the group; null is a key of its own.

    `figures` has one row per key of `df`, which is read once for the join. No side is hinted: a
    small table of figures is broadcast by size, and otherwise AQE splits the partitions of hot
    keys on the side of the rows; the other side holds each key once.
    """
    right = figures.withColumnsRenamed({key: f"__{key}" for key in keys})
    return df.join(right, _same_keys(df, right, keys)).drop(*[f"__{key}" for key in keys])


def attach_group_counts(
    df: DataFrame, counts: Mapping[str, Sequence[str]], keep_null_keys: bool = True
) -> DataFrame:
    """Add row counts of one or more groupings; `counts` maps a new column to its keys.

    The rows are counted once per combination of all keys, each figure is summed from that table
    and joined as a small table of its own, so the input is not read again for each grouping.
    `keep_null_keys=False` gives inner-join semantics: rows with a null key are dropped.
    """
    keys = list(dict.fromkeys(key for grouping in counts.values() for key in grouping))
    if not keep_null_keys:
        df = df.dropna(subset=keys)
    combined = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    for name, grouping in counts.items():
        df = attach_by_key(df, combined.groupBy(*grouping).agg(F.sum("__rows").alias(name)), grouping)
    return df


def one_per_key(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key: the most frequent, the smallest among equals. Nulls do not vote."""
    votes = lookup.dropna(subset=[value]).groupBy(key, value).agg(F.count(F.lit(1)).alias("__n"))
    ballot = F.struct((-F.col("__n")).alias("rank"), F.col(value).alias("value"))
    return votes.groupBy(key).agg(F.min(ballot)["value"].alias(value))


def _unique(lookup: DataFrame, key: str, value: str, on_ambiguous: str, kind: DataType | None) -> DataFrame:
    """`__key` and `__value` of a lookup: one value per key, or with "expand" every distinct one.

    Keys are compared as `kind`: those that are one there vote together.
    """
    narrow = lookup.select(_as_key(F.col(key), kind).alias("__key"), F.col(value).alias("__value"))
    if on_ambiguous == "mode":
        return one_per_key(narrow, "__key", "__value")
    if on_ambiguous == "expand":
        return narrow.distinct()
    raise ValueError(f"on_ambiguous must be 'mode' or 'expand', not {on_ambiguous!r}")


def _look_up(
    df: DataFrame, lookup: DataFrame, column: str, key: str, value: str, on_ambiguous: str, absent: Column | None = None
) -> DataFrame:
    """Left join to the lookup's `__key`, `__value` that keeps rows without a key from piling up in one task.

    Keys of unlike types are compared in their common type (`key_type`). Rows whose key is null, or
    `absent`, match nothing: they are dealt out by a hash of the row, the others by a hash of the key,
    and equality decides. No side is forced to broadcast.
    """
    kind = key_type(df.schema[column].dataType, lookup.schema[key].dataType)
    narrow = _unique(lookup, key, value, on_ambiguous, kind)
    narrow = narrow.where(F.col("__key").isNotNull()).withColumn("__spot", F.xxhash64("__key"))
    sought = _as_key(F.col(column), kind)
    absent = sought.isNull() if absent is None else absent | sought.isNull()
    spread = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    own = F.when(absent, F.xxhash64(*spread)).otherwise(F.xxhash64(sought))
    keyed = df.withColumns({"__own": own, "__sought": F.when(~absent, sought)})
    on = (keyed["__own"] == narrow["__spot"]) & (keyed["__sought"] == narrow["__key"])
    return keyed.join(narrow, on, "left").drop("__own", "__sought", "__spot", "__key")


def prefer_reference(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    column: str,
    lookup_key: str,
    lookup_value: str,
    on_ambiguous: str = "mode",
) -> DataFrame:
    """Take `column` from the lookup where the lookup has a value for the row's key.

    `on_ambiguous="mode"` keeps one row per input row; `"expand"` yields a row for every
    distinct lookup value.
    """
    joined = _look_up(df, lookup, key, lookup_key, lookup_value, on_ambiguous)
    preferred = F.coalesce(F.col("__value"), F.col(column)).alias(column)
    return joined.select(*[preferred if c == column else F.col(c) for c in df.columns])


def replace_by_lookup(
    df: DataFrame,
    lookup: DataFrame,
    column: str,
    lookup_key: str,
    lookup_value: str,
    on_ambiguous: str = "mode",
) -> DataFrame:
    """Swap `column` for the lookup's value; no match gives null.

    A key with several values has its most frequent one, the smallest among equals, or with
    `on_ambiguous="expand"` a row for each.
    """
    joined = _look_up(df, lookup, column, lookup_key, lookup_value, on_ambiguous)
    return joined.drop(column).withColumnRenamed("__value", column)


def translate_by_dictionary(
    df: DataFrame,
    dictionary: DataFrame,
    column: str,
    source: str,
    target: str,
    name: str,
    on_ambiguous: str = "mode",
) -> DataFrame:
    """Add `name`: the dictionary's translation of `column`, or the text itself without one.

    A text with several translations has the most frequent one, the smallest among equals, so no
    row is multiplied unless `on_ambiguous="expand"`. Null and blank texts are not looked up.
    """
    blank = F.coalesce(F.length(F.trim(F.col(column))) == 0, F.lit(True))
    joined = _look_up(df, dictionary, column, source, target, on_ambiguous, blank)
    return joined.withColumn(name, F.coalesce("__value", column)).drop("__value")


def untranslated(df: DataFrame, dictionary: DataFrame, column: str, source: str) -> DataFrame:
    """Work list: the distinct non-blank texts the dictionary lacks."""
    texts = df.select(column).filter(F.length(F.trim(column)) > 0).distinct()
    known = dictionary.select(F.col(source).alias("__source"))
    return texts.join(known, texts[column] == known["__source"], "left_anti")


def orphans(
    child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]
) -> DataFrame:
    """Child rows whose foreign key has no parent. A key with a null part is not a violation.

    Keys of unlike types are compared in their common type (`key_type`); a text that is no number has
    no parent among numbers.
    """
    kinds = [key_type(child.schema[c].dataType, parent.schema[p].dataType) for c, p in zip(child_keys, parent_keys)]
    present = child.dropna(subset=list(child_keys))
    parents = parent.select(*[_as_key(F.col(p), kind).alias(f"__{c}") for c, p, kind in zip(child_keys, parent_keys, kinds)])
    condition = F.lit(True)
    for key, kind in zip(child_keys, kinds):
        condition = condition & (_as_key(present[key], kind) == parents[f"__{key}"])
    return present.join(parents, condition, "left_anti")
