"""Group statistics, modes, running counts, outliers and quantile tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.ladders import at_most
from tallyloom.operators.joins import attach_by_key
from tallyloom.operators.scalars import with_scalar
from tallyloom.operators.selection import select_quantiles, selectable
from tallyloom.session import materialise

if TYPE_CHECKING:
    from tallyloom.operators.fitted import Fitted


def group_mode(df: DataFrame, keys: Sequence[str], column: str, name: str = "mode_value") -> DataFrame:
    """The most frequent value per key, the smallest among equals; plus the group's row count.

    Two aggregations: first (key, value) counts, then the best of them per key. Neither gathers
    a group in one place, whatever the number of rows or values behind a key.
    """
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__n"))
    ballot = F.struct((-F.col("__n")).alias("rank"), F.col(column).alias("value"))
    best = F.min(F.when(F.col(column).isNotNull(), ballot))
    return counts.groupBy(*keys).agg(best["value"].alias(name), F.sum("__n").alias("group_rows"))


def attach_mode(df: DataFrame, keys: Sequence[str], column: str, name: str = "mode_value") -> DataFrame:
    """The group's mode on every row of the group."""
    modes = group_mode(df, keys, column, name)
    return attach_by_key(df, modes, keys).drop("group_rows")


def repair_by_mode(
    df: DataFrame, keys: Sequence[str], column: str, name: str, keep: Sequence[str], min_length: int = 3
) -> DataFrame:
    """Majority vote: replace a value by its group's mode.

    Values of the `keep` list (lower case), values shorter than `min_length` and nulls stay.
    """
    voted = attach_mode(df, keys, column, "__mode")
    value = F.col(column)
    outvoted = (
        (value != F.col("__mode")) & (F.length(value) >= min_length) & ~F.lower(value).isin(*keep)
    )
    return voted.withColumn(name, F.when(outvoted, F.col("__mode")).otherwise(value)).drop("__mode")


def running_count(df: DataFrame, by: str, name: str = "row_num") -> DataFrame:
    """Rows with a sort key up to and including each row's own; equal keys share the figure.

    What `count(*) over (order by key)` yields, without its single task: rows are counted per
    key, the key table is range-partitioned and written once so that its partitions stay put,
    and each partition adds the total of those before it.
    """
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    ranged = counts.repartitionByRange(F.col(by).asc_nulls_first())
    ranged = materialise(ranged.withColumn("__part", F.spark_partition_id()), "running-count")
    totals = ranged.groupBy("__part").agg(F.sum("__n").alias("__total"))
    # one row per partition: the number of partitions bounds this window and the broadcast
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset")
    )
    within = Window.partitionBy("__part").orderBy(F.col(by).asc_nulls_first())
    keyed = ranged.join(F.broadcast(offsets), "__part").select(
        by, "__n", (F.col("__offset") + F.sum("__n").over(within)).alias(name)
    )
    return attach_by_key(df, keyed, [by]).drop("__n")


def flag_upper_outliers(
    df: DataFrame, columns: Mapping[str, str], sigmas: float = 3, figures: Fitted | None = None
) -> DataFrame:
    """Flag values above mean + `sigmas` · sample deviation; `columns` maps value to flag.

    The moments come from one scalar subquery that reads the value columns only, or from `figures` fitted
    before; rows may be a stream then. Null values, and columns with fewer than two values, give false.
    """
    if figures is not None:
        return df.withColumns({flag: figures.above(c, sigmas) for c, flag in columns.items()})
    moments = [
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd")).alias(c) for c in columns
    ]
    stats = df.agg(F.struct(*moments).alias("stats")).scalar()

    def above(stats: Column, column: str) -> Column:
        limit = stats[column]["mean"] + F.lit(sigmas) * stats[column]["sd"]
        return F.coalesce(F.col(column) > limit, F.lit(False))

    return with_scalar(df, stats, lambda s: {flag: above(s, c) for c, flag in columns.items()})


def add_zscore(
    df: DataFrame,
    column: str,
    score: str = "zscore",
    flag: str = "is_outlier",
    sigmas: float = 3,
    figures: Fitted | None = None,
) -> DataFrame:
    """Absolute z-score and a two-sided outlier flag; both null where there is no spread.

    With `figures` fitted before, rows may be a stream.
    """
    if figures is not None:
        return df.withColumn(score, figures.zscore(column)).withColumn(flag, F.col(score) > sigmas)
    moments = F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"))
    stats = df.agg(moments.alias("stats")).scalar()
    scored = with_scalar(
        df, stats, lambda s: {score: F.abs(F.try_divide(F.col(column) - s["mean"], s["sd"]))}
    )
    return scored.withColumn(flag, F.col(score) > sigmas)


def quartiles(
    df: DataFrame, columns: Sequence[str], method: str = "exact", accuracy: int = 10_000, keep: bool = False
) -> Column:
    """A struct of `[q1, median, q3]` arrays by column, nulls left out; null without values.

    Exact at any size: each is the smallest value that a quarter, a half, three quarters of the
    values do not exceed. Numbers are selected by passes of counts (`select_quantiles`, to which `keep` goes),
    which run at once and leave literals in the plan; other types by `exact_quantiles`. `method="approx"` is one pass
    of a mergeable sketch instead, with a rank error of 1/`accuracy` that depends on the partitioning.
    """
    if method == "approx":
        shares = F.array(*[F.lit(share) for share in QUARTERS])
        sketches = [F.percentile_approx(c, shares, accuracy).alias(c) for c in columns]
        return df.agg(F.struct(*sketches).alias("quartiles")).scalar()
    if method != "exact":
        raise ValueError(f"method must be 'exact' or 'approx', not {method!r}")
    kinds = {c: df.schema[c].dataType for c in columns}
    if not all(map(selectable, kinds.values())):
        return exact_quantiles(df, columns, QUARTERS).select(F.struct(*columns).alias("quartiles")).scalar()
    found = select_quantiles(df, columns, QUARTERS, keep)

    def literal(c: str) -> Column:
        if found[c] is None:
            return F.lit(None).cast(f"array<{kinds[c].simpleString()}>")
        return F.array(*[F.lit(v).cast(kinds[c]) for v in found[c]])

    return F.struct(*[literal(c).alias(c) for c in columns])


QUARTERS = (0.25, 0.5, 0.75)


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """One row: for each column of any ordered type the array of its discrete quantiles.

    Rows are counted per column and value; these counts are range-partitioned by value and written
    once, so that their partitions stay put; each partition adds the total of those before it. The
    one row that comes of it is written too: a scalar subquery of it costs nothing further.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    slots = {kind: f"v{i}" for i, kind in enumerate(dict.fromkeys(kinds.values()))}
    # a row per column and value, the value in the slot of its type
    cells = [
        F.struct(
            F.lit(i).alias("__column"),
            *[(F.col(c) if kind == kinds[c] else F.lit(None).cast(kind)).alias(slot) for kind, slot in slots.items()],
        )
        for i, c in enumerate(columns)
    ]
    values = df.select(F.inline(F.array(*cells))).where(F.coalesce(*[F.col(s).cast("string") for s in slots.values()]).isNotNull())
    order = ["__column", *slots.values()]
    counts = values.groupBy(*order).agg(F.count(F.lit(1)).alias("__n"))
    ranged = counts.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    ranged = materialise(ranged, "value-counts")
    # a row for each partition and column: their number bounds the windows over them and the broadcast
    totals = ranged.groupBy("__column", "__part").agg(F.sum("__n").alias("__sum"))
    before = Window.partitionBy("__column").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__column",
        "__part",
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"),
        F.sum("__sum").over(Window.partitionBy("__column")).alias("__all"),
    )
    within = Window.partitionBy("__column", "__part").orderBy(*slots.values())
    ranked = ranged.join(F.broadcast(offsets), ["__column", "__part"]).withColumn(
        "__upto", F.col("__before") + F.sum("__n").over(within)
    )

    def quantile(i: int, c: str, share: float) -> Column:
        reached = (F.col("__column") == i) & (F.col("__upto") >= F.ceil(F.lit(share) * F.col("__all")))
        return F.min(F.when(reached, F.col(slots[kinds[c]])))

    found = [
        F.when(F.count_if(F.col("__column") == i) > 0, F.array(*[quantile(i, c, s) for s in shares])).alias(c)
        for i, c in enumerate(columns)
    ]
    return materialise(ranked.agg(*found), "quantiles")


def volume_tier(value: Column, q: Column) -> Column:
    """Size tier from the quartiles; null falls through to the last tier."""
    steps = [
        (q[0] / 2, "Extra Small"),
        (q[0], "Small"),
        (q[1], "Medium Small"),
        (q[2], "Medium Large"),
        (q[2] * 2, "Large"),
    ]
    return at_most(value, steps, "Extra Large")


def weight_category(value: Column, q: Column, ultra_light: float) -> Column:
    """Weight tier: a fixed first step, then the quartiles; null falls through to the last."""
    steps = [
        (F.lit(ultra_light), "Ultra Light"),
        (q[0], "Light"),
        (q[1], "Medium Light"),
        (q[2], "Medium Heavy"),
        (q[2] * 2, "Heavy"),
    ]
    return at_most(value, steps, "Extra Heavy")
