"""Duplicates: finding, removing and accounting for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import percent

# Copies written back per output task row; a larger group is spread over several tasks.
COPY_CHUNK = 100_000


def distinct_with_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Each distinct row once, with the number of its copies.

    One aggregation with map-side combine: a row that fills a third of the table shrinks to one
    row per input task before the shuffle.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def duplicate_groups(df: DataFrame, keys: Sequence[str] | None = None, name: str = "copies") -> DataFrame:
    """Key (or whole-row) groups with more than one row."""
    keys = list(keys or df.columns)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def keep_best(df: DataFrame, keys: Sequence[str], best: Sequence[Column]) -> DataFrame:
    """One row per key: the one with the largest `best` values, compared in order.

    An aggregate, not a ranking window, so a hot key is reduced inside each input task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[expr.alias(f"o{i}") for i, expr in enumerate(best)])
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return kept.select(*[c if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def removed_copies(df: DataFrame) -> DataFrame:
    """The multiset difference between `df` and its distinct rows: every copy but one.

    The copies of a row come back in chunks that are spread over tasks first, so that one
    row with a very large count is not written by a single task.
    """
    extra = distinct_with_copies(df, "__copies").filter(F.col("__copies") > 1)
    last_chunk = F.floor((F.col("__copies") - 2) / COPY_CHUNK)
    chunks = extra.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    spread = chunks.repartition("__chunk", *df.columns)
    size = F.least(F.col("__copies") - 1 - F.col("__chunk") * COPY_CHUNK, F.lit(COPY_CHUNK))
    repeated = F.explode(F.sequence(F.lit(1).cast("bigint"), size.cast("bigint"))).alias("__i")
    return spread.select(*df.columns, repeated).drop("__i")


def duplicate_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys that repeat, and the latter as a share of the rows."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    report = groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("__n") > 1).alias("duplicate_keys"),
        F.coalesce(F.max("__n"), F.lit(0)).alias("max_copies"),
    )
    share = percent(F.col("duplicate_keys"), F.col("row_count"))
    return report.withColumn("duplicate_pct", share)
