"""The most frequent keys of many, exactly: a sketch bounds every key's count, and only keys that may be among them are counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.scalars import with_scalar

WIDTH, DEPTH = 1 << 15, 2


def _spot(keys: Sequence[str], line: int, width: int) -> Column:
    """A key's cell on a line of the sketch; null parts of a key count too."""
    parts = [part for k in keys for part in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())]
    return F.pmod(F.xxhash64(F.lit(line), *parts), F.lit(width)).cast("int")


def count_sketch(df: DataFrame, keys: Sequence[str], width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """line, cell, n: rows by cell, `depth` lines of `width` cells. A key's count is at most the smallest of its cells'.

    Mergeable: sketches of parts of a table add up to the table's.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("line"), _spot(keys, i, width).alias("cell")) for i in range(depth)])
    return df.select(F.inline(cells)).groupBy("line", "cell").agg(F.count(F.lit(1)).alias("n"))


def keep_frequent(df: DataFrame, keys: Sequence[str], k: int, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """The rows whose key may be among the `k` most frequent ones, ties included; no row of such a key is left out.

    The keys in the `k` fullest cells of one line are counted exactly; the k-th count of these is a bound that the k-th of all
    reaches. Rows stay whose cells all hold that many. Shuffled are the sketch's cells, a row a cell and task, and what
    the exact counts of candidates take; the cells are broadcast (`width` rows a line at most).
    """
    if k < 1:
        return df.limit(0)
    sketch = count_sketch(df, keys, width, depth)
    fullest = sketch.where("line = 0").orderBy(F.desc("n"), "cell").limit(k).select(F.col("cell").alias("__cell"))
    marked = df.withColumn("__cell", _spot(keys, 0, width))
    counted = marked.join(F.broadcast(fullest), "__cell", "left_semi").groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("n"))
    # with fewer than k keys there is none to leave out
    top = counted.select("n").orderBy(F.desc("n")).limit(k)
    bound = top.agg(F.when(F.count(F.lit(1)) == k, F.min("n")).otherwise(F.lit(0)).alias("bound")).scalar()
    enough = with_scalar(sketch, bound, lambda b: {"enough": F.col("n") >= b}).where("enough")
    for line in range(depth):
        cells = enough.where(F.col("line") == line).select(F.col("cell").alias(f"__line{line}"))
        spotted = df.withColumn(f"__line{line}", _spot(keys, line, width))
        df = spotted.join(F.broadcast(cells), f"__line{line}", "left_semi").drop(f"__line{line}")
    return df


def top_groups(df: DataFrame, keys: Sequence[str], k: int, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """The `k` largest groups by row count, ties to the smaller key, as `report.top_groups` has them; for many keys."""
    candidates = keep_frequent(df.select(*[F.col(f"`{c}`") for c in keys]), keys, k, width, depth)
    counts = candidates.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), *[F.col(f"`{c}`") for c in keys]).limit(k)
