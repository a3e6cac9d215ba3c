"""Statistics fitted once, kept as a small table, and applied row by row, to batches and streams alike."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tallyloom.operators.selection import select_quantiles
from tallyloom.operators.stats import QUARTERS

SCHEMA = (
    "column_name string, data_type string, value_count bigint, mean double, stddev double, min_value string, "
    "q1 string, median string, q3 string, max_value string"
)


def _type(name: str) -> DataType:
    return StructType.fromDDL(f"v {name}")["v"].dataType


@dataclass(frozen=True)
class Figures:
    """Moments, ends and quartiles of one column; None where it has too few values, or quartiles were not asked for."""

    data_type: str
    value_count: int
    mean: float | None
    stddev: float | None
    ends: tuple[Any, Any]
    quartiles: tuple[Any, Any, Any] | None

    @property
    def kind(self) -> DataType:
        return _type(self.data_type)


@dataclass(frozen=True)
class Fitted:
    """Figures by column. Everything applied from them is a literal: it needs no job, and rows may stream."""

    figures: dict[str, Figures]

    def mean(self, column: str) -> Column:
        return F.lit(self.figures[column].mean).cast("double")

    def stddev(self, column: str) -> Column:
        return F.lit(self.figures[column].stddev).cast("double")

    def quartiles(self, column: str) -> Column:
        """`[q1, median, q3]` in the column's type, null without values."""
        own = self.figures[column]
        if own.quartiles is None:
            return F.lit(None).cast(f"array<{own.data_type}>")
        return F.array(*[F.lit(v).cast(own.kind) for v in own.quartiles])

    def above(self, column: str, sigmas: float = 3) -> Column:
        """Whether a value lies above mean + `sigmas` · deviation; false for nulls and without a deviation."""
        return F.coalesce(F.col(column) > self.mean(column) + F.lit(sigmas) * self.stddev(column), F.lit(False))

    def zscore(self, column: str) -> Column:
        """The absolute z-score, null where there is no spread."""
        return F.abs(F.try_divide(F.col(column) - self.mean(column), self.stddev(column)))

    def table(self, spark: SparkSession) -> DataFrame:
        """A row a column; ends and quartiles as text, which their types read back unchanged."""
        rows = []
        for name, f in self.figures.items():
            values = (f.ends[0], *(f.quartiles or (None, None, None)), f.ends[1])
            rows.append((name, f.data_type, f.value_count, f.mean, f.stddev, *values))
        texts = []
        for name, kind, *rest, least, q1, median, q3, most in rows:
            typed = [F.lit(v).cast(_type(kind)).cast("string") for v in (least, q1, median, q3, most)]
            numbers = [F.lit(v).cast(t) for v, t in zip(rest, ("bigint", "double", "double"))]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            texts.append(F.struct(*[c.alias(n) for c, n in zip([F.lit(name), F.lit(kind), *numbers, *typed], names)]))
        one = spark.range(1)
        return one.select(F.inline(F.array(*texts))) if texts else spark.createDataFrame([], SCHEMA)

    def store(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)


def fit(df: DataFrame, columns: Sequence[str], quartiles: Sequence[str] = (), keep: bool = False) -> Fitted:
    """Moments of `columns` in one pass, and exact quartiles of `quartiles` (among them) by selection (see there for `keep`)."""
    if not columns:
        return Fitted({})
    missing = set(quartiles) - set(columns)
    if missing:
        raise ValueError(f"quartiles of columns that are not fitted: {sorted(missing)}")
    moments = [
        F.struct(
            F.count(c).alias("n"), F.avg(c).cast("double").alias("mean"), F.stddev_samp(c).alias("sd"), F.min(c).alias("least"), F.max(c).alias("most")
        ).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]
    row = df.agg(*moments).first()
    tiers = select_quantiles(df, list(quartiles), QUARTERS, keep) if quartiles else {}
    out = {}
    for i, c in enumerate(columns):
        own, kind = row[f"c{i}"], df.schema[c].dataType.simpleString()
        quarters = tiers.get(c)
        out[c] = Figures(kind, own["n"], own["mean"], own["sd"], (own["least"], own["most"]), tuple(quarters) if quarters else None)
    return Fitted(out)


def load(spark: SparkSession, path: str) -> Fitted:
    """Figures that `Fitted.store` wrote: as many rows as columns were fitted."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    names = ("min_value", "q1", "median", "q3", "max_value")
    kinds = [r["data_type"] for r in stored.select("data_type").distinct().collect()]
    typed = stored.select("*", *[F.struct(*[F.expr(f"try_cast({n} as {kind})").alias(n) for n in names]).alias(f"t{i}") for i, kind in enumerate(kinds)])
    out = {}
    for row in typed.orderBy("column_name").collect():
        own = row[f"t{kinds.index(row['data_type'])}"]
        quarters = tuple(own[n] for n in names[1:4])
        moments = row["value_count"], row["mean"], row["stddev"]
        out[row["column_name"]] = Figures(row["data_type"], *moments, (own["min_value"], own["max_value"]), None if None in quarters else quarters)
    return Fitted(out)
