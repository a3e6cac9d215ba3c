"""Exact quantiles by selection: rows are counted in ranges that narrow around the wanted rank.

No value is shuffled or stored. A mergeable sketch guesses a bracket for each quantile; one pass counts what lies below it
and, in PARTS ranges inside, with the smallest and largest value of each. The range that holds the wanted rank is
the next bracket, until its smallest and largest value are the same. A guess that misses only costs another pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, LongType, NumericType

PARTS = 2_048
GUESS_ACCURACY = 2_000


def selectable(kind: DataType) -> bool:
    """Whether values of a type can be selected by ranges: numbers."""
    return isinstance(kind, NumericType)


@dataclass
class _Target:
    """A wanted rank among a column's finite values and the bracket around it."""

    column: str
    place: int
    kind: DataType
    rank: int
    low: Any
    high: Any
    least: Any
    most: Any

    @property
    def done(self) -> bool:
        return self.low == self.high


def _floating(kind: DataType) -> bool:
    return isinstance(kind, (FloatType, DoubleType))


def _finite(column: str, kind: DataType) -> Column:
    value = F.col(f"`{column}`")
    return F.when(F.abs(value) < F.lit(float("inf")), value) if _floating(kind) else value


def _literal(value: Any, kind: DataType) -> Column:
    return F.lit(value).cast(kind)


def _distance(value: Column, low: Any, kind: DataType) -> Column:
    """How far a value lies above the bracket's start, as a double that never falls as the value grows."""
    if _floating(kind):  # halves, so that no difference overflows
        return value.cast("double") / 2 - F.lit(float(low)) / 2
    wide = kind if isinstance(kind, DecimalType) else DecimalType(20, 0) if isinstance(kind, LongType) else LongType()
    return (value.cast(wide) - _literal(low, wide)).cast("double")


def _opened(df: DataFrame, kinds: Mapping[str, DataType], shares: Sequence[float]) -> dict[str, list[Any]]:
    """One pass: settled values (None without any, infinities, NaN) and open targets per column and share."""
    margin = 2.0 / GUESS_ACCURACY
    guesses = [min(1.0, max(0.0, s + d)) for s in shares for d in (-margin, margin)]
    per_column = []
    for i, (column, kind) in enumerate(kinds.items()):
        value, finite = F.col(f"`{column}`"), _finite(column, kind)
        low = F.count_if(value == F.lit(float("-inf"))) if _floating(kind) else F.lit(0)
        high = F.count_if(value == F.lit(float("inf"))) if _floating(kind) else F.lit(0)
        sketch = F.percentile_approx(finite, F.array(*map(F.lit, guesses)), GUESS_ACCURACY)
        figures = [F.count(value).alias("n"), F.count(finite).alias("finite"), low.alias("low"), high.alias("high")]
        per_column.append(F.struct(*figures, F.min(finite).alias("least"), F.max(finite).alias("most"), sketch.alias("guess")).alias(f"c{i}"))
    row = df.agg(*per_column).first()
    out: dict[str, list[Any]] = {}
    for i, (column, kind) in enumerate(kinds.items()):
        seen = row[f"c{i}"]
        out[column] = []
        for place, share in enumerate(shares):
            part = Fraction(str(share))
            rank = max(1, -(-part.numerator * seen["n"] // part.denominator)) - seen["low"]
            if not seen["n"]:
                out[column].append(None)
            elif rank <= 0:
                out[column].append(float("-inf"))
            elif rank > seen["finite"]:
                out[column].append(float("inf") if rank <= seen["finite"] + seen["high"] else float("nan"))
            else:
                low, high = seen["guess"][2 * place : 2 * place + 2]
                out[column].append(_Target(column, place, kind, rank, low, high, seen["least"], seen["most"]))
    return out


def _counted(df: DataFrame, targets: Sequence[_Target]) -> dict[int, list[tuple]]:
    """One pass: per target the rows below its bracket and (part, rows, smallest, largest) inside, in order."""
    kinds = list(dict.fromkeys(t.kind for t in targets))
    slot = {kind: f"v{i}" for i, kind in enumerate(kinds)}
    below, inside, cells = [], [], []
    for i, t in enumerate(targets):
        value = _finite(t.column, t.kind)
        low, high = _literal(t.low, t.kind), _literal(t.high, t.kind)
        none = [F.lit(None).cast(kind).alias(f"{side}_{slot[kind]}") for kind in kinds for side in ("least", "most")]
        below.append(F.struct(F.lit(i).alias("target"), F.lit(-1).alias("part"), F.count_if(value < low).alias("n"), *none))
        span = _distance(high, t.low, t.kind)
        part = F.least(F.floor(_distance(value, t.low, t.kind) / span * PARTS), F.lit(PARTS - 1)) if not t.done else F.lit(0)
        own = [(value if kind == t.kind else F.lit(None).cast(kind)).alias(slot[kind]) for kind in kinds]
        here = value.between(low, high)
        inside.append(here)
        cells.append(F.when(here, F.struct(F.lit(i).alias("target"), part.cast("int").alias("part"), *own)))
    totals = df.agg(F.array(*below).alias("below")).select(F.inline("below"))
    any_inside = inside[0]
    for here in inside[1:]:
        any_inside = any_inside | here
    rows = df.where(any_inside).select(F.inline(F.filter(F.array(*cells), lambda c: c.isNotNull())))
    ends = [f(slot[kind]).alias(f"{side}_{slot[kind]}") for kind in kinds for side, f in (("least", F.min), ("most", F.max))]
    counts = rows.groupBy("target", "part").agg(F.count(F.lit(1)).alias("n"), *ends)
    found: dict[int, list[tuple]] = {i: [] for i in range(len(targets))}
    # a row for each target and part at most
    for row in sorted(totals.unionByName(counts).collect(), key=lambda r: (r["target"], r["part"])):
        name = slot[targets[row["target"]].kind]
        found[row["target"]].append((row["part"], row["n"], row[f"least_{name}"], row[f"most_{name}"]))
    return found


def _narrow(target: _Target, parts: Sequence[tuple]) -> bool:
    """Move the target's bracket by one pass's counts; true when its value is known.

    A pass always moves an open bracket; where it does not, the passes read different rows, and that is an error.
    """
    before = target.low, target.high
    (_, reached, _, _), *inside = parts
    if target.rank <= reached:
        target.low, target.high = target.least, target.low
    else:
        for _, n, least, most in inside:
            reached += n
            if target.rank <= reached:
                target.low, target.high = least, most
                if target.done:
                    return True
                break
        else:
            target.low, target.high = target.high, target.most
    if (target.low, target.high) == before:
        raise RuntimeError(f"the rows of {target.column} changed between two passes")
    return False


def select_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], keep: bool = False
) -> dict[str, list[Any] | None]:
    """For each numeric column its discrete quantiles: the smallest value that the share of values does not exceed.

    Exact at any size. Nulls are left out; None for a column without values. Not-a-number comes after all numbers. Each pass reads
    the columns of the open quantiles and brings PARTS figures a quantile at most to the driver; two passes are usual. `keep`
    holds the columns in Spark's cache from pass to pass, for rows that are costly to compute; lost parts are computed again.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    for c, kind in kinds.items():
        if not selectable(kind):
            raise ValueError(f"{c} is {kind.simpleString()}, not a number")
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    if not keep:
        return _selected(rows, kinds, shares)
    rows = rows.persist()
    try:
        return _selected(rows, kinds, shares)
    finally:
        rows.unpersist()


def _selected(rows: DataFrame, kinds: Mapping[str, DataType], shares: Sequence[float]) -> dict[str, list[Any] | None]:
    found = _opened(rows, kinds, shares)
    targets = [t for values in found.values() for t in values if isinstance(t, _Target)]
    while targets:
        counted = _counted(rows.select(*dict.fromkeys(f"`{t.column}`" for t in targets)), targets)
        known = [_narrow(t, counted[i]) for i, t in enumerate(targets)]
        for t, settled in zip(targets, known):
            if settled:
                found[t.column][t.place] = t.low
        targets = [t for t, settled in zip(targets, known) if not settled]
    return {c: None if values and values[0] is None else values for c, values in found.items()}
