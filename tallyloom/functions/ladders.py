"""Classifications written as data: ordered cases and value groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    """The value of the first true case. A null condition counts as false."""
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return F.lit(default) if chain is None else chain.otherwise(default)


def at_most(value: Column, steps: Sequence[tuple[Column | float, str]], last: str) -> Column:
    """Name of the first step whose upper bound holds `value`; beyond all (or null): `last`."""
    return first_match([(value <= bound, name) for bound, name in steps], last)


def at_least(value: Column, steps: Sequence[tuple[float, str]], last: str) -> Column:
    """Name of the first step whose lower bound `value` reaches; below all (or null): `last`."""
    return first_match([(value >= bound, name) for bound, name in steps], last)


def group_of(value: Column, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    """Name of the group that lists `value`; unlisted or null: `default`."""
    return first_match([(value.isin(*members), name) for name, members in groups.items()], default)


def mapped(value: Column, table: Mapping[str, str]) -> Column:
    """`table[value]`, null when there is no entry. For dictionaries that live in code."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return entries[value]
