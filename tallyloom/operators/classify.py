"""Business classifications over standardised columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.ladders import first_match


def repair_status(status: Column, delivered_at: Column) -> Column:
    """Status that agrees with the delivery date: no date, not delivered; a date, not canceled."""
    status = F.initcap(status)
    cases = [
        ((status == "Delivered") & delivered_at.isNull(), F.lit("Shipped")),
        ((status == "Canceled") & delivered_at.isNotNull(), F.lit("Delivered")),
    ]
    return first_match(cases, default=status)


def delivery_performance(status: Column, delivered_at: Column, estimated_at: Column) -> Column:
    """On Time, Delayed (also without an estimate), Canceled or In Progress."""
    cases = [
        (delivered_at <= estimated_at, F.lit("On Time")),
        (delivered_at.isNotNull(), F.lit("Delayed")),
        (status == "Canceled", F.lit("Canceled")),
    ]
    return first_match(cases, default="In Progress")


def product_complexity(
    description: Column, photos: Column, volume: Column, weight: Column, qd: Column, qv: Column, qw: Column
) -> Column:
    """Five levels from description length, photos, volume and weight against their quartiles."""
    rules = [
        ("Very High", [description > qd[2], photos > 2, volume > qv[2], weight > qw[2]]),
        ("High", [description > qd[1], photos > 1, volume > qv[1]]),
        ("Low", [description < qd[0], photos == 1, volume < qv[0], weight < qw[0]]),
        ("Medium Low", [description < qd[1], photos <= 2, volume < qv[1]]),
    ]
    return first_match([(_all(tests), F.lit(level)) for level, tests in rules], default="Medium")


def shipping_complexity(
    weight: Column, volume: Column, sides: Sequence[Column], qw: Column, qv: Column, long_side: float
) -> Column:
    """Complex if anything is large, Simple if weight and volume are small, else Standard."""
    large = (weight > qw[2]) | (volume > qv[2])
    for side in sides:
        large = large | (side > long_side)
    small = (weight <= qw[0]) & (volume <= qv[0])
    return first_match([(large, F.lit("Complex")), (small, F.lit("Simple"))], default="Standard")


def market_proximity(metro: Column, state: Column, near_states: Sequence[str]) -> Column:
    cases = [
        (metro != "Other", F.lit("Core Market")),
        (state.isin(*near_states), F.lit("Near Market")),
    ]
    return first_match(cases, default="Remote Market")


def business_potential(proximity: Column, density: Column) -> Column:
    cases = [
        ((proximity == "Core Market") & (density == "High"), F.lit("High Growth")),
        ((proximity == "Near Market") & density.isin("High", "Medium"), F.lit("Medium Growth")),
    ]
    return first_match(cases, default="Stable")


def plural_consistent(
    original: Column,
    english: Column,
    agree: Column,
    names: tuple[Sequence[str], Sequence[str]],
    patterns: Sequence[tuple[str | None, str | None]],
) -> Column:
    """`agree`, overridden to true for listed name pairs and pattern pairs."""
    exempt = F.lower(original).isin(*names[0]) & F.lower(english).isin(*names[1])
    for left, right in patterns:
        sides = [c.like(p) for c, p in ((original, left), (english, right)) if p is not None]
        exempt = exempt | _all(sides)
    return F.when(exempt, F.lit(True)).otherwise(agree)


def name_distance(
    original: Column,
    english: Column,
    rules: Sequence[tuple[str, str | None, Mapping[str, str] | None]],
    typos: Mapping[str, str],
    near: Sequence[str],
    near_distance: int,
) -> Column:
    """0 for equal wording, `near_distance` for listed names, else the edit distance.

    The words to exchange are patterns, what they become is literal but for `$` and a backslash.
    """

    def exchanged(text: Column, words: Mapping[str, str]) -> Column:
        for found, replacement in words.items():
            text = F.regexp_replace(text, found, replacement)
        return text

    wording = first_match(
        [(original.like(p), F.lit(whole) if whole else exchanged(original, words)) for p, whole, words in rules],
        default=original,
    )
    spelled = exchanged(english, typos)
    cases = [(wording == spelled, F.lit(0)), (original.isin(*near), F.lit(near_distance))]
    return first_match(cases, default=F.levenshtein(wording, spelled))


def valid_coordinates(lat: Column, lng: Column) -> Column:
    return lat.between(-90, 90) & lng.between(-180, 180) & (lat != 0) & (lng != 0)


def _all(tests: Sequence[Column]) -> Column:
    combined = tests[0]
    for test in tests[1:]:
        combined = combined & test
    return combined
