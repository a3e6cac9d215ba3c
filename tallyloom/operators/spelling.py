"""Proposals for misspelt names: near spellings are found by equality of what remains after some letters are left out.

Two words within d edits share a form in which each has lost at most d letters. Names and values are entered under all such
forms and joined by them; an edit distance decides. No value is compared with all names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.scalars import with_scalar

MOST_EDITS = 2


def remainders(text: Column, edits: int) -> Column:
    """All forms of a text with up to `edits` letters left out, itself included, each once."""

    def one_less(form: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(form), F.lit(1)))
        return F.transform(places, lambda i: F.concat(F.substring(form, 1, i - 1), F.substr(form, i + 1)))

    forms = F.array(text)
    level = forms
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, one_less)))
        forms = F.array_union(forms, level)
    return forms


def propose_names(
    values: DataFrame,
    column: str,
    known: DataFrame,
    name: str,
    edits: int = MOST_EDITS,
    least_length: int = 4,
    fold: Callable[[Column], Column] = F.lower,
) -> DataFrame:
    """Distinct values of `column` that are no known name, with the nearest name: value, row_count, proposal, edits, candidates.

    Values and names are compared as `fold` makes them, lower case unless told otherwise; a value that folds to a name is not
    misspelt and left out, as are nulls. The proposal is the name with the fewest edits (insertions, deletions and
    changes of one letter), among these the smallest. A value, or name, shorter than `least_length` may differ in one letter at
    most, one of a single letter in none. `candidates` counts the names that near; values without any have nulls and 0.
    """
    if not 1 <= edits <= 3:
        raise ValueError("1 to 3 edits")
    own = values.select(F.col(column).alias("value")).where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("row_count"))
    own = own.withColumn("form", fold(F.col("value")))
    names = known.select(F.col(name).alias("proposal")).where("proposal is not null").distinct().withColumn("name_form", fold(F.col("proposal")))
    unknown = own.join(names.select(F.col("name_form").alias("form")).distinct(), "form", "left_anti")

    def allowed(form: Column) -> Column:
        return F.when(F.length(form) < 2, 0).when(F.length(form) < least_length, 1).otherwise(edits)

    def entered(rows: DataFrame, form: str) -> DataFrame:
        few = F.when(allowed(F.col(form)) < 2, remainders(F.col(form), 1)).otherwise(remainders(F.col(form), edits))
        return rows.withColumn("key", F.explode(few))

    # values that are longer than any name by more than the edits are near none: their forms are not made
    longest = names.agg(F.coalesce(F.max(F.length("name_form")), F.lit(0))).scalar()
    short = with_scalar(unknown, longest, lambda most: {"short": F.length("form") <= most + edits}).where("short")
    pairs = entered(short, "form").join(entered(names, "name_form"), "key")
    distance = F.levenshtein("form", "name_form")
    near = pairs.select("value", "proposal", "form", "name_form").distinct().withColumn("edits", distance)
    near = near.where(F.col("edits") <= F.least(allowed(F.col("form")), allowed(F.col("name_form"))))
    best = near.groupBy("value").agg(F.min(F.struct("edits", "proposal")).alias("best"), F.count(F.lit(1)).alias("candidates"))
    found = unknown.join(best, "value", "left")
    return found.select("value", "row_count", F.col("best.proposal").alias("proposal"), F.col("best.edits").alias("edits"), F.coalesce("candidates", F.lit(0)).cast("bigint").alias("candidates"))


def correct_names(values: DataFrame, column: str, proposals: DataFrame, corrected: str, most_candidates: int = 1) -> DataFrame:
    """`values` with `corrected`: the proposal where one is clear, at most `most_candidates` names being near, else the value itself."""
    clear = proposals.where(F.col("candidates").between(1, most_candidates)).select(F.col("value").alias("__value"), F.col("proposal").alias("__proposal"))
    joined = values.join(clear, values[column] == clear["__value"], "left")
    return joined.withColumn(corrected, F.coalesce("__proposal", F.col(column))).drop("__value", "__proposal")
