"""Frequent keys and name proposals against plain rules."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import frequent, report, spelling


def keys_of(seed, n):
    rng = random.Random(seed)
    return [(None if rng.random() < 0.05 else int(rng.paretovariate(0.7)) % 5_000, rng.choice("abc")) for _ in range(n)]


@pytest.mark.parametrize("width", [1, 16, 1 << 15])
@pytest.mark.parametrize("k", [1, 7, 400])
def test_top_groups_are_exact(spark, width, k):
    df = spark.createDataFrame(keys_of(k, 6_000), "u int, c string").repartition(6)
    for keys in (["u"], ["u", "c"]):
        got = [tuple(r) for r in frequent.top_groups(df, keys, k, width=width).collect()]
        assert got == [tuple(r) for r in report.top_groups(df, keys, k).collect()]


def test_ties_few_keys_and_no_rows(spark):
    df = spark.createDataFrame([(i % 9,) for i in range(90)], "u int")
    assert [tuple(r) for r in frequent.top_groups(df, ["u"], 4).collect()] == [(i, 10) for i in range(4)]
    assert frequent.top_groups(df, ["u"], 50).count() == 9
    assert frequent.keep_frequent(df, ["u"], 0).count() == 0
    assert frequent.top_groups(df.limit(0), ["u"], 3).count() == 0


def test_only_candidates_are_counted(spark):
    # 30 keys of 200 rows among 60,000 keys of one
    df = spark.range(66_000).select(F.when(F.col("id") < 6_000, F.col("id") % 30).otherwise(F.col("id")).alias("u"))
    kept = frequent.keep_frequent(df, ["u"], 30)
    assert kept.where("u < 30").count() == 6_000 and kept.count() < 6_100
    plan = frequent.top_groups(df, ["u"], 30)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the sketch stands for upper bounds of all counts
    sketch = {(r.line, r.cell): r.n for r in frequent.count_sketch(df, ["u"]).collect()}
    assert sum(n for (line, _), n in sketch.items() if line == 0) == 66_000


# ---------------------------------------------------------------- names


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_proposals(values, names, edits, least):
    allowed = lambda t: 0 if len(t) < 2 else 1 if len(t) < least else edits
    known = {n.lower() for n in names if n is not None}
    out = {}
    for value, n in collections.Counter(v for v in values if v is not None).items():
        form = value.lower()
        if form in known:
            continue
        near = sorted((edit_distance(form, name.lower()), name) for name in {n for n in names if n is not None} if edit_distance(form, name.lower()) <= min(allowed(form), allowed(name.lower())))
        out[value] = (n, *((near[0][1], near[0][0]) if near else (None, None)), len(near))
    return out


@pytest.mark.parametrize("edits, least", [(1, 4), (2, 4), (2, 7), (3, 5)])
def test_proposals(spark, edits, least):
    rng = random.Random(edits * 10 + least)
    names = ["Sao Paulo", "Sao Pedro", "Rio", "Ria", "Belo Horizonte", "Santos", "Santo", "São José", "X", "", "ab", None, "Rio"]
    values = [None, "", "X", "x", "Y", "ri", "RIO", "b" * 400, "Santoss", "santoes"]
    for _ in range(250):
        letters = list(rng.choice([n for n in names if n]))
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(letters))
            way = rng.random()
            if way < 0.35:
                letters.insert(at, rng.choice("aeioé"))
            elif letters and way < 0.7:
                del letters[min(at, len(letters) - 1)]
            elif letters:
                letters[min(at, len(letters) - 1)] = rng.choice("qwz")
        values.append("".join(letters))
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "city string, value int")
    known = spark.createDataFrame([(n, 1) for n in names], "value string, key int")
    got = spelling.propose_names(rows, "city", known, "value", edits=edits, least_length=least)
    assert {r.value: (r.row_count, r.proposal, r.edits, r.candidates) for r in got.collect()} == plain_proposals(values, names, edits, least)


def test_forms_left_after_deletions(spark):
    row = spark.createDataFrame([("abca", "", "é")], "t string, none string, one string")
    got = row.select(spelling.remainders(F.col("t"), 2), spelling.remainders(F.col("none"), 2), spelling.remainders(F.col("one"), 1)).first()
    assert sorted(got[0]) == sorted({"abca", "bca", "aca", "aba", "abc", "ca", "ba", "bc", "aa", "ac", "ab"}) and got[1] == [""] and sorted(got[2]) == ["", "é"]


def test_corrected_names(spark):
    rows = spark.createDataFrame([(1, "Santoz"), (2, "Santos"), (3, "Rix"), (4, None), (5, "Elsewhere")], "id int, city string")
    known = spark.createDataFrame([("Santos",), ("Rio",), ("Ria",)], "name string")
    proposals = spelling.propose_names(rows, "city", known, "name", least_length=3)
    got = {r.id: r.fixed for r in spelling.correct_names(rows, "city", proposals, "fixed").collect()}
    # two names are as near to `Rix`: it is left to a person
    assert got == {1: "Santos", 2: "Santos", 3: "Rix", 4: None, 5: "Elsewhere"}
    assert {r.id: r.fixed for r in spelling.correct_names(rows, "city", proposals, "fixed", most_candidates=2).collect()}[3] == "Ria"
    with pytest.raises(ValueError):
        spelling.propose_names(rows, "city", known, "name", edits=4)
    assert spelling.propose_names(rows, "city", known.limit(0), "name").where("proposal is not null").count() == 0
