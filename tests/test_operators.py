"""Operators against brute force, with a third of the rows behind one key."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.numbers import parse_integer, percent
from tallyloom.operators import dedup, joins, reconcile, report, stats, validate
from tallyloom.operators.validate import Relation, Rule, in_list, not_null

DRAW = random.Random(11)
# key 0 holds a third of all rows, key None a tenth, and many keys have one row
KEYS = [0] * 1000 + [None] * 300 + [DRAW.randint(1, 1500) for _ in range(1700)]
ROWS = [(i, k, DRAW.choice(["x", "y", "z", None]), DRAW.choice("ab")) for i, k in enumerate(KEYS)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, k int, v string, w string").repartition(5)


def test_attach_group_counts(rows):
    counts = collections.Counter(KEYS)
    attached = joins.attach_group_counts(rows, {"n": ["k"]})
    assert attached.columns == ["id", "k", "v", "w", "n"]
    assert {(r.id, r.n) for r in attached.collect()} == {(i, counts[k]) for i, k, _, _ in ROWS}
    assert attached.count() == len(ROWS)


def test_attach_two_groupings(rows):
    by_k = collections.Counter(KEYS)
    by_vw = collections.Counter((v, w) for _, _, v, w in ROWS)
    attached = joins.attach_group_counts(rows, {"a": ["k"], "b": ["v", "w"]})
    assert {(r.id, r.a, r.b) for r in attached.collect()} == {(i, by_k[k], by_vw[v, w]) for i, k, v, w in ROWS}
    without = joins.attach_group_counts(rows, {"a": ["k"]}, keep_null_keys=False)
    assert without.count() == len(ROWS) - 300


def test_attach_by_key_loses_no_key(rows):
    figures = rows.groupBy("k").agg(F.count("*").alias("n"))
    attached = joins.attach_by_key(rows, figures, ["k"])
    assert attached.count() == len(ROWS)


def test_mode_and_repair(rows):
    groups = collections.defaultdict(collections.Counter)
    for _, k, v, _ in ROWS:
        if v is not None:
            groups[k][v] += 1
    modes = {k: min(c, key=lambda v: (-c[v], v)) for k, c in groups.items()}
    got = {r.k: (r.mode_value, r.group_rows) for r in stats.group_mode(rows, ["k"], "v").collect()}
    sizes = collections.Counter(KEYS)
    assert got == {k: (modes.get(k), sizes[k]) for k in sizes}
    repaired = stats.repair_by_mode(rows, ["k"], "v", "fixed", keep=("x",), min_length=1).collect()
    for r in repaired:
        expected = r.v if r.v in (None, "x") else modes[r.k]
        assert r.fixed == expected


def test_running_count(rows):
    order = sorted(((k is not None, k or 0) for k in KEYS))
    last = {key: position for position, key in enumerate(order, 1)}
    got = {(r.id, r.row_num) for r in stats.running_count(rows.select("id", "k"), "k").collect()}
    assert got == {(i, last[k is not None, k or 0]) for i, k, _, _ in ROWS}


def test_keep_best(rows):
    best = {}
    for i, k, v, w in ROWS:
        best[k] = max(best.get(k, (-1, None, None)), (i, v, w), key=lambda r: r[0])
    got = dedup.keep_best(rows, ["k"], [F.col("id")]).collect()
    assert {(r.k, r.id, r.v, r.w) for r in got} == {(k, *b) for k, b in best.items()}


def test_removed_copies(spark, monkeypatch):
    monkeypatch.setattr(dedup, "COPY_CHUNK", 7)
    values = ["hot"] * 500 + ["two"] * 2 + ["one"] + [None] * 15
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = collections.Counter(r.t for r in dedup.removed_copies(df).collect())
    assert got == {"hot": 499, "two": 1, None: 14}
    assert dedup.removed_copies(df).exceptAll(df.exceptAll(df.distinct())).count() == 0
    assert {(r.t, r.copies) for r in dedup.duplicate_groups(df).collect()} == {("hot", 500), ("two", 2), (None, 15)}


def test_duplicate_key_report(rows):
    sizes = collections.Counter(KEYS)
    got = dedup.duplicate_key_report(rows, ["k"]).first()
    repeated = sum(n > 1 for n in sizes.values())
    assert (got.row_count, got.distinct_keys, got.duplicate_keys, got.max_copies) == (3000, len(sizes), repeated, 1000)


def test_outliers_and_scores(spark):
    values = [1.0, 2.0, 3.0, 2.0, 1.0, 2.0, 3.0, 2.0, 100.0, None]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    known = [v for v in values if v is not None]
    mean = sum(known) / len(known)
    sd = (sum((v - mean) ** 2 for v in known) / (len(known) - 1)) ** 0.5
    flagged = stats.flag_upper_outliers(df, {"x": "out"}, sigmas=2).orderBy("i").collect()
    assert [r.out for r in flagged] == [v is not None and v > mean + 2 * sd for v in values]
    scored = stats.add_zscore(df, "x", sigmas=2).orderBy("i").collect()
    assert scored[-1].zscore is None and scored[-1].is_outlier is None
    assert all(abs(r.zscore - abs((r.x - mean) / sd)) < 1e-12 for r in scored[:-1])
    flat = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r.zscore for r in stats.add_zscore(flat, "x").collect()] == [None, None]


def test_percent_is_exact_half_up(spark):
    pairs = [(1, 3), (1, 32), (201, 20000), (1, 20000), (2, 3), (0, 5), (5, 5), (3, 0)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r.p for r in df.select(percent(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == [33.33, 3.13, 1.01, 0.01, 66.67, 0.0, 100.0, None]


def test_percent_of_negative_counts(spark):
    pairs = [(-1, 3), (-2, 3), (-1, 32), (1, -3), (-1, -3), (-3, 1), (None, 3), (-3, 0)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r.p for r in df.select(percent(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == [-33.33, -66.67, -3.13, -33.33, 33.33, -300.0, None, None]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 20_001])
def test_quartiles_are_exact(spark, n):
    draw = random.Random(n)
    values = [(draw.choice([None, 5, draw.randrange(10**6)]), draw.random(), None, draw.randrange(3)) for _ in range(n)]
    df = spark.createDataFrame(values, "a bigint, b double, c double, d int").repartition(7)
    got = spark.range(1).select(stats.quartiles(df, ["a", "b", "c", "d"]).alias("q")).first().q

    def plain(i):
        known = sorted(v[i] for v in values if v[i] is not None)
        return [known[-(-k * len(known) // 4) - 1] for k in (1, 2, 3)] if known else None

    assert [got[c] for c in "abcd"] == [plain(i) for i in range(4)]
    with pytest.raises(ValueError):
        stats.quartiles(df, ["a"], method="none")


def test_lookups_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, " "), (5, "b"), (6, "c")], "id int, t string")
    pairs = [("a", "y"), ("a", "x"), ("a", "x"), ("b", "z"), (None, "none"), (" ", "blank")]
    book = spark.createDataFrame(pairs, "s string, u string")
    one = joins.translate_by_dictionary(rows, book, "t", "s", "u", "v")
    assert {r.id: r.v for r in one.collect()} == {1: "x", 2: "x", 3: None, 4: " ", 5: "z", 6: "c"}
    assert one.count() == 6
    assert joins.translate_by_dictionary(rows, book, "t", "s", "u", "v", on_ambiguous="expand").count() == 8
    swapped = joins.replace_by_lookup(rows, book, "t", "s", "u")
    assert {r.id: r.t for r in swapped.collect()} == {1: "x", 2: "x", 3: None, 4: "blank", 5: "z", 6: None}
    with pytest.raises(ValueError):
        joins.replace_by_lookup(rows, book, "t", "s", "u", on_ambiguous="first")


def test_problem_rows_and_empty_reports(spark):
    df = spark.createDataFrame([(1, "A"), (-1, "A"), (None, "X")], "n int, c string")
    found = validate.problem_rows(df, [Rule("positive", "n > 0"), in_list("listed", "c", ["A"])]).first()
    assert tuple(found) == (3, 2, 1, 66.67, 33.33)
    assert tuple(validate.problem_rows(df.limit(0), [not_null("n")]).first()) == (0, 0, 0, None, None)
    none = spark.createDataFrame([], "stage string, row_count bigint")
    assert tuple(validate.retention(none).first()) == (0, 0, 0, None, None)


def test_funnel_stored_once(spark):
    df = spark.createDataFrame([(1,), (1,), (-1,)], "n int")
    good, funnel = validate.funnel(df, [Rule("positive", "n > 0")], stored=True)
    assert [r.n for r in good.collect()] == [1]
    assert {r.stage: r.row_count for r in funnel.collect()} == {"passed": 1, "duplicate": 1, "positive": 1}


def test_zone_counts(spark):
    two, three = spark.range(2), spark.range(3)
    got = reconcile.zone_counts({"raw": {"a": two, "b": three}, "ready": {"a": two, "b": two}, "view": {"a": two}})
    assert {tuple(r) for r in got.collect()} == {("a", 2, 2, 2, "match"), ("b", 3, 2, None, "mismatch")}


def test_parse_integer(spark):
    values = ["12", " -7 ", "x", "1.5", "", "99999999999999999999", None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r.n for r in df.select(parse_integer(F.col("t")).alias("n")).collect()]
    assert got == [12, -7, None, None, None, None, None]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "own1"), (2, "own2"), (None, "own3")], "k int, v string")
    lookup = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "lk int, lv string")
    got = joins.prefer_reference(df, lookup, "k", "v", "lk", "lv")
    assert {(r.k, r.v) for r in got.collect()} == {(1, "a"), (2, "own2"), (None, "own3")}
    with pytest.raises(ValueError):
        joins.prefer_reference(df, lookup, "k", "v", "lk", "lv", on_ambiguous="any")
    todo = joins.untranslated(df, lookup.filter("lv is not null"), "v", "lv")
    assert {r.v for r in todo.collect()} == {"own1", "own2", "own3"}


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None), (4, 9)], "id int, p int")
    parent = spark.createDataFrame([(1,), (2,)], "pid int")
    assert {r.id for r in joins.orphans(child, ["p"], parent, ["pid"]).collect()} == {2, 4}
    audit = validate.foreign_key_audit(
        [Relation("a", child, ["p"], parent, ["pid"]), Relation("b", parent, ["pid"], child, ["id"])]
    )
    assert {tuple(r) for r in audit.collect()} == {("a", 4, 2), ("b", 2, 0)}


def test_rules(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, -1, "q"), (3, None, None), (None, -2, "a")], "id int, x int, c string")
    rules = (not_null("id"), Rule("positive", "x > 0"), Rule("known", "x > 0", null_ok=False), in_list("code", "c", ("a", "b'")))
    flags = {r.id: r for r in validate.flag_rules(df, rules).collect()}
    assert [flags[i].broken_rules for i in (1, 2, 3, None)] == [0, 3, 1, 3]
    report_rows = {r.rule: (r.violations, r.row_count) for r in validate.constraint_report(df, rules).collect()}
    assert report_rows == {"id_not_null": (1, 4), "positive": (2, 4), "known": (3, 4), "code": (1, 4)}
    good, bad = validate.split_by_rules(df, rules)
    assert [r.id for r in good.collect()] == [1]
    assert {(r.id, r.failed_rule) for r in bad.collect()} == {(2, "positive"), (3, "known"), (None, "id_not_null")}


def test_key_audit(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 3)], "a int, b int")
    got = validate.key_audit(df, ["a", "b"], "t").first()
    assert (got.row_count, got.null_key_rows, got.repeated_keys, got.is_key) == (4, 1, 1, False)
    assert validate.key_audit(df.filter("b < 2"), ["a"], "t").first().is_key


def test_funnel_adds_up(rows):
    dull = rows.select("k", "v", "w")
    kept, summary = validate.funnel(dull, (Rule("has v", "v is not null", False), Rule("a only", "w = 'a'", False)))
    counts = {r.stage: r.row_count for r in summary.collect()}
    assert sum(counts.values()) == len(ROWS)
    assert counts["passed"] == kept.count() == len({(k, v, w) for _, k, v, w in ROWS if v and w == "a"})
    share = validate.retention(summary).first()
    assert share.original_rows == len(ROWS) and share.kept_rows == counts["passed"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, float("nan"), "b"), (None, 2.0, None), (3, None, "a")], "i int, x double, s string")
    assert {r.column_name: r.null_count for r in report.null_profile(df).collect()} == {"i": 1, "x": 1, "s": 1}
    assert {r.column_name: r.null_count for r in report.null_profile(df, nan_is_null=True).collect()}["x"] == 2
    profile = {r.column_name: r for r in report.table_profile(df).collect()}
    assert (profile["s"].min_value, profile["s"].max_value, profile["s"].mean) == ("a", "b", None)
    assert profile["i"].mean == 2.0 and profile["i"].null_pct == 33.33
    empty = report.table_profile(df.limit(0)).collect()
    assert [r.row_count for r in empty] == [0, 0, 0] and empty[0].null_pct is None


def test_distribution_adds_up(rows):
    got = report.distribution_report(rows, ["k", "v"]).collect()
    for column in ("k", "v"):
        assert sum(r.row_count for r in got if r.column_name == column) == len(ROWS)
    hot = next(r for r in got if r.column_name == "k" and r.value == "0")
    assert hot.row_count == 1000 and hot.pct == 33.33


def test_column_reconcile(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", None)], "i int, s string, x double")
    shuffled = left.orderBy(F.desc("i"))
    same = reconcile.column_reconcile(left, shuffled)
    assert {r.column_name: r.status for r in same.collect()} == {"i": "match", "s": "match", "x": "match"}
    # same counts, other contents: only the checksum sees it
    other = left.withColumn("s", F.upper("s")).withColumnRenamed("x", "y")
    got = {r.column_name: r.status for r in reconcile.column_reconcile(left, other).collect()}
    assert got == {"i": "match", "s": "mismatch", "x": "missing in copy", "y": "missing in source"}
    for mode in ("approx", None):
        assert {r.status for r in reconcile.column_reconcile(left, shuffled, distinct=mode).collect()} == {"match"}
    with pytest.raises(ValueError):
        reconcile.column_contents(left, distinct="some")


def test_data_dictionary(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "i int, s string")
    got = {r.column_name: (r.position, r.null_count, r.distinct_values, r.is_key) for r in reconcile.data_dictionary({"t": df}, distinct="exact").collect()}
    assert got == {"i": (1, 0, 3, True), "s": (2, 1, 1, False)}


def test_data_dictionary_by_estimates(spark):
    df = spark.range(5_000).select("id", (F.col("id") % 50).alias("few"), F.when(F.col("id") > 0, F.col("id")).alias("hole"))
    got = {r.column_name: r.is_key for r in reconcile.data_dictionary({"t": df}).collect()}
    # what may be a key is left open
    assert got == {"id": None, "few": False, "hole": False}
