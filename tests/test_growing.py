"""Row differences, merged profiles and footers against plain rules."""

import collections
import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import differences, fitted, profiles, report
from tallyloom.sources import footers

ROW = "a int, b string, x double, y double, s struct<p:int,q:string>, m map<string,int>, l array<int>"


def rows(seed, n):
    rng = random.Random(seed)
    some = lambda v: rng.choice([None, v, v])
    return [
        (some(i % 40), some(f"k{i % 7}"), some(rng.random()), some(1.0), some((some(i), some("q"))), some({"u": i, "v": 1}), some([some(1), some(2)]))
        for i in range(n)
    ]


def frozen(v):
    if isinstance(v, dict):
        return tuple(sorted(v.items()))
    return tuple(map(frozen, v)) if isinstance(v, (list, tuple)) else v


def plain_differences(source, copy, width):
    def grouped(rows):
        out = collections.defaultdict(collections.Counter)
        for r in rows:
            out[r[:width]][frozen(r[width:])] += 1
        return out

    a, b = grouped(source), grouped(copy)
    found = {}
    for key in a.keys() | b.keys():
        old, new = a.get(key, collections.Counter()), b.get(key, collections.Counter())
        if old == new:
            continue
        n, m = sum(old.values()), sum(new.values())
        status = "missing in copy" if not m else "missing in source" if not n else "changed" if n == m == 1 else "rows differ"
        changed = None
        if n == m == 1:
            (o,), (w,) = old, new
            changed = tuple(c for c, p, q in zip("xysml", o, w) if p != q)
        found[key] = (n, m, status, changed)
    return found


@pytest.mark.parametrize("levels", [1, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_differences(spark, monkeypatch, levels, seed):
    monkeypatch.setattr(differences, "BUCKETS", 8)
    source, rng = rows(seed, 120), random.Random(seed + 10)
    copy = [r for r in source if rng.random() > 0.05]
    for i in rng.sample(range(len(copy)), 9):
        other = list(copy[i])
        at = rng.randrange(2, 7)
        other[at] = rows(rng.randrange(99), 60)[rng.randrange(60)][at]
        copy[i] = tuple(other)
    copy += rng.sample(source, 3) + [(999, "new", 1.0, None, None, None, None)]
    # two columns of one type that swap a null
    source.append((5_000, "swap", None, 1.0, None, None, None))
    copy.append((5_000, "swap", 1.0, None, None, None, None))
    rng.shuffle(copy)
    left, right = spark.createDataFrame(source, ROW), spark.createDataFrame(copy, ROW).repartition(5)
    got = {(r.a, r.b): (r.source_rows, r.copy_rows, r.status, tuple(r.changed_columns) if r.changed_columns is not None else None) for r in differences.row_differences(left, right, ["a", "b"], levels=levels).collect()}
    assert got == plain_differences(source, copy, 2)
    total = differences.difference_summary(differences.row_differences(left, right, ["a", "b"], levels=levels)).collect()
    assert sum(r["keys"] for r in total) == len(got)


def test_equal_copies_and_odd_tables(spark):
    df = spark.createDataFrame(rows(3, 50), ROW)
    assert differences.row_differences(df, df.orderBy(F.desc("b")), ["a", "b"]).count() == 0
    none = df.limit(0)
    assert differences.row_differences(none, none, ["a"]).count() == 0
    assert {r.status for r in differences.row_differences(df, none, ["a", "b"]).collect()} == {"missing in copy"}
    # another type for a column, a column of one side only, and keys alone
    copy = df.withColumn("a", F.col("a").cast("string")).drop("m").withColumn("extra", F.lit(1))
    assert differences.row_differences(df, copy, ["a", "b"]).count() == 0
    assert differences.row_differences(df.select("a"), df.select("a"), ["a"]).count() == 0
    with pytest.raises(ValueError, match="lacks"):
        differences.row_differences(df, df.drop("a"), ["a"])
    with pytest.raises(ValueError):
        differences.row_differences(df, df, ["a"], levels=3)


def test_equal_buckets_are_left_behind(spark):
    source = spark.range(200_000).select("id", (F.col("id") * 3).alias("v"))
    copy = source.withColumn("v", F.when(F.col("id").isin(77, 100_001), F.lit(-1)).otherwise(F.col("v")))
    one = differences.suspect_rows(source, copy, ["id"], levels=1).count()
    two = differences.suspect_rows(source, copy, ["id"], levels=2).count()
    # two of 1,024 buckets, then two of a million
    assert 200 < one < 1_500 and 4 <= two <= 12
    found = differences.row_differences(source, copy, ["id"]).collect()
    assert sorted((r.id, r.changed_columns) for r in found) == [(77, ["v"]), (100_001, ["v"])]


def test_merged_profile_equals_one_pass(spark, tmp_path):
    rng = random.Random(4)
    data = [(i, rng.choice([None, f"t{rng.randrange(9_000)}"]), rng.choice([None, rng.gauss(1e6, 3)]), decimal.Decimal(rng.randrange(10**6)).scaleb(-2), rng.random() < 0.5, datetime.date(2020, 1, 1) + datetime.timedelta(rng.randrange(400)), [i % 3], {"a": i % 5}) for i in range(30_000)]
    schema = "i bigint, t string, x double, d decimal(12,2), b boolean, day date, l array<int>, m map<string,int>"
    df = spark.createDataFrame(data, schema)
    path = str(tmp_path / "profiles")
    for part in range(4):
        profiles.store_part(df.where(F.col("i") % 4 == part), f"p{part}", path)
    profiles.store_part(df.where("i < 0"), "none", path)
    profiles.store_part(df.where("i % 4 = 2"), "p2", path)
    merged = {r.column_name: r for r in profiles.merged_profile(profiles.stored_profiles(spark, path)).collect()}
    whole = {r.column_name: r for r in report.table_profile(df).collect()}
    assert merged.keys() == whole.keys()
    for name, row in whole.items():
        own = merged[name]
        assert [own[c] for c in ("data_type", "row_count", "null_count", "null_pct")] == [row[c] for c in ("data_type", "row_count", "null_count", "null_pct")]
        if name not in "lm":
            assert (own.min_value, own.max_value) == (row.min_value, row.max_value)
        for c in ("mean", "stddev"):
            assert own[c] is None and row[c] is None or own[c] == pytest.approx(row[c], rel=1e-9), (name, c)
        exact = df.select(F.to_json(F.struct(name)) if name == "m" else name).na.drop().distinct().count()
        assert abs(own.distinct_estimate - exact) <= max(1, 0.05 * exact), name
    assert [merged[n].position for n in merged if n == "x"] == [3]


def test_grown_figures(spark, tmp_path):
    rng = random.Random(8)
    data = [(i, rng.gauss(5, 2), rng.choice([None, rng.randrange(1_000)]), decimal.Decimal(rng.randrange(10**5)).scaleb(-2), "t") for i in range(20_000)]
    df = spark.createDataFrame(data, "i bigint, x double, n int, d decimal(10,2), t string")
    path = str(tmp_path / "parts")
    for part in range(5):
        profiles.store_part(df.where(F.col("i") % 5 == part), f"p{part}", path)
    grown = profiles.grown_figures(profiles.stored_profiles(spark, path))
    assert set(grown.figures) == set("ixnd")
    whole = fitted.fit(df, list("ixnd"), quartiles=list("ixnd"))
    for c, own in grown.figures.items():
        exact = whole.figures[c]
        assert (own.data_type, own.value_count, own.ends) == (exact.data_type, exact.value_count, exact.ends)
        assert own.mean == pytest.approx(exact.mean) and own.stddev == pytest.approx(exact.stddev)
        values = sorted(r[0] for r in df.select(c).na.drop().collect())
        for share, q in zip((0.25, 0.5, 0.75), own.quartiles):
            rank = sum(v <= q for v in values) / len(values)
            assert abs(rank - share) < 0.02, (c, share, rank)
    # they are stored and applied like fitted ones
    grown.store(spark, str(tmp_path / "figures"))
    assert fitted.load(spark, str(tmp_path / "figures")) == grown
    assert set(profiles.grown_figures(profiles.stored_profiles(spark, path), ["x"]).figures) == {"x"}
    assert df.select(grown.above("x", 1).alias("a")).where("a").count() > 1_000


def test_profiles_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "a int, b string")
    path = str(tmp_path / "none")
    profiles.store_part(df, "p", path)
    got = {r.column_name: (r.row_count, r["mean"], r.stddev, r.distinct_estimate, r.min_value) for r in profiles.merged_profile(profiles.stored_profiles(spark, path)).collect()}
    assert got == {"a": (0, None, None, 0, None), "b": (0, None, None, 0, None)}
    assert profiles.merged_profile(profiles.stored_profiles(spark, path).limit(0)).count() == 0
    with pytest.raises(ValueError):
        profiles.store_part(df, "a/b", path)


def test_footers_answer_without_data_pages(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5_000).select("id", (F.col("id") / 4).alias("x"), F.col("id").cast("string").alias("t"), F.when(F.col("id") % 2 == 0, 1).alias("n"), F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("d"))
    df.repartition(3).write.parquet(path)
    plan = footers.footer_aggregate(spark, path, ["id", "x", "n", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)" in plan.replace("pushedAggregation", "PushedAggregation")
    row = footers.footer_figures(spark, path, ["id", "x", "n", "d"]).first()
    assert (row.row_count, row.min_id, row.max_id, row.max_x, row.min_n) == (5_000, 0, 4_999, 4_999 / 4, 1)
    assert row.max_d == datetime.date(2020, 1, 1) + datetime.timedelta(4_999)
    with pytest.raises(ValueError, match="no extremes"):
        footers.footer_figures(spark, path, ["t"])
    # the caller's session reads as before
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    assert footers.footer_figures(spark, str(tmp_path / "empty"), ["id"]).first().row_count == 0
    counts = footers.footer_counts(spark, {"raw": {"t": path}, "copy": {"t": path, "u": path}}).collect()
    assert {tuple(r) for r in counts} == {("t", 5_000, 5_000, "match"), ("u", None, 5_000, "match")}
