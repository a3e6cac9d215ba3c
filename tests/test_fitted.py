"""Selection of quantiles and fitted statistics against plain rules."""

import decimal
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import fitted, selection, stats
from tallyloom.streaming.incremental import land_new_files

SHARES = (0.0, 0.25, 0.5, 0.9, 1.0)


def plain(values, shares):
    known = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    return [known[max(0, math.ceil(s * len(known)) - 1)] for s in shares] if known else None


def numbers(seed, n):
    rng = random.Random(seed)
    wide = [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(n)]
    return {
        "heavy bigint": [rng.choice([None, 7, 7, 7, rng.randrange(50)]) for _ in range(n)],
        "edges bigint": [rng.choice([-(2**63), 2**63 - 1, 2**62 + rng.randrange(1_000), -(2**62) - rng.randrange(9)]) for _ in range(n)],
        "small tinyint": [rng.randrange(-128, 128) for _ in range(n)],
        "wide double": [rng.choice([0.0, -0.0, w]) for w in wide],
        "odd double": [rng.choice([float("nan"), float("inf"), float("-inf"), None, 1.5, w]) for w in wide],
        "single float": [float(rng.randrange(1 << 20)) / 8 for _ in range(n)],
        "exact decimal(38,10)": [decimal.Decimal(f"{rng.randrange(-(10**27), 10**27)}.{rng.randrange(10**10):010}") for _ in range(n)],
        "close decimal(20,18)": [decimal.Decimal(10**18 + rng.randrange(40)).scaleb(-18) for _ in range(n)],
        "none int": [None] * n,
    }


@pytest.mark.parametrize("seed, n", [(1, 1), (2, 2), (3, 9), (4, 5_000)])
@pytest.mark.parametrize("parts", [2, 2_048])
def test_selection_is_exact(spark, monkeypatch, seed, n, parts):
    if parts == 2 and n > 9:
        pytest.skip("many passes")
    monkeypatch.setattr(selection, "PARTS", parts)
    data = numbers(seed, n)
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(data)).repartition(5)
    columns = [name.split()[0] for name in data]
    got = selection.select_quantiles(df, columns, SHARES, keep=seed % 2 == 0)
    for name, column in zip(data, columns):
        want = plain(data[name], SHARES)
        assert (got[column] is None) == (want is None), name
        assert all(a == b or a != a and b != b for a, b in zip(got[column] or [], want or [], strict=True)), name


def test_a_guess_that_misses_costs_a_pass_only(spark, monkeypatch):
    rows = [(i * i % 9_973,) for i in range(4_000)]
    df = spark.createDataFrame(rows, "v int")
    opened = selection._opened

    def astray(*args):
        out = opened(*args)
        for targets in out.values():
            for i, t in enumerate(targets):
                t.low = t.high = (t.least, t.most)[i % 2]
        return out

    monkeypatch.setattr(selection, "_opened", astray)
    assert selection.select_quantiles(df, ["v"], SHARES)["v"] == plain([r[0] for r in rows], SHARES)


def test_rows_that_change_between_passes_are_an_error():
    target = selection._Target("v", 0, None, 50, 3, 9, 0, 9)
    with pytest.raises(RuntimeError, match="changed"):
        # neither below the bracket nor in it, nor beyond: fewer rows than were counted before
        for _ in range(3):
            selection._narrow(target, [(-1, 0, None, None)])


def test_nothing_is_stored_and_literals_stay(spark):
    df = spark.range(1_000).select((F.col("id") * 3).alias("v"))
    plan = spark.range(1).select(stats.quartiles(df, ["v"]).alias("q"))._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "Subquery" not in plan
    with pytest.raises(ValueError, match="not a number"):
        selection.select_quantiles(spark.createDataFrame([("a",)], "t string"), ["t"], (0.5,))


def test_text_and_dates_have_quartiles_too(spark):
    df = spark.createDataFrame([(c, i) for i, c in enumerate("dacbe")], "t string, n int").withColumn("d", F.date_add(F.lit("2020-01-01"), F.col("n")))
    got = spark.range(1).select(stats.quartiles(df, ["t", "d", "n"]).alias("q")).first().q
    assert list(got.t) == ["b", "c", "d"] and [str(d) for d in got.d] == ["2020-01-02", "2020-01-03", "2020-01-04"] and list(got.n) == [1, 2, 3]


FIGURES = "a bigint, b double, c decimal(12,2), d double, e float"


def test_figures_read_back_unchanged(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(2**60), rng.random() / 3, decimal.Decimal(rng.randrange(10**8)).scaleb(-2), None, rng.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, FIGURES)
    made = fitted.fit(df, list("abcde"), quartiles=list("abde"))
    made.store(spark, str(tmp_path / "figures"))
    assert fitted.load(spark, str(tmp_path / "figures")) == made
    assert made.figures["c"].quartiles is None and made.figures["d"].quartiles is None and made.figures["d"].value_count == 0
    assert made.figures["a"].quartiles == tuple(plain([r[0] for r in rows], (0.25, 0.5, 0.75)))
    with pytest.raises(ValueError):
        fitted.fit(df, ["a"], quartiles=["b"])
    assert fitted.fit(df, []).table(spark).count() == 0


def test_applied_figures_equal_the_batch(spark, tmp_path):
    rows = [(i, None if i % 11 == 0 else float(i * i % 97)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, x double")
    figures = fitted.fit(df, ["x"], quartiles=["x"])

    def classed(rows, figures):
        flagged = stats.flag_upper_outliers(rows, {"x": "high"}, sigmas=1.2, figures=figures)
        return stats.add_zscore(flagged, "x", sigmas=1.1, figures=figures)

    batch = classed(df, None).withColumn("tier", stats.volume_tier(F.col("x"), figures.quartiles("x")))
    inbox, landed = str(tmp_path / "inbox"), str(tmp_path / "landed")
    for part in range(3):
        df.where(f"i % 3 = {part}").write.mode("append").parquet(inbox)
        # a run of its own each time, as after a restart
        land_new_files(spark, inbox, df.schema, landed, str(tmp_path / "progress"), transform=lambda r: classed(r, figures).withColumn("tier", stats.volume_tier(F.col("x"), figures.quartiles("x"))))
    stream = spark.read.parquet(landed)
    assert sorted(map(repr, stream.collect())) == sorted(map(repr, batch.collect()))
    assert stream.count() == 300 and stream.where("high").count() > 0
    flat = fitted.fit(df.where("i = 1"), ["x"])
    assert [r.zscore for r in stats.add_zscore(df.where("i = 1"), "x", figures=flat).collect()] == [None]
