"""Landing without repeats, publication in versions, tables stored by key."""

import collections
import datetime
import threading

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import joins, validate
from tallyloom.operators.validate import Relation
from tallyloom.sources import catalog, versions
from tallyloom.streaming import unique

SCHEMA = "k int, t timestamp, v string"


def event(k, day=1, v="x"):
    return (k, datetime.datetime(2024, 1, day, 12) if day else None, v)


def landed(spark, root):
    return collections.Counter((r.k, r.t) for r in unique.read_landed(spark, f"{root}/landed").collect())


def arrive(spark, root, rows, parts=1):
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.mode("append").parquet(f"{root}/inbox")


def land(spark, root, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    options = {"event_time": "t", "buckets": 3} | options
    unique.land_unique(spark, f"{root}/inbox", schema, f"{root}/landed", f"{root}/progress", ["k"], **options)


def test_each_event_once(spark, tmp_path):
    root = str(tmp_path)
    first = [event(i % 40, 1 + i % 5) for i in range(200)] + [event(None, 2), event(None, 2), event(7, None), event(7, None)]
    expected = collections.Counter({(k, t): 1 for k, t, _ in first})
    arrive(spark, root, first, 4)
    land(spark, root, files_per_batch=1)
    assert landed(spark, root) == expected
    # the same files' events again, late ones, and new ones; a run for each arrival
    second = first[50:120] + [event(500 + i, 9) for i in range(10)] * 2 + [event(3, 20)]
    expected.update({(k, t): 1 for k, t, _ in second if (k, t) not in expected})
    arrive(spark, root, second, 3)
    land(spark, root, files_per_batch=2)
    assert landed(spark, root) == expected
    land(spark, root)
    assert landed(spark, root) == expected
    arrive(spark, root, first, 2)
    land(spark, root)
    assert landed(spark, root) == expected


def test_without_event_time_keys_alone_count(spark, tmp_path):
    root = str(tmp_path)
    for day in (1, 2):
        arrive(spark, root, [event(i, day) for i in range(20)])
        land(spark, root, event_time=None)
    assert sorted(k for k, _ in landed(spark, root).elements()) == list(range(20))


@pytest.mark.parametrize("fails_at", ["events", "nothing"])
def test_a_batch_that_dies_is_repeated(spark, tmp_path, monkeypatch, fails_at):
    root, calls = str(tmp_path), []
    rows = [event(i % 30, 1 + i % 3) for i in range(90)]
    arrive(spark, root, rows[:60])
    land(spark, root)
    arrive(spark, root, rows)
    keep = unique.materialise

    def dies(df, label):
        out = keep(df, label)
        if label == "fresh" and not calls:
            calls.append(1)
            # as if the events were written and the run died before the index was
            if fails_at == "events":
                out.drop(unique.DAY, unique.BUCKET).write.mode("overwrite").parquet(f"{root}/landed/events/{unique.BATCH}=1")
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(unique, "materialise", dies)
    with pytest.raises(Exception, match="lost"):
        land(spark, root)
    monkeypatch.setattr(unique, "materialise", keep)
    land(spark, root)
    assert landed(spark, root) == collections.Counter({(k, t): 1 for k, t, _ in rows})
    # and once more after the index was written: the same batch again gives the same
    unique.land_batch(spark.createDataFrame(rows, SCHEMA), 1, f"{root}/landed/events", f"{root}/landed/keys", ["k"], "t", 3)
    assert landed(spark, root) == collections.Counter({(k, t): 1 for k, t, _ in rows})


def test_late_repeats_read_few_cells(spark, tmp_path):
    root = str(tmp_path)
    arrive(spark, root, [event(i, 1 + i % 20) for i in range(400)])
    land(spark, root, buckets=8)
    late = spark.createDataFrame([event(21, 2)], SCHEMA)
    marked = late.withColumns({unique.DAY: unique._day("t"), unique.BUCKET: F.pmod(F.xxhash64("k"), F.lit(8)).cast("int")})
    known = unique._landed_keys(marked, f"{root}/landed/keys", ["k"], 99)
    files = known.inputFiles()
    assert known.where("k0 = 21").count() == 1
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len({f.rsplit("/", 1)[0] for f in files}) >= 1
    assert known.count() < 20
    with pytest.raises(ValueError):
        unique.land_unique(spark, root, late.schema, root, root, [])


# ---------------------------------------------------------------- versions


def test_a_reader_never_finds_the_table_absent(spark, tmp_path):
    root, name = str(tmp_path / "v"), "vw_loop"
    make = lambda n: spark.range(100).select("id", F.lit(n).alias("version"))
    versions.publish_version(make(1), name, root, keep=4)
    seen, failures, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                rows = spark.table(name).groupBy("version").count().collect()
                seen.append([tuple(r) for r in rows])
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(2, 22):
            versions.publish_version(make(n), name, root, keep=4)
    finally:
        done.set()
        reader.join()
    assert not failures and len(seen) > 5
    # always one whole version, never an older one than before
    assert all(len(rows) == 1 and rows[0][1] == 100 for rows in seen)
    numbers = [rows[0][0] for rows in seen]
    assert numbers == sorted(numbers) and spark.table(name).first().version == 21
    assert [v.number for v in versions.versions(spark, root)] == [18, 19, 20, 21]


def test_versions_change_columns_roll_back_and_survive_failures(spark, tmp_path):
    root, name = str(tmp_path / "v"), "vw_changing"
    one = versions.publish_version(spark.range(3), name, root)
    versions.publish_version(spark.range(4).withColumn("more", F.lit("x")), name, root)
    assert spark.table(name).columns == ["id", "more"]
    broken = spark.range(5).withColumn("id", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        versions.publish_version(broken, name, root)
    assert spark.table(name).count() == 4 and [v.number for v in versions.versions(spark, root)] == [1, 2]
    assert versions.roll_back(spark, name, root, 1).path == one.path
    assert spark.table(name).count() == 3
    with pytest.raises(ValueError):
        versions.roll_back(spark, name, root, 9)
    assert versions.publish_version(spark.range(6), name, root, keep=2).number == 3
    assert [v.number for v in versions.versions(spark, root)] == [2, 3] and spark.table(name).count() == 6
    # nothing unfinished is left behind
    assert len([p for p in (tmp_path / "v").iterdir()]) == 2
    with pytest.raises(ValueError):
        versions.publish_version(spark.range(1), name, root, keep=1)
    assert versions.versions(spark, str(tmp_path / "none")) == [] and versions.expire(spark, str(tmp_path / "none"), 2) == []


# ---------------------------------------------------------------- tables stored by key


def test_joins_of_bucketed_tables_exchange_neither(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(2_000).select((F.col("id") % 300).alias("k"), "id")
        names = spark.range(250).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
        left = catalog.create_bucketed_table(facts, "facts_by_key", str(tmp_path / "facts"), ["k"], 4)
        right = catalog.create_bucketed_table(names, "names_by_key", str(tmp_path / "names"), ["k"], 4)
        assert len(list((tmp_path / "facts").glob("part-*"))) == 4
        lost = joins.orphans(left, ["k"], right, ["k"])
        plan = lost._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert lost.count() == sum(i % 300 >= 250 for i in range(2_000))
        audit = validate.foreign_key_audit([Relation("r", left, ["k"], right, ["k"])])
        # the only exchange is that of the totals
        assert "hashpartitioning" not in audit._jdf.queryExecution().executedPlan().toString()
        assert tuple(audit.first()) == ("r", 2_000, lost.count())
        again = catalog.create_bucketed_table(names, "names_by_key", str(tmp_path / "names2"), ["k"], 2)
        assert again.count() == 250
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
