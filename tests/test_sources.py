"""Reading, publishing, landing and incremental landing."""

import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyloom.functions import text
from tallyloom.session import materialise, scratch_path, shared_root, temporary_copies
from tallyloom.sources import catalog, publish, readers
from tallyloom.streaming.incremental import land_new_files

SCHEMA = StructType([StructField("id", IntegerType()), StructField("note", StringType())])
NOTES = [(1, 'said "no"'), (2, "two\nlines"), (3, " spaced "), (4, None), (5, "a,b"), (6, "cr\r\nlf")]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "notes")
    publish.write_rejects(spark.createDataFrame(NOTES, SCHEMA), path, as_csv=True)
    back = readers.read_csv(spark, path, SCHEMA, multi_line=True)
    assert {tuple(r) for r in back.collect()} == set(NOTES)


def test_schema_load_splits_off_bad_rows(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("id,note\n1,fine\nx,bad id\n3,too,many\n,null id\n")
    good, bad = readers.load_with_schema(spark, str(tmp_path / "raw.csv"), SCHEMA)
    assert {tuple(r) for r in good.collect()} == {(1, "fine"), (None, "null id")}
    # the verdict does not depend on the columns selected
    assert good.select("note").count() == 2
    faults = {r.id: r["_faulty_columns"] for r in bad.collect()}
    assert faults["x"] == ["id"] and len(faults) == 2
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
        readers.load_or_fail(spark, str(tmp_path / "raw.csv"), SCHEMA).collect()


def test_publish_swaps_and_verifies(spark, tmp_path):
    path = str(tmp_path / "table")
    first = publish.publish(spark.range(10).repartition(4), path)
    assert first.verified and first.rows_read == 10 and first.files == 4
    second = publish.publish(spark.range(7).repartition(4), path, compact=True)
    assert second.rows_read == 7 and second.files == 1
    assert sorted(p.name for p in tmp_path.iterdir()) == ["table"]
    many = publish.publish(spark.range(20000).repartition(8), path, compact=True, target_file_bytes=30_000)
    assert 1 < many.files < 8 and many.rows_read == 20000


def test_failed_publish_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    publish.publish(spark.range(5), path)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        publish.publish(broken, path)
    assert spark.read.parquet(path).count() == 5


def test_land_many(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("id,note\n1,x\n2,y\n")
    raw = [publish.RawTable("a", str(tmp_path / "a.csv"), SCHEMA), publish.RawTable("b", str(tmp_path / "b.csv"))]
    landed = publish.land(spark, raw, str(tmp_path / "zone"))
    assert [p.rows_read for p in landed] == [2, 2]
    assert readers.read_table(spark, str(tmp_path / "zone"), "b").dtypes == [("id", "int"), ("note", "string")]


def test_land_keeps_rejects(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("id,note\n1,fine\nx,bad id\n3\n4,too,many\n,null id\n")
    raw = publish.RawTable("raw", str(tmp_path / "raw.csv"), "id int, note string")
    landed = publish.land(spark, [raw], str(tmp_path / "zone"))[0]
    assert (landed.rows_written, landed.rows_rejected, landed.verified) == (2, 3, True)
    good = {tuple(r) for r in spark.read.parquet(str(tmp_path / "zone/raw.parquet")).collect()}
    assert good == {(1, "fine"), (None, "null id")}
    assert spark.read.parquet(str(tmp_path / "zone/raw_rejects")).count() == 3
    with pytest.raises(ValueError, match="3 lines rejected"):
        publish.land(spark, [raw], str(tmp_path / "zone"), on_rejects="fail")


def test_partitioned_publish(spark, tmp_path):
    rows = spark.range(1000).withColumn("kind", F.col("id") % 3).repartition(8)
    done = publish.publish(rows, str(tmp_path / "kinds"), partition_by=["kind"])
    assert (done.files, done.rows_read) == (3, 1000)


def test_temporary_copies_go(spark, tmp_path):
    with temporary_copies(spark):
        kept = materialise(spark.range(3), "kept")
        assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)not.exist|PATH_NOT_FOUND"):
        spark.read.parquet(kept.inputFiles()[0]).count()


def test_view_and_external_table(spark, tmp_path):
    publish.publish(spark.range(6), str(tmp_path / "t"))
    catalog.publish_view(spark, "v_range", str(tmp_path / "t"))
    assert catalog.query_published(spark, "select sum(id) as s from v_range").first().s == 15
    stored = catalog.create_external_table(spark, "x_range", "v_range", str(tmp_path / "x"))
    assert stored.count() == 6
    assert any("snappy" in p.name for p in pathlib.Path(tmp_path / "x").iterdir())
    with pytest.raises(ValueError):
        catalog.publish_view(spark, "bad name; drop", str(tmp_path / "t"))


def test_incremental_landing_takes_each_file_once(spark, tmp_path):
    inbox, target, progress = (str(tmp_path / n) for n in ("inbox", "target", "progress"))
    rows = spark.createDataFrame([(1, "são paulo"), (2, "rio DE janeiro")], SCHEMA)

    def run():
        land_new_files(
            spark, inbox, SCHEMA, target, progress,
            transform=lambda df: df.withColumn("note", text.title_case(F.col("note"))),
        )
        return sorted(tuple(r) for r in spark.read.parquet(target).collect())

    rows.write.mode("append").parquet(inbox)
    once = [(1, "São Paulo"), (2, "Rio de Janeiro")]
    assert run() == once
    assert run() == once  # nothing new
    spark.createDataFrame([(3, "itu")], SCHEMA).write.mode("append").parquet(inbox)
    assert run() == [*once, (3, "Itu")]
