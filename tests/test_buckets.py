"""Tables stored by key: the number of buckets follows the tables."""

import pathlib

import pytest
from pyspark.sql import functions as F

from tallyloom.bindings import QUERIES
from tallyloom.session import shared_root
from tallyloom.sources import catalog

FOLDER = "/root/testdata/sf0.001"


def test_bucket_count_follows_the_longest_table(spark):
    tables = [spark.range(5), spark.range(1_000)]
    assert catalog.bucket_count(tables) == 8
    assert catalog.bucket_count(tables, 8, rows=125) == 8
    assert catalog.bucket_count(tables, 8, rows=124) == 16
    assert catalog.bucket_count(tables, 3, rows=10) == 192
    assert catalog.bucket_count([spark.range(0)], 1) == 1
    with pytest.raises(ValueError):
        catalog.bucket_count(tables, 0)


def test_key_audit_has_more_buckets_for_more_rows(spark, monkeypatch):
    counted = catalog.bucket_count
    monkeypatch.setattr(catalog, "bucket_count", lambda tables, least: counted(tables, least, rows=200))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        audit = QUERIES["bucketed_fk_audit"](spark, FOLDER)
        assert "hashpartitioning" not in audit._jdf.queryExecution().executedPlan().toString()
        found = audit.first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    kept = spark.read.parquet(f"{FOLDER}/orders.parquet").where("o_orderstatus <> 'P'")
    lost = lines.join(kept, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").count()
    assert tuple(found)[1:] == (lines.count(), lost)
    buckets = counted([lines], 8, rows=200)
    assert buckets >= 32
    stored = max(pathlib.Path(shared_root(spark).removeprefix("file:")).glob("tallyloom/bucketed-*"), key=lambda p: p.stat().st_mtime)
    sizes = [spark.read.parquet(str(p)).count() for p in (stored / "lines").glob("part-*")]
    # of 6,000 lines, where 8 buckets had 700 or more
    assert len(sizes) == buckets and max(sizes) < 450
