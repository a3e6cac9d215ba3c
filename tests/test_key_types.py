"""Lookups and audits between keys of unlike types."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, DecimalType, DoubleType, IntegerType, LongType, ShortType, StringType

from tallyloom.operators import joins


def test_common_types():
    assert joins.key_type(LongType(), LongType()) is None
    assert joins.key_type(IntegerType(), ShortType()) == LongType()
    assert joins.key_type(StringType(), IntegerType()) == LongType()
    assert joins.key_type(DoubleType(), StringType()) == DoubleType()
    assert joins.key_type(DecimalType(10, 2), LongType()) == DecimalType(21, 2)
    assert joins.key_type(DecimalType(38, 10), DecimalType(5, 1)) == DecimalType(38, 10)
    assert joins.key_type(StringType(), DateType()) == DateType()
    with pytest.raises(ValueError):
        joins.key_type(BinaryType(), LongType())


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_text_against_integers(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rows = spark.createDataFrame([("01310", "a"), ("1310", "b"), ("abc", "c"), (None, "d"), ("7", "e"), ("7.5", "f")], "code string, city string")
        numbers = spark.createDataFrame([(1310, "Sao Paulo"), (None, "none")], "id int, name string")
        got = joins.prefer_reference(rows, numbers, "code", "city", "id", "name")
        assert sorted((r.code or "", r.city) for r in got.collect()) == [("", "d"), ("01310", "Sao Paulo"), ("1310", "Sao Paulo"), ("7", "e"), ("7.5", "f"), ("abc", "c")]
        back = joins.replace_by_lookup(numbers, rows, "id", "code", "city")
        # both texts are one key there: they vote together, the smaller of two equals wins
        assert {r.name: r.id for r in back.collect()} == {"Sao Paulo": "a", "none": None}
        assert back.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_other_unlike_types(spark):
    dates = spark.createDataFrame([("2020-01-02", 1), ("soon", 2)], "day string, n int")
    days = spark.createDataFrame([(datetime.date(2020, 1, 2), "new")], "d date, label string")
    assert {r.n: r.label for r in joins.translate_by_dictionary(dates, days, "day", "d", "label", "label").collect()} == {1: "new", 2: "soon"}
    prices = spark.createDataFrame([(decimal.Decimal("1.50"),), (decimal.Decimal("2.00"),)], "p decimal(10,2)")
    codes = spark.createDataFrame([(2, "two")], "c bigint, label string")
    assert [r.label for r in joins.replace_by_lookup(prices.withColumn("label", F.col("p")), codes, "label", "c", "label").orderBy("p").collect()] == [None, "two"]


def test_orphans_of_unlike_types(spark):
    child = spark.createDataFrame([("01",), ("2",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([(1,), (3,)], "id bigint")
    assert sorted(r.k for r in joins.orphans(child, ["k"], parent, ["id"]).collect()) == ["2", "x"]
    assert [r.id for r in joins.orphans(parent, ["id"], child, ["k"]).collect()] == [3]
