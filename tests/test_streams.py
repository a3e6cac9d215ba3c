"""Row-wise operators give on a stream what they give on a batch."""

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import dates, text
from tallyloom.operators import classify, joins, validate
from tallyloom.operators.validate import Rule, in_list
from tallyloom.plans import orders, rules
from tallyloom.streaming.incremental import land_new_files

ROWS = [
    (1, "são  PAULO-sp", "credit_card", 3, 10.5, "2024-01-02 03:04:05", "2024-01-05 00:00:00"),
    (2, None, "boleto", 0, None, None, "2024-01-01 00:00:00"),
    (3, "rio d'ouro", None, 2, -1.0, "2024-02-30 00:00:00", None),
    (4, " BH ", "voucher", None, 0.0, "2024-01-09 10:00:00", "2024-01-03 00:00:00"),
]
SCHEMA = "id int, city string, kind string, n int, price double, bought string, due string"


def place(df):
    folded = text.fold_place(F.col("city"))
    return df.select("id", text.title_case(folded).alias("a"), text.alias_then_title(F.col("city"), rules.CITY_ALIASES, rules.CITY_MARKERS).alias("b"), text.pad_code(F.col("id")).alias("c"))


def payments(df):
    return orders.clean_payments(df.select("id", F.lit(1).alias("payment_sequential"), F.col("kind").alias("payment_type"), F.col("n").alias("payment_installments"), F.col("price").alias("payment_value")))


def times(df):
    bought, due = (dates.parse_timestamp(F.col(c)) for c in ("bought", "due"))
    rated = df.withColumn("late", classify.delivery_performance(F.col("kind"), bought, due))
    return rated.select("id", "late", dates.days_between(bought, due).alias("days"), text.has_text(F.col("city")).alias("t"))


def flagged(df):
    return validate.flag_rules(df, [Rule("positive", "price > 0"), in_list("listed", "kind", ["boleto"])]).select("id", "positive", "listed", "broken_rules")


def corrected(df):
    return df.select("id", text.correct_words(F.col("city"), {"rio": "river", "PAULO": "paul"}).alias("w"), text.plain_review(F.col("city")).alias("p"))


def looked_up(df):
    names = df.sparkSession.createDataFrame([("boleto", "slip"), ("voucher", "note"), ("voucher", "note")], "k string, v string")
    return joins.translate_by_dictionary(df, names, "kind", "k", "v", "named").select("id", "named")


@pytest.mark.parametrize("operator", [place, payments, times, flagged, corrected, looked_up])
def test_stream_equals_batch(spark, tmp_path, operator):
    df = spark.createDataFrame(ROWS, SCHEMA)
    inbox = str(tmp_path / "inbox")
    for half in (0, 1):
        df.where(f"id % 2 = {half}").write.mode("append").parquet(inbox)
        land_new_files(spark, inbox, df.schema, str(tmp_path / "landed"), str(tmp_path / "progress"), transform=operator)
    landed = spark.read.parquet(str(tmp_path / "landed"))
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, operator(df).collect())) and landed.count() == len(ROWS)
