"""The most frequent keys of many, and names for misspelt values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.bindings.registry import bound, table
from tallyloom.operators import frequent, report, spelling


@bound("top_k_sketched", "select user_id, count(*) as row_count from events group by 1 order by 2 desc, 1 limit 20")
def top_k_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty most active users, counted among the users that a sketch leaves."""
    return frequent.top_groups(table(spark, folder, "events"), ["user_id"], 20)


@bound(
    "frequent_values_sketched",
    """select text, count(*) as frequency, round(avg(quality)::decimal(38,12), 4)::double as avg_measure from documents
       left join labels using (doc_id) where text is not null group by 1 having count(*) > 1
       order by 2 desc, 1 limit 10""",
)
def frequent_values_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """The texts that repeat most: long texts are shuffled for the candidates only."""
    texts = frequent.keep_frequent(table(spark, folder, "documents").dropna(subset=["text"]), ["text"], 10)
    rows = texts.join(table(spark, folder, "labels"), "doc_id", "left")
    top = report.frequent_values(rows, "text", "quality", 10)
    return top.withColumn("avg_measure", F.round("avg_measure", 4))


# what happens to a nation's name, by the supplier's key
_SPOILED_SQL = """case when s_suppkey % 6 = 1 then n_name[1:2] || n_name[4:] when s_suppkey % 6 = 2 then n_name[1:3] || 'Q' || n_name[4:]
    when s_suppkey % 6 = 3 then 'X' || n_name[2:] when s_suppkey % 6 = 4 then lower(n_name)
    when s_suppkey % 6 = 5 then n_name[1:1] || n_name[3:] || 'Z' else n_name end"""


@bound(
    "name_proposals",
    f"""with v as (select {_SPOILED_SQL} as value, count(*) as row_count from supplier join nation on s_nationkey = n_nationkey group by 1),
       u as (select * from v where lower(value) not in (select lower(n_name) from nation)),
       d as (select value, n_name, levenshtein(lower(value), lower(n_name)) as e from u, nation),
       k as (select *, case when length(value) < 2 then 0 when length(value) < 4 then 1 else 2 end as m,
         case when length(n_name) < 4 then 1 else 2 end as n from d),
       b as (select value, min(e) as edits, count(*) as candidates, arg_min(n_name, (e, n_name)) as proposal from k
         where e <= m and e <= n group by 1)
       select value, row_count, proposal, edits::int as edits, coalesce(candidates, 0) as candidates from u left join b using (value)""",
)
def name_proposals(spark: SparkSession, folder: str) -> DataFrame:
    """Nation names of suppliers with letters lost, added and changed, and the name each stands for."""
    nation = table(spark, folder, "nation")
    rows = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    name, way = F.col("n_name"), F.col("s_suppkey") % 6
    cut = lambda a, b=None: F.substr(name, F.lit(a)) if b is None else F.substring(name, a, b - a + 1)
    spoiled = (
        F.when(way == 1, F.concat(cut(1, 2), cut(4)))
        .when(way == 2, F.concat(cut(1, 3), F.lit("Q"), cut(4)))
        .when(way == 3, F.concat(F.lit("X"), cut(2)))
        .when(way == 4, F.lower(name))
        .when(way == 5, F.concat(cut(1, 1), cut(3), F.lit("Z")))
        .otherwise(name)
    )
    return spelling.propose_names(rows.select(spoiled.alias("nation")), "nation", nation, "n_name")
