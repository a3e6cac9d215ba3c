"""Projection, filters, joins, aggregates, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from tallyloom.bindings.registry import bound, sql_initcap, sql_pct, table
from tallyloom.functions import dates
from tallyloom.functions.ladders import first_match
from tallyloom.functions.numbers import null_if_not_positive, percent, percent_decimal, percent_text
from tallyloom.functions.text import slug_title
from tallyloom.operators import dedup, joins, report, stats, validate
from tallyloom.operators.scalars import with_scalar


def _ship_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Last ship date per order; orders without lines have none."""
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped_at"))


def _orders_shipped(spark: SparkSession, folder: str) -> DataFrame:
    orders, shipped = table(spark, folder, "orders"), _ship_dates(spark, folder)
    return orders.join(shipped, orders["o_orderkey"] == shipped["l_orderkey"], "left").drop("l_orderkey")


SHIPPED_SQL = """select o.*, s.shipped_at from orders o left join
    (select l_orderkey, max(l_shipdate) as shipped_at from lineitem group by 1) s on o_orderkey = l_orderkey"""


# ---------------------------------------------------------------- projection and filters


@bound(
    "project_publish",
    "select c_custkey as customer_id, c_mktsegment as customer_segment, c_name as customer_name from customer",
)
def project_publish(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_name").alias("customer_name"),
    )


@bound(
    "rename_drop",
    "select p_partkey as part_id, p_name as part_name, p_brand, p_type, p_retailprice from part",
)
def rename_drop(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.withColumnsRenamed({"p_partkey": "part_id", "p_name": "part_name"}).drop("p_size")


@bound(
    "typed_cast",
    """select l_orderkey::varchar as order_code, l_quantity::int as quantity, l_shipdate::date as ship_day,
       try_cast(l_returnflag as int) as flag_number from lineitem""",
)
def typed_cast(spark: SparkSession, folder: str) -> DataFrame:
    schema = StructType(
        [
            StructField("order_code", StringType()),
            StructField("quantity", IntegerType()),
            StructField("ship_day", DateType()),
            StructField("flag_number", IntegerType()),
        ]
    )
    renames = {
        "l_orderkey": "order_code",
        "l_quantity": "quantity",
        "l_shipdate": "ship_day",
        "l_returnflag": "flag_number",
    }
    return validate.conform(table(spark, folder, "lineitem"), schema, renames)


@bound(
    "require_fields",
    f"select o_orderkey, o_orderstatus, shipped_at from ({SHIPPED_SQL}) where shipped_at is not null",
)
def require_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_shipped(spark, folder).select("o_orderkey", "o_orderstatus", "shipped_at")
    return rows.dropna(subset=["o_orderkey", "o_orderstatus", "shipped_at"])


@bound(
    "range_filter",
    """select l_orderkey, l_linenumber, l_extendedprice, l_tax from lineitem
       where l_extendedprice between 1000 and 50000 and l_tax >= 0.02 and l_tax <= 0.06""",
)
def range_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    return rows.filter(F.col("l_extendedprice").between(1000, 50000) & F.col("l_tax").between(0.02, 0.06))


@bound(
    "date_window_filter",
    """select l_orderkey, l_linenumber, l_shipdate from lineitem
       where l_shipdate between timestamp '1996-01-01' and timestamp '1998-12-31'""",
)
def date_window_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return rows.filter(dates.within(F.col("l_shipdate"), "1996-01-01", "1998-12-31"))


@bound("not_future", "select event_id, ts from events where ts::date <= date '2024-01-15'")
def not_future(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "ts").filter(
        dates.not_after_day(F.col("ts"), "2024-01-15")
    )


@bound(
    "ordered_pair_filter",
    """select o_orderkey, o_orderdate, l_linenumber, l_shipdate from orders
       join lineitem on o_orderkey = l_orderkey where l_shipdate >= o_orderdate""",
)
def ordered_pair_filter(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    pairs = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).drop("l_orderkey")
    return pairs.filter(F.col("l_shipdate") >= F.col("o_orderdate"))


@bound(
    "predicate_mix",
    """select p_partkey, p_name, p_brand, p_type, p_size from part where
       (p_type in ('SMALL', 'PROMO') or p_name like 'old%') and not regexp_matches(p_brand, '#1[0-9]$')
       and suffix(p_name, 'd') = false and p_size <> 7 and p_retailprice is not null
       and p_size between 3 and 48""",
)
def predicate_mix(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    kind = F.col("p_type").isin("SMALL", "PROMO") | F.col("p_name").like("old%")
    kept = (
        kind
        & ~F.col("p_brand").rlike("#1[0-9]$")
        & ~F.col("p_name").endswith("d")
        & (F.col("p_size") != 7)
        & F.col("p_retailprice").isNotNull()
        & F.col("p_size").between(3, 48)
    )
    return part.filter(kept).drop("p_retailprice")


@bound(
    "nullify_nonpositive",
    "select c_custkey, case when c_acctbal <= 0 then null else c_acctbal end as c_acctbal from customer",
)
def nullify_nonpositive(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return rows.withColumn("c_acctbal", null_if_not_positive(F.col("c_acctbal")))


@bound(
    "case_chain",
    """select o_orderkey, case when o_totalprice > 400000 and o_orderstatus = 'F' then 'large closed'
         when o_totalprice > 400000 then 'large' when o_orderpriority like '1-%' then 'urgent'
         else 'ordinary' end as order_class from orders""",
)
def case_chain(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    cases = [
        ((price > 400000) & (F.col("o_orderstatus") == "F"), F.lit("large closed")),
        (price > 400000, F.lit("large")),
        (F.col("o_orderpriority").like("1-%"), F.lit("urgent")),
    ]
    label = first_match(cases, "ordinary").alias("order_class")
    return table(spark, folder, "orders").select("o_orderkey", label)


@bound("sample_rows", "select * from orders order by o_orderkey limit 25")
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").orderBy("o_orderkey").limit(25)


# ---------------------------------------------------------------- joins


@bound(
    "lookup_coalesce",
    """select c_custkey, coalesce(n_name, c_mktsegment) as c_mktsegment from customer
       left join (select * from nation where n_regionkey <> 0) on c_nationkey = n_nationkey""",
)
def lookup_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, folder, "nation").filter("n_regionkey <> 0")
    return joins.prefer_reference(
        customer, nation, "c_nationkey", "c_mktsegment", "n_nationkey", "n_name"
    ).drop("c_nationkey")


@bound(
    "lookup_expand",
    """select c_custkey, coalesce(p, c_mktsegment) as c_mktsegment from customer
       left join (select distinct o_custkey as k, o_orderpriority as p from orders) on c_custkey = k""",
)
def lookup_expand(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, folder, "orders")
    return joins.prefer_reference(
        customer, orders, "c_custkey", "c_mktsegment", "o_custkey", "o_orderpriority", on_ambiguous="expand"
    )


@bound(
    "category_lookup",
    f"""select p_partkey, p_name, m.title as p_type from part left join
        (select distinct p_type as t, {sql_initcap("p_type")} as title from part where p_type <> 'PROMO') m
        on p_type = m.t""",
)
def category_lookup(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    titles = part.filter("p_type <> 'PROMO'").select(
        F.col("p_type").alias("code"), slug_title(F.col("p_type")).alias("title")
    )
    rows = part.select("p_partkey", "p_name", "p_type")
    return joins.replace_by_lookup(rows, titles.distinct(), "p_type", "code", "title")


@bound(
    "group_count_attach",
    "select *, count(*) over (partition by c_nationkey) as customers_in_nation from customer",
)
def group_count_attach(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return joins.attach_group_counts(customer, {"customers_in_nation": ["c_nationkey"]})


@bound(
    "group_count_attach_nulls",
    f"""with s as (select o_orderkey, shipped_at from ({SHIPPED_SQL}))
        select *, count(*) over (partition by shipped_at) as orders_that_day from s""",
)
def group_count_attach_nulls(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_shipped(spark, folder).select("o_orderkey", "shipped_at")
    return joins.attach_group_counts(rows, {"orders_that_day": ["shipped_at"]})


@bound(
    "group_count_attach_inner",
    f"""with s as (select o_orderkey, shipped_at from ({SHIPPED_SQL}))
        select *, count(*) over (partition by shipped_at) as orders_that_day from s
        where shipped_at is not null""",
)
def group_count_attach_inner(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_shipped(spark, folder).select("o_orderkey", "shipped_at")
    return joins.attach_group_counts(rows, {"orders_that_day": ["shipped_at"]}, keep_null_keys=False)


@bound(
    "dedup_then_join",
    """select doc_id, lang, l.quality, l.toxic from documents left join
       (select doc_id, quality, toxic from (select *, row_number() over (partition by doc_id
          order by quality desc, toxic desc) as rn from labels) where rn = 1) l using (doc_id)""",
)
def dedup_then_join(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    labels = dedup.keep_best(table(spark, folder, "labels"), ["doc_id"], [F.col("quality"), F.col("toxic")])
    return documents.join(labels, "doc_id", "left")


@bound(
    "left_join_expand",
    """select o_orderkey, o_custkey, l_linenumber, l_quantity from orders
       left join lineitem on o_orderkey = l_orderkey""",
)
def left_join_expand(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity"
    )
    return orders.join(lines, "o_orderkey", "left")


@bound(
    "dictionary_join",
    """select l_orderkey, l_linenumber, p_brand, o_orderdate,
         case when o_orderkey is not null then 'YES' else 'NO' end as is_final
       from lineitem join part on l_partkey = p_partkey
       left join orders on l_orderkey = o_orderkey and o_orderdate <= l_shipdate and o_orderstatus = 'F'""",
)
def dictionary_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").alias("l")
    part = table(spark, folder, "part").alias("p")
    orders = table(spark, folder, "orders").alias("o")
    on_order = (
        (F.col("l.l_orderkey") == F.col("o.o_orderkey"))
        & (F.col("o.o_orderdate") <= F.col("l.l_shipdate"))
        & (F.col("o.o_orderstatus") == "F")
    )
    joined = lines.join(part, F.col("l.l_partkey") == F.col("p.p_partkey")).join(orders, on_order, "left")
    is_final = F.when(F.col("o_orderkey").isNotNull(), "YES").otherwise("NO").alias("is_final")
    return joined.select("l_orderkey", "l_linenumber", "p_brand", "o_orderdate", is_final)


@bound(
    "fk_violations",
    """select l_orderkey, l_linenumber, l_partkey from lineitem where not exists
       (select 1 from orders where o_orderkey = l_orderkey and o_orderdate >= timestamp '1996-01-01')""",
)
def fk_violations(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    recent = table(spark, folder, "orders").filter(
        F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")
    )
    return joins.orphans(lines, ["l_orderkey"], recent, ["o_orderkey"])


# ---------------------------------------------------------------- aggregates


@bound(
    "distinct_counts",
    """select count(distinct o_custkey) as customers, count(distinct o_orderpriority) as priorities,
       count(distinct o_orderdate) as days from orders""",
)
def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").agg(
        F.count_distinct("o_custkey").alias("customers"),
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.count_distinct("o_orderdate").alias("days"),
    )


@bound(
    "group_count",
    "select l_returnflag, l_linestatus, count(*) as row_count from lineitem group by 1, 2",
)
def group_count(spark: SparkSession, folder: str) -> DataFrame:
    groups = table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return groups.agg(F.count(F.lit(1)).alias("row_count"))


@bound(
    "duplicate_keys",
    """select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1""",
)
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.duplicate_groups(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@bound(
    "duplicate_rows",
    "select text, lang, count(*) as copies from documents group by 1, 2 having count(*) > 1",
)
def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.duplicate_groups(table(spark, folder, "documents").select("text", "lang"))


_NULL_COLUMNS = ("o_orderkey", "o_custkey", "shipped_at")


@bound(
    "null_profile",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) filter (where {c} is null) as null_count,
            {sql_pct(f"count(*) filter (where {c} is null)", "count(*)")} as null_pct from ({SHIPPED_SQL})"""
        for c in _NULL_COLUMNS
    ),
)
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return report.null_profile(_orders_shipped(spark, folder).select(*_NULL_COLUMNS))


_NAN_SQL = """select event_id, case when event_type = 'error' then 'nan'::double
    when event_type = 'view' then null else value end as value from events"""


@bound(
    "null_nan_profile",
    f"""select 'event_id' as column_name, 0::BIGINT as null_count, 0.0::double as null_pct
        union all select 'value', count(*) filter (where value is null or isnan(value)),
        {sql_pct("count(*) filter (where value is null or isnan(value))", "count(*)")} from ({_NAN_SQL})""",
)
def null_nan_profile(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    holed = F.when(kind == "error", F.lit(float("nan"))).when(kind != "view", F.col("value"))
    rows = table(spark, folder, "events").select("event_id", holed.alias("value"))
    return report.null_profile(rows, nan_is_null=True)


@bound(
    "value_distribution",
    f"""with g as (select event_type, count(*) as row_count from events group by 1)
        select *, {sql_pct("row_count", "(select count(*) from events)")} as pct from g""",
)
def value_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return report.value_distribution(table(spark, folder, "events"), ["event_type"])


@bound(
    "percent_formats",
    f"""with g as (select c_mktsegment, count(*) as n, (select count(*) from customer) as t
          from customer group by 1)
        select c_mktsegment, {sql_pct("n", "t")} as pct,
          format('{{:,.2f}}', {sql_pct("n", "t")}) as pct_text,
          ({sql_pct("n", "t")})::decimal(10,2)::double as pct_decimal from g""",
)
def percent_formats(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    total, n = counts.agg(F.sum("n")).scalar(), F.col("n")
    shares = with_scalar(
        counts,
        total,
        lambda t: {
            "pct": percent(n, t),
            "pct_text": percent_text(n, t),
            "pct_decimal": percent_decimal(n, t).cast("double"),
        },
    )
    return shares.drop("n")


@bound(
    "market_share",
    f"""with g as (select n_name, n_regionkey, count(*) as members, round(avg(c_acctbal)::decimal(38,12), 2)::double as avg_c_acctbal
          from customer join nation on c_nationkey = n_nationkey group by 1, 2)
        select *, {sql_pct("members", "(select count(*) from customer)")} as market_share_pct from g""",
)
def market_share(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    return report.market_share(rows, ["n_name", "n_regionkey"], ["c_acctbal"])


@bound(
    "moments",
    """select count(*) as row_count, round(avg(l_extendedprice)::decimal(38,12), 4)::double as mean_price,
       round(stddev_samp(l_extendedprice)::decimal(38,12), 4)::double as sd_price, min(l_extendedprice) as min_price,
       max(l_extendedprice) as max_price, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship,
       year(max(l_shipdate))::int as last_year from lineitem""",
)
def moments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.avg("l_extendedprice"), 4).alias("mean_price"),
        F.round(F.stddev_samp("l_extendedprice"), 4).alias("sd_price"),
        F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.year(F.max("l_shipdate")).alias("last_year"),
    )


@bound(
    "conditional_rates",
    f"""select sum(case when quality = 1 then 1 else 0 end)::BIGINT as good,
        count(*) filter (where toxic = 1) as toxic_count,
        {sql_pct("count(*) filter (where quality = 1)", "count(*)")} as good_pct,
        {sql_pct("count(*) filter (where toxic = 1)", "count(*)")} as toxic_pct from labels""",
)
def conditional_rates(spark: SparkSession, folder: str) -> DataFrame:
    counted = table(spark, folder, "labels").agg(
        F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.count_if(F.col("toxic") == 1).alias("toxic_count"),
        F.count(F.lit(1)).alias("__n"),
    )
    shares = {f"{name}_pct": percent(F.col(c), F.col("__n")) for name, c in (("good", "good"), ("toxic", "toxic_count"))}
    return counted.withColumns(shares).drop("__n")


@bound(
    "quartiles",
    """select quantile_disc(p_retailprice, 0.25) as q1, quantile_disc(p_retailprice, 0.5) as median,
       quantile_disc(p_retailprice, 0.75) as q3 from part""",
)
def quartiles(spark: SparkSession, folder: str) -> DataFrame:
    shares = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    q = table(spark, folder, "part").agg(F.percentile_approx("p_retailprice", shares, 10_000).alias("q"))
    return q.select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))


_SUMMARY = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


@bound(
    "summary_stats",
    " union all ".join(
        f"""select '{c}' as column_name, count({c}) as value_count, round(avg({c})::decimal(38,12), 4)::double as mean,
            round(stddev_samp({c})::decimal(38,12), 4)::double as stddev, min({c})::double as min_value,
            max({c})::double as max_value from lineitem"""
        for c in _SUMMARY
    ),
)
def summary_stats(spark: SparkSession, folder: str) -> DataFrame:
    summary = report.summary_stats(table(spark, folder, "lineitem"), _SUMMARY)
    return summary.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


_MODE_SQL = """select c_nationkey, c_mktsegment as mode_value from (select *, row_number() over
    (partition by c_nationkey order by n desc, c_mktsegment) as rn from
    (select c_nationkey, c_mktsegment, count(*) as n from customer group by 1, 2)) where rn = 1"""


@bound(
    "group_mode",
    f"""select m.*, g.group_rows from ({_MODE_SQL}) m join
        (select c_nationkey, count(*) as group_rows from customer group by 1) g using (c_nationkey)""",
)
def group_mode(spark: SparkSession, folder: str) -> DataFrame:
    return stats.group_mode(table(spark, folder, "customer"), ["c_nationkey"], "c_mktsegment")


@bound(
    "key_uniqueness",
    """select max(n) as max_copies, count(*) as distinct_keys from
       (select count(*) as n from lineitem group by l_orderkey, l_linenumber)""",
)
def key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return dedup.duplicate_key_report(table(spark, folder, "lineitem"), keys).select("max_copies", "distinct_keys")


@bound(
    "frequent_values",
    """select text, count(*) as frequency, round(avg(quality)::decimal(38,12), 4)::double as avg_measure from documents
       left join labels using (doc_id) where text is not null group by 1 having count(*) > 1
       order by 2 desc, 1 limit 10""",
)
def frequent_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    top = report.frequent_values(rows, "text", "quality", 10)
    return top.withColumn("avg_measure", F.round("avg_measure", 4))


@bound(
    "rows_per_group",
    """select count(*) as row_count, count(distinct c_nationkey) as group_count,
       round(count(*) / count(distinct c_nationkey), 2) as rows_per_group from customer""",
)
def rows_per_group(spark: SparkSession, folder: str) -> DataFrame:
    counted = table(spark, folder, "customer").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("c_nationkey").alias("group_count")
    )
    ratio = F.round(F.try_divide(F.col("row_count"), F.col("group_count")), 2)
    return counted.withColumn("rows_per_group", ratio)


# ---------------------------------------------------------------- windows, sorting, sets


@bound(
    "mode_over_partition",
    f"select c.*, m.mode_value from customer c join ({_MODE_SQL}) m using (c_nationkey)",
)
def mode_over_partition(spark: SparkSession, folder: str) -> DataFrame:
    return stats.attach_mode(table(spark, folder, "customer"), ["c_nationkey"], "c_mktsegment")


@bound(
    "running_count",
    "select o_orderkey, o_orderdate, count(*) over (order by o_orderdate) as row_num from orders",
)
def running_count(spark: SparkSession, folder: str) -> DataFrame:
    return stats.running_count(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@bound("top_k", "select user_id, count(*) as row_count from events group by 1 order by 2 desc, 1 limit 20")
def top_k(spark: SparkSession, folder: str) -> DataFrame:
    return report.top_groups(table(spark, folder, "events"), ["user_id"], 20)


@bound("bottom_k", "select user_id, count(*) as row_count from events group by 1 order by 2, 1 limit 20")
def bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    return report.top_groups(table(spark, folder, "events"), ["user_id"], 20, largest=False)


@bound(
    "top_dissimilar",
    """select p_type, p_brand, levenshtein(p_type, p_brand)::int as distance from
       (select distinct p_type, p_brand from part) where levenshtein(p_type, p_brand) > 6
       order by 3 desc, 1, 2 limit 10""",
)
def top_dissimilar(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "part").select("p_type", "p_brand").distinct()
    far = pairs.withColumn("distance", F.levenshtein("p_type", "p_brand")).filter("distance > 6")
    return far.orderBy(F.desc("distance"), "p_type", "p_brand").limit(10)


@bound("distinct_projection", "select distinct p_brand, p_type from part")
def distinct_projection(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_brand", "p_type").distinct()


@bound("dedup_rows", "select distinct text, lang from documents")
def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("text", "lang").dropDuplicates()


@bound(
    "dedup_by_key",
    """select event_id, ts, user_id, event_type, value, props from (select *, row_number() over
       (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""",
)
def dedup_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_best(table(spark, folder, "events"), ["user_id"], [F.col("ts"), F.col("event_id")])


@bound(
    "except_all",
    "select text, lang from documents except all select distinct text, lang from documents",
)
def except_all(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.removed_copies(table(spark, folder, "documents").select("text", "lang"))


@bound(
    "tagged_union",
    """with parties as (select c_custkey as party_id, c_name as name, 'customer' as kind from customer
         union all select s_suppkey, s_name, 'supplier' from supplier)
       select * from parties""",
)
def tagged_union(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind")
    )
    return customers.unionByName(suppliers)
