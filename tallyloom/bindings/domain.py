"""Retail classifications and repairs bound to the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.bindings.registry import bound, sql_initcap, sql_list, sql_pct, table
from tallyloom.bindings.relational import SHIPPED_SQL, _orders_shipped
from tallyloom.bindings.texts import DIMENSIONS_SQL, dimensions
from tallyloom.functions import dates, text
from tallyloom.functions.ladders import at_least, group_of
from tallyloom.functions.numbers import percent
from tallyloom.operators import classify, joins, report, stats, validate
from tallyloom.operators.scalars import with_scalar
from tallyloom.plans import orders as order_plans
from tallyloom.plans import rules

# ---------------------------------------------------------------- orders

STATUS = {"F": "delivered", "O": "shipped", "P": "canceled"}
STATUS_SQL = "case o_orderstatus when 'F' then 'Delivered' when 'O' then 'Shipped' else 'Canceled' end"

# status and dates as an order table has them; the approval is derived from the order key
RETAIL_ORDERS_SQL = f"""select o_orderkey::varchar as order_id, o_custkey::varchar as customer_id,
    {STATUS_SQL} as raw_status, o_orderdate as bought,
    o_orderdate + to_days((o_orderkey % 40)::int) as approved, shipped_at as delivered,
    o_orderdate + to_days(60) as estimated from ({SHIPPED_SQL})"""

REPAIRED_SQL = f"""select *, case when raw_status = 'Delivered' and delivered is null then 'Shipped'
    when raw_status = 'Canceled' and delivered is not null then 'Delivered' else raw_status end as order_status
    from ({RETAIL_ORDERS_SQL})"""

PERFORMANCE_SQL = """case when delivered is not null then
    case when delivered <= estimated then 'On Time' else 'Delayed' end
    when order_status = 'Canceled' then 'Canceled' else 'In Progress' end"""


def retail_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders table in retail columns. Delivered = last ship date of the order's lines."""
    shipped = _orders_shipped(spark, folder)
    status = group_of(F.col("o_orderstatus"), {name: (code,) for code, name in STATUS.items()}, "canceled")
    bought = F.col("o_orderdate")
    later = F.make_dt_interval(days=(F.col("o_orderkey") % 40).cast("int"))
    return shipped.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        (bought + later).alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.col("shipped_at").alias("order_delivered_customer_date"),
        (bought + F.make_dt_interval(days=F.lit(60))).alias("order_estimated_delivery_date"),
    )


@bound(
    "delivery_performance",
    f"""with g as (select {PERFORMANCE_SQL} as delivery_performance, count(*) as row_count
          from ({REPAIRED_SQL}) group by 1)
        select *, {sql_pct("row_count", "(select count(*) from orders)")} as pct from g""",
)
def delivery_performance(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = order_plans.clean_orders(retail_orders(spark, folder))
    return report.value_distribution(cleaned, ["delivery_performance"])


@bound("status_repair", f"select order_id, order_status from ({REPAIRED_SQL})")
def status_repair(spark: SparkSession, folder: str) -> DataFrame:
    status = classify.repair_status(F.col("order_status"), F.col("order_delivered_customer_date"))
    return retail_orders(spark, folder).select("order_id", status.alias("order_status"))


@bound(
    "order_durations",
    f"""select order_id, date_diff('day', bought, approved)::int as processing_time,
        date_diff('day', approved, delivered)::int as delivery_time,
        date_diff('day', bought, estimated)::int as estimated_delivery_time,
        year(bought)::int as purchase_year, month(bought)::int as purchase_month,
        (dayofweek(bought) + 1)::int as purchase_dayofweek from ({RETAIL_ORDERS_SQL})""",
)
def order_durations(spark: SparkSession, folder: str) -> DataFrame:
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    parts = dates.calendar_parts(bought, "purchase")
    return retail_orders(spark, folder).select(
        "order_id",
        dates.days_between(bought, approved).alias("processing_time"),
        dates.days_between(approved, F.col("order_delivered_customer_date")).alias("delivery_time"),
        dates.days_between(bought, F.col("order_estimated_delivery_date")).alias("estimated_delivery_time"),
        *[column.alias(name) for name, column in parts.items()],
    )


_DURATIONS_SQL = f"""select *, date_diff('day', bought, approved) as p, date_diff('day', approved, delivered) as d
    from ({REPAIRED_SQL})"""


CLEANED_ORDERS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_delivered_customer_date",
    "processing_time",
    "delivery_time",
    "delivery_performance",
    "is_processing_outlier",
    "is_delivery_outlier",
)


@bound(
    "orders_cleaned",
    f"""with t as ({_DURATIONS_SQL}), s as (select avg(p) + 3 * stddev_samp(p) as pl,
          avg(d) + 3 * stddev_samp(d) as dl from t)
        select order_id, customer_id, order_status, delivered as order_delivered_customer_date,
          p::int as processing_time, d::int as delivery_time, {PERFORMANCE_SQL} as delivery_performance,
          coalesce(p > pl, false) as is_processing_outlier, coalesce(d > dl, false) as is_delivery_outlier
        from t, s""",
)
def orders_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return order_plans.clean_orders(retail_orders(spark, folder)).select(*CLEANED_ORDERS)


@bound(
    "sigma_outlier",
    """with t as (select event_id, case event_type when 'view' then null else value end as v from events),
         s as (select avg(v) + 2 * stddev_samp(v) as lim from t)
       select event_id, v as value, coalesce(v > lim, false) as is_outlier from t, s""",
)
def sigma_outlier(spark: SparkSession, folder: str) -> DataFrame:
    value = F.when(F.col("event_type") != "view", F.col("value")).alias("value")
    rows = table(spark, folder, "events").select("event_id", value)
    return stats.flag_upper_outliers(rows, {"value": "is_outlier"}, sigmas=2)


@bound(
    "zscore_flag",
    """with t as (select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_extendedprice >= 1000),
         s as (select avg(l_extendedprice) as m, stddev_samp(l_extendedprice) as sd from t)
       select t.*, round(abs((l_extendedprice - m) / sd), 6) as zscore,
         abs((l_extendedprice - m) / sd) > 1.7 as is_outlier from t, s""",
)
def zscore_flag(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    scored = stats.add_zscore(rows.filter("l_extendedprice >= 1000"), "l_extendedprice", sigmas=1.7)
    return scored.withColumn("zscore", F.round("zscore", 6))


@bound(
    "problem_flag",
    "select l_orderkey, l_linenumber, (l_tax = 0 or l_discount = 0) as is_problematic from lineitem",
)
def problem_flag(spark: SparkSession, folder: str) -> DataFrame:
    is_zero = (F.col("l_tax") == 0) | (F.col("l_discount") == 0)
    flag = F.coalesce(is_zero, F.lit(False)).alias("is_problematic")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", flag)


@bound(
    "payment_clean",
    f"""select o_orderkey::varchar as order_id, 1 as payment_sequential,
        {sql_initcap("o_orderpriority")} as payment_type, (o_custkey % 3)::int as payment_installments,
        round((o_totalprice / 3)::decimal(38,10), 2)::double as payment_value,
        o_custkey % 3 = 0 as is_problematic from orders""",
)
def payment_clean(spark: SparkSession, folder: str) -> DataFrame:
    payments = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.regexp_replace(F.lower("o_orderpriority"), " ", "_").alias("payment_type"),
        (F.col("o_custkey") % 3).alias("payment_installments"),
        (F.col("o_totalprice") / 3).alias("payment_value"),
    )
    return order_plans.clean_payments(payments)


# columns with few values, so that whole rows repeat; prices from -1 and freight from -0.01
ITEMS_SQL = """(select l_suppkey::varchar as order_id, l_linenumber as order_item_id, l_returnflag as product_id,
    l_linestatus as seller_id, date_trunc('year', l_shipdate) as shipping_limit_date,
    l_quantity % 5 - 1 as price, l_tax - 0.01 as freight_value from lineitem)"""


def retail_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_returnflag").alias("product_id"),
        F.col("l_linestatus").alias("seller_id"),
        F.date_trunc("year", "l_shipdate").cast("timestamp_ntz").alias("shipping_limit_date"),
        (F.col("l_quantity") % 5 - 1).alias("price"),
        (F.col("l_tax") - 0.01).alias("freight_value"),
    )


_STAGE_SQL = """case when not (price > 0 and freight_value >= 0) then 'invalid price or freight'
    when not (shipping_limit_date between timestamp '2016-01-01' - interval 20 year and
      timestamp '2018-12-31' - interval 20 year) then 'invalid shipping date' else 'passed' end"""
_FUNNEL_SQL = f"""select stage, sum(n)::BIGINT as row_count from (
      select {_STAGE_SQL} as stage, 1 as n from (select distinct * from {ITEMS_SQL})
      union all select 'duplicate', copies - 1 from
        (select count(*) as copies from {ITEMS_SQL} group by order_id, order_item_id, product_id, seller_id,
           shipping_limit_date, price, freight_value having count(*) > 1)
    ) group by 1"""


def _funnel(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    # the test orders lie twenty years before the retail window
    items = retail_items(spark, folder)
    moved = F.col("shipping_limit_date") + F.make_ym_interval(F.lit(20))
    return order_plans.clean_order_items(items.withColumn("shipping_limit_date", moved))


@bound("validation_funnel", _FUNNEL_SQL)
def validation_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return _funnel(spark, folder)[1]


@bound(
    "order_items_cleaned",
    f"""select order_id, order_item_id, product_id, seller_id,
        shipping_limit_date + interval 20 year as shipping_limit_date, price, freight_value
        from (select distinct * from {ITEMS_SQL}) where {_STAGE_SQL} = 'passed'""",
)
def order_items_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return _funnel(spark, folder)[0]


@bound(
    "retention_summary",
    f"""with r as ({_FUNNEL_SQL}), t as (select sum(row_count)::BIGINT as o,
          (sum(row_count) filter (where stage = 'passed'))::BIGINT as k from r)
        select o as original_rows, k as kept_rows, o - k as removed_rows, {sql_pct("k", "o")} as retention_pct,
          {sql_pct("o - k", "o")} as removal_pct from t""",
)
def retention_summary(spark: SparkSession, folder: str) -> DataFrame:
    return validate.retention(_funnel(spark, folder)[1])


# ---------------------------------------------------------------- votes and lookups


@bound(
    "mode_repair",
    """with m as (select c_nationkey, c_mktsegment as mode_value from (select *, row_number() over
           (partition by c_nationkey order by n desc, c_mktsegment) as rn from
           (select c_nationkey, c_mktsegment, count(*) as n from customer group by 1, 2)) where rn = 1)
       select c.*, case when c_mktsegment <> mode_value and length(c_mktsegment) > 2
         and lower(c_mktsegment) not in ('building', 'household') then mode_value else c_mktsegment end as repaired
       from customer c join m using (c_nationkey)""",
)
def mode_repair(spark: SparkSession, folder: str) -> DataFrame:
    return stats.repair_by_mode(
        table(spark, folder, "customer"), ["c_nationkey"], "c_mktsegment", "repaired", keep=("building", "household")
    )


@bound(
    "prefer_reference",
    """with m as (select o_custkey, o_orderpriority as p from (select *, row_number() over
           (partition by o_custkey order by n desc, o_orderpriority) as rn from
           (select o_custkey, o_orderpriority, count(*) as n from orders group by 1, 2)) where rn = 1)
       select c_custkey, coalesce(p, c_mktsegment) as c_mktsegment from customer left join m on c_custkey = o_custkey""",
)
def prefer_reference(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return joins.prefer_reference(
        customer, table(spark, folder, "orders"), "c_custkey", "c_mktsegment", "o_custkey", "o_orderpriority"
    )


@bound(
    "lookup_text_key",
    """with m as (select o_custkey, o_orderpriority as p from (select *, row_number() over
           (partition by o_custkey order by n desc, o_orderpriority) as rn from
           (select o_custkey, o_orderpriority, count(*) as n from orders group by 1, 2)) where rn = 1)
       select case when c_custkey % 10 = 0 then 'n/a' else lpad(c_custkey::varchar, 8, '0') end as code,
         coalesce(p, c_mktsegment) as c_mktsegment
       from customer left join m on c_custkey = o_custkey and c_custkey % 10 <> 0""",
)
def lookup_text_key(spark: SparkSession, folder: str) -> DataFrame:
    """Padded text codes, some of them no number, looked up among integers."""
    key = F.col("c_custkey")
    code = F.when(key % 10 == 0, "n/a").otherwise(F.lpad(key.cast("string"), 8, "0"))
    rows = table(spark, folder, "customer").select(code.alias("code"), "c_mktsegment")
    return joins.prefer_reference(
        rows, table(spark, folder, "orders"), "code", "c_mktsegment", "o_custkey", "o_orderpriority"
    )


@bound(
    "lookup_integer_key",
    """with m as (select o_custkey, o_orderstatus as s from (select *, row_number() over
           (partition by o_custkey order by n desc, o_orderstatus) as rn from
           (select o_custkey, o_orderstatus, count(*) as n from orders where o_orderkey % 7 <> 0 group by 1, 2))
           where rn = 1)
       select c_custkey, s as status from customer left join m on c_custkey = o_custkey""",
)
def lookup_integer_key(spark: SparkSession, folder: str) -> DataFrame:
    """Integers looked up among text codes, padded in two ways and some of them no number."""
    order, key = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    code = F.when(order % 7 == 0, "abc").when(order % 2 == 0, F.lpad(key, 8, "0")).otherwise(key)
    codes = table(spark, folder, "orders").select(code.alias("code"), "o_orderstatus")
    rows = table(spark, folder, "customer").select("c_custkey", F.col("c_custkey").alias("status"))
    return joins.replace_by_lookup(rows, codes, "status", "code", "o_orderstatus")


def _dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Two-word part names and their title-cased form, as far as the first letter is below `o`."""
    names = table(spark, folder, "part").filter("p_name < 'o'").select(F.col("p_name").alias("source_text"))
    return names.distinct().withColumn("translated_text", text.capitalise_words(F.col("source_text")))


@bound(
    "dictionary_translate",
    f"""select p_partkey, p_name, case when p_name < 'o' then {sql_initcap("p_name")} else p_name end as translated
        from part""",
)
def dictionary_translate(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", "p_name")
    return joins.translate_by_dictionary(
        rows, _dictionary(spark, folder), "p_name", "source_text", "translated_text", "translated"
    )


@bound(
    "translate_ambiguous",
    """select p_partkey, case when p_partkey % 4 <> 0 then null when p_partkey % 8 = 0 then '  ' else p_name end
         as name, case when p_partkey % 4 <> 0 then null when p_partkey % 8 = 0 then '  '
         when p_name < 'o' then upper(p_name) else p_name end as translated from part""",
)
def translate_ambiguous(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with several translations, most rows without a text: one row stays one row."""
    key = F.col("p_partkey")
    name = F.when(key % 8 == 0, "  ").when(key % 4 == 0, F.col("p_name"))
    rows = table(spark, folder, "part").select("p_partkey", name.alias("name"))
    source = F.col("p_name")
    names = table(spark, folder, "part").filter("p_name < 'o'").select("p_name").distinct()
    # the form given twice wins over the smaller one; entries for blank and null texts are not used
    forms = F.explode(F.array(F.upper(source), F.upper(source), F.lit("!")))
    dictionary = names.select(source.alias("source_text"), forms.alias("translated_text"))
    odd = spark.range(1).select(F.explode(F.array(F.lit("  "), F.lit(None))).alias("source_text"), F.lit("odd").alias("translated_text"))
    return joins.translate_by_dictionary(
        rows, dictionary.unionByName(odd), "name", "source_text", "translated_text", "translated"
    )


@bound("untranslated_texts", "select distinct p_name from part where not p_name < 'o'")
def untranslated_texts(spark: SparkSession, folder: str) -> DataFrame:
    return joins.untranslated(
        table(spark, folder, "part"), _dictionary(spark, folder), "p_name", "source_text"
    )


@bound(
    "coverage_stats",
    f"""select count(*) as total_rows, count(*) filter (where p_name < 'o') as translated_rows,
        {sql_pct("count(*) filter (where p_name < 'o')", "count(*)")} as translated_pct from part""",
)
def coverage_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", "p_name")
    found = joins.replace_by_lookup(
        rows, _dictionary(spark, folder), "p_name", "source_text", "translated_text"
    ).withColumnRenamed("p_name", "translated")
    return report.coverage(found, ["translated"])


# ---------------------------------------------------------------- tiers and classes


@bound(
    "quantile_tiers",
    """with q as (select quantile_disc(p_retailprice, 0.25) as q1, quantile_disc(p_retailprice, 0.5) as q2,
         quantile_disc(p_retailprice, 0.75) as q3 from part),
       t as (select p_partkey, case when p_type = 'PROMO' then null else p_retailprice - 890 end as v from part),
       tq as (select quantile_disc(v, 0.25) as q1, quantile_disc(v, 0.5) as q2, quantile_disc(v, 0.75) as q3 from t)
       select p_partkey, case when v <= q1 / 2 then 'Extra Small' when v <= q1 then 'Small'
         when v <= q2 then 'Medium Small' when v <= q3 then 'Medium Large' when v <= q3 * 2 then 'Large'
         else 'Extra Large' end as tier from t, tq""",
)
def quantile_tiers(spark: SparkSession, folder: str) -> DataFrame:
    value = F.when(F.col("p_type") != "PROMO", F.col("p_retailprice") - 890)
    rows = table(spark, folder, "part").select("p_partkey", value.alias("v"))
    q = stats.quartiles(rows, ["v"])
    tiers = with_scalar(rows, q, lambda q: {"tier": stats.volume_tier(F.col("v"), q["v"])})
    return tiers.select("p_partkey", "tier")


@bound(
    "weight_category",
    f"""with q as (select quantile_disc(wt, 0.25) as q1, quantile_disc(wt, 0.5) as q2, quantile_disc(wt, 0.75) as q3
          from {DIMENSIONS_SQL})
        select p_partkey, case when wt <= 920 then 'Ultra Light' when wt <= q1 then 'Light'
          when wt <= q2 then 'Medium Light' when wt <= q3 then 'Medium Heavy' when wt <= q3 * 2 then 'Heavy'
          else 'Extra Heavy' end as category from {DIMENSIONS_SQL}, q""",
)
def weight_category(spark: SparkSession, folder: str) -> DataFrame:
    rows = dimensions(spark, folder)
    q = stats.quartiles(rows, ["wt"])
    tiers = with_scalar(rows, q, lambda q: {"category": stats.weight_category(F.col("wt"), q["wt"], 920)})
    return tiers.select("p_partkey", "category")


_QUARTERS_SQL = f"""(select {", ".join(f"quantile_disc({c}, {s}) as {n}{i}"
    for c, n in (("dsc", "d"), ("vol", "v"), ("wt", "w")) for i, s in ((1, 0.25), (2, 0.5), (3, 0.75)))}
    from (select *, len * hei * wid as vol from {DIMENSIONS_SQL}))"""


@bound(
    "complexity_class",
    f"""select p_partkey, case when dsc > d3 and pho > 2 and vol > v3 and wt > w3 then 'Very High'
          when dsc > d2 and pho > 1 and vol > v2 then 'High'
          when dsc < d1 and pho = 1 and vol < v1 and wt < w1 then 'Low'
          when dsc < d2 and pho <= 2 and vol < v2 then 'Medium Low' else 'Medium' end as complexity
        from (select *, len * hei * wid as vol from {DIMENSIONS_SQL}), {_QUARTERS_SQL}""",
)
def complexity_class(spark: SparkSession, folder: str) -> DataFrame:
    rows = dimensions(spark, folder).withColumn("vol", F.col("len") * F.col("hei") * F.col("wid"))
    q = stats.quartiles(rows, ["dsc", "vol", "wt"])
    measures = [F.col(c) for c in ("dsc", "pho", "vol", "wt")]
    levels = with_scalar(
        rows, q, lambda q: {"complexity": classify.product_complexity(*measures, q["dsc"], q["vol"], q["wt"])}
    )
    return levels.select("p_partkey", "complexity")


@bound(
    "shipping_class",
    f"""select p_partkey, case when wt > w3 or vol > v3 or len > 45 or hei > 45 or wid > 45 then 'Complex'
          when wt <= w1 and vol <= v1 then 'Simple' else 'Standard' end as shipping
        from (select *, len * hei * wid as vol from {DIMENSIONS_SQL}), {_QUARTERS_SQL}""",
)
def shipping_class(spark: SparkSession, folder: str) -> DataFrame:
    rows = dimensions(spark, folder).withColumn("vol", F.col("len") * F.col("hei") * F.col("wid"))
    q = stats.quartiles(rows, ["vol", "wt"])
    sides = [F.col(c) for c in ("len", "hei", "wid")]
    wt, vol = F.col("wt"), F.col("vol")
    levels = with_scalar(
        rows, q, lambda q: {"shipping": classify.shipping_complexity(wt, vol, sides, q["wt"], q["vol"], 45)}
    )
    return levels.select("p_partkey", "shipping")


_TYPE_GROUPS = {"Basic": ("standard", "economy"), "Sized": ("small", "medium", "large")}


@bound(
    "category_group",
    """select p_partkey, case when lower(p_type) in ('standard', 'economy') then 'Basic'
       when lower(p_type) in ('small', 'medium', 'large') then 'Sized' else 'Other' end as category_group from part""",
)
def category_group(spark: SparkSession, folder: str) -> DataFrame:
    group = group_of(F.lower("p_type"), _TYPE_GROUPS, "Other")
    return table(spark, folder, "part").select("p_partkey", group.alias("category_group"))


@bound(
    "state_market_share",
    f"""select s_suppkey, n_name, suppliers_in_nation,
        {sql_pct("suppliers_in_nation", "(select count(*) from supplier)")} as market_share from
        (select *, count(*) over (partition by n_name) as suppliers_in_nation from supplier
         join nation on s_nationkey = n_nationkey)""",
)
def state_market_share(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    total = supplier.agg(F.count(F.lit(1))).scalar()
    placed = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select("s_suppkey", "n_name")
    counted = joins.attach_group_counts(placed, {"suppliers_in_nation": ["n_name"]})
    return with_scalar(
        counted, total, lambda t: {"market_share": percent(F.col("suppliers_in_nation"), t)}
    )


_NATION_GROUPS = {
    "North": tuple(f"NATION_{i}" for i in range(5)),
    "South": tuple(f"NATION_{i}" for i in range(5, 15)),
}


@bound(
    "region_map",
    f"""select c_custkey, case when n_name in ({sql_list(_NATION_GROUPS["North"])}) then 'North'
        when n_name in ({sql_list(_NATION_GROUPS["South"])}) then 'South' else 'Unknown' end as area,
        case r_name when 'ASIA' then 'East' when 'AFRICA' then 'Mid' else 'Other' end as market
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
)
def region_map(spark: SparkSession, folder: str) -> DataFrame:
    return _customers_placed(spark, folder).select(
        "c_custkey",
        group_of(F.col("n_name"), _NATION_GROUPS, "Unknown").alias("area"),
        group_of(F.col("r_name"), {"East": ("ASIA",), "Mid": ("AFRICA",)}, "Other").alias("market"),
    )


def _customers_placed(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation, region = (table(spark, folder, n) for n in ("customer", "nation", "region"))
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    )


@bound(
    "size_class",
    """select o_orderkey, orders_of_customer, case when orders_of_customer >= 20 then 'Major'
         when orders_of_customer >= 15 then 'Large' when orders_of_customer >= 10 then 'Medium'
         else 'Small' end as size_class
       from (select o_orderkey, count(*) over (partition by o_custkey) as orders_of_customer from orders)""",
)
def size_class(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    counted = joins.attach_group_counts(rows, {"orders_of_customer": ["o_custkey"]})
    steps = ((20, "Major"), (15, "Large"), (10, "Medium"))
    size = at_least(F.col("orders_of_customer"), steps, "Small")
    return counted.select("o_orderkey", "orders_of_customer", size.alias("size_class"))


@bound(
    "derived_class_matrix",
    f"""with c as (select c_custkey, n_name, count(*) over (partition by n_name) as members,
          case when r_name = 'ASIA' then 'Metro' else 'Other' end as metro
          from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
        d as (select *, case when members >= 65 then 'High' when members >= 58 then 'Medium' else 'Low' end as density,
          case when metro <> 'Other' then 'Core Market' when n_name in ({sql_list(_NATION_GROUPS["North"])})
            then 'Near Market' else 'Remote Market' end as proximity from c)
        select c_custkey, density, proximity, case when proximity = 'Core Market' and density = 'High'
          then 'High Growth' when proximity = 'Near Market' and density in ('High', 'Medium')
          then 'Medium Growth' else 'Stable' end as potential from d""",
)
def derived_class_matrix(spark: SparkSession, folder: str) -> DataFrame:
    placed = _customers_placed(spark, folder).select("c_custkey", "n_name", "r_name")
    counted = joins.attach_group_counts(placed, {"members": ["n_name"]})
    metro = group_of(F.col("r_name"), {"Metro": ("ASIA",)}, "Other")
    density = at_least(F.col("members"), ((65, "High"), (58, "Medium")), "Low")
    proximity = classify.market_proximity(metro, F.col("n_name"), _NATION_GROUPS["North"])
    potential = classify.business_potential(proximity, density)
    return counted.select(
        "c_custkey", density.alias("density"), proximity.alias("proximity"), potential.alias("potential")
    )


@bound(
    "coordinate_check",
    """select vec_id, lat between -90 and 90 and lng between -180 and 180 and lat <> 0 and lng <> 0 as is_valid
       from (select vec_id, case when vec_id % 50 = 0 then 0 else embedding[1]::double * 800 end as lat,
         embedding[2]::double * 1500 as lng from embeddings)""",
)
def coordinate_check(spark: SparkSession, folder: str) -> DataFrame:
    lat = F.when(F.col("vec_id") % 50 == 0, F.lit(0.0)).otherwise(F.col("embedding")[0].cast("double") * 800)
    lng = F.col("embedding")[1].cast("double") * 1500
    valid = classify.valid_coordinates(lat, lng)
    return table(spark, folder, "embeddings").select("vec_id", valid.alias("is_valid"))
