"""Tables that grow and copies that drift: differences, merged profiles, footers, landing without repeats, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.bindings.registry import bound, sql_pct, table
from tallyloom.operators import differences, profiles, stats, validate
from tallyloom.operators.validate import Relation
from tallyloom.session import scratch_path
from tallyloom.sources import catalog, footers, publish, versions
from tallyloom.streaming.unique import land_unique, read_landed

_SPOILED_SQL = """select o_orderkey, o_custkey, o_orderstatus,
    case when o_orderkey % 991 = 1 then o_totalprice + 1 else o_totalprice end as o_totalprice, o_orderdate,
    case when o_orderkey % 1982 = 1 then null else o_orderpriority end as o_orderpriority
  from orders where o_orderkey % 997 <> 0"""


def _spoiled(spark: SparkSession, folder: str) -> DataFrame:
    """A stored copy of orders with rows lost, added and repeated and values changed."""
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    changed = orders.where(key % 997 != 0).withColumns(
        {
            "o_totalprice": F.when(key % 991 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderpriority": F.when(key % 1982 != 1, F.col("o_orderpriority")),
        }
    )
    added = orders.where(key % 1500 == 3).withColumn("o_orderkey", -key)
    path = scratch_path(spark, "spoiled-orders")
    publish.publish(changed.unionByName(added).unionByName(changed.where(key % 1400 == 5)), path)
    return spark.read.parquet(path)


@bound(
    "row_differences",
    f"""with c as ({_SPOILED_SQL} union all select -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
           from orders where o_orderkey % 1500 = 3
         union all select * from ({_SPOILED_SQL}) where o_orderkey % 1400 = 5),
       s as (select o_orderkey, count(*) as n, any_value(o_totalprice) as t, any_value(o_orderpriority) as p from orders group by 1),
       k as (select o_orderkey, count(*) as n, any_value(o_totalprice) as t, any_value(o_orderpriority) as p from c group by 1)
       select coalesce(s.o_orderkey, k.o_orderkey) as o_orderkey, coalesce(s.n, 0) as source_rows, coalesce(k.n, 0) as copy_rows,
         case when k.n is null then 'missing in copy' when s.n is null then 'missing in source' when k.n = 1 then 'changed'
           else 'rows differ' end as status,
         case when s.n = 1 and k.n = 1 then array_to_string(list_filter([case when s.t is distinct from k.t then 'o_totalprice' end,
           case when s.p is distinct from k.p then 'o_orderpriority' end], lambda x: x is not null), ',') end as changed_columns
       from s full join k on s.o_orderkey = k.o_orderkey
       where s.n is distinct from k.n or s.t is distinct from k.t or s.p is distinct from k.p""",
)
def row_differences(spark: SparkSession, folder: str) -> DataFrame:
    """The keys in which a spoiled copy differs, found by descending a tree of checksums."""
    found = differences.row_differences(table(spark, folder, "orders"), _spoiled(spark, folder), ["o_orderkey"])
    return found.withColumn("changed_columns", F.array_join("changed_columns", ","))


_PROFILED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderpriority": "string"}


def _sql_merged(column: str, kind: str) -> str:
    numeric = kind in ("bigint", "double")
    mean = f"round(avg({column})::decimal(38,12), 4)::double" if numeric else "null::double"
    sd = f"round(stddev_samp({column})::decimal(38,12), 4)::double" if numeric else "null::double"
    ends = f"min({column})::varchar as min_value, max({column})::varchar as max_value"
    return f"""select '{column}' as column_name, '{kind}' as data_type, count(*) as row_count, count(*) - count({column}) as null_count,
        {ends}, {mean} as mean, {sd} as stddev, {sql_pct(f"count(*) - count({column})", "count(*)")} as null_pct
        from (select * replace (nullif(o_orderstatus, 'P') as o_orderstatus) from orders)"""


@bound("merged_profile", " union all ".join(_sql_merged(c, k) for c, k in _PROFILED.items()))
def merged_profile(spark: SparkSession, folder: str) -> DataFrame:
    """A profile of three landings from their stored figures, without reading the landed rows again."""
    orders = table(spark, folder, "orders").select(*_PROFILED)
    orders = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    path = scratch_path(spark, "profiles")
    for part in range(3):
        profiles.store_part(orders.where(F.col("o_custkey") % 3 == part), f"part-{part}", path)
    profiles.store_part(orders.where("o_custkey % 3 = 1"), "part-1", path)  # landed again: replaced, not counted twice
    merged = profiles.merged_profile(profiles.stored_profiles(spark, path)).drop("position", "distinct_estimate")
    return merged.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@bound(
    "grown_outliers",
    """with s as (select avg(value) as m, stddev_samp(value) as sd from events)
       select event_id, coalesce(value > m + 2 * sd, false) as is_outlier, round(abs((value - m) / sd), 6) as zscore from events, s""",
)
def grown_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Outliers by the figures of three landings, merged from what was kept of each."""
    events = table(spark, folder, "events").select("event_id", "value")
    path = scratch_path(spark, "landed-figures")
    for part in range(3):
        profiles.store_part(events.where(F.col("event_id") % 3 == part), f"day-{part}", path)
    figures = profiles.grown_figures(profiles.stored_profiles(spark, path), ["value"])
    flagged = stats.flag_upper_outliers(events, {"value": "is_outlier"}, sigmas=2, figures=figures)
    return flagged.select("event_id", "is_outlier", F.round(figures.zscore("value"), 6).alias("zscore"))


@bound(
    "footer_figures",
    """select count(*) as row_count, min(l_orderkey) as min_l_orderkey, max(l_orderkey) as max_l_orderkey, min(l_quantity) as min_l_quantity,
       max(l_quantity) as max_l_quantity, min(l_linenumber) as min_l_linenumber, max(l_linenumber) as max_l_linenumber from lineitem""",
)
def footer_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and extremes of a table from its footers."""
    return footers.footer_figures(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_linenumber"])


@bound(
    "footer_counts",
    """select name as table_name, n as raw_rows, kept as ready_rows, case when n = kept then 'match' else 'mismatch' end as status
       from (select 'customer' as name, count(*) as n, count(*) as kept from customer
         union all select 'orders', count(*), count(*) filter (where o_orderstatus <> 'P') from orders)""",
)
def footer_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw and ready rows of two tables, one of which lost rows, from footers only."""
    zone = scratch_path(spark, "zone")
    for name in ("customer", "orders"):
        raw = table(spark, folder, name)
        publish.publish(raw.filter("o_orderstatus <> 'P'") if name == "orders" else raw, f"{zone}/{name}.parquet")
    places = {"raw": folder, "ready": zone}
    return footers.footer_counts(spark, {p: {n: f"{root}/{n}.parquet" for n in ("customer", "orders")} for p, root in places.items()})


@bound("land_unique", "select * from events")
def land_unique_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose files overlap and arrive twice, some of them late, landed once each."""
    events = table(spark, folder, "events")
    root = scratch_path(spark, "unique")
    key = F.col("event_id")
    # the second arrival overlaps the first, the third brings old events again
    for arrived in (events.where(key % 3 <= 1), events.where(key % 3 >= 1), events.where((key % 3 != 2) & (key % 5 == 0))):
        arrived.repartition(3).write.mode("append").parquet(f"{root}/inbox")
        land_unique(
            spark, f"{root}/inbox", events.schema, f"{root}/landed", f"{root}/progress", ["event_id"], event_time="ts", buckets=4, files_per_batch=2
        )
    return read_landed(spark, f"{root}/landed")


@bound(
    "version_publish",
    """select 'published' as reader, count(*) as row_count, sum(o_custkey)::bigint as checksum, 3 as versions from orders
       union all select 'kept', count(*) filter (where o_orderstatus <> 'P'), sum(o_custkey) filter (where o_orderstatus <> 'P')::bigint, 3
       from orders""",
)
def version_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Four versions published one after the other; a reader of the third goes on while the fourth is published."""
    orders, root = table(spark, folder, "orders"), scratch_path(spark, "versions")
    for state in ("F", "O"):
        versions.publish_version(orders.where(F.col("o_orderstatus") == state), "vw_orders_versioned", root)
    versions.publish_version(orders.where("o_orderstatus <> 'P'"), "vw_orders_versioned", root)
    held = spark.table("vw_orders_versioned")
    versions.publish_version(orders, "vw_orders_versioned", root)
    kept = len(versions.versions(spark, root))

    def read(rows: DataFrame, reader: str) -> DataFrame:
        figures = rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_custkey").alias("checksum"))
        return figures.select(F.lit(reader).alias("reader"), "*", F.lit(kept).alias("versions"))

    return read(spark.table("vw_orders_versioned"), "published").unionByName(read(held, "kept"))


@bound(
    "bucketed_fk_audit",
    """select 'lines without order' as relation, count(*) as child_rows, count(*) filter (where l_orderkey not in
         (select o_orderkey from orders where o_orderstatus <> 'P')) as orphan_rows from lineitem""",
)
def bucketed_fk_audit(spark: SparkSession, folder: str) -> DataFrame:
    """A foreign key audited between tables stored by key: neither is exchanged, and buckets grow in number, not in size."""
    root = scratch_path(spark, "bucketed")
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    buckets = catalog.bucket_count([lines, orders], 8)
    lines = catalog.create_bucketed_table(lines, "lines_by_order", f"{root}/lines", ["l_orderkey"], buckets)
    orders = catalog.create_bucketed_table(orders, "orders_by_key", f"{root}/orders", ["o_orderkey"], buckets)
    kept = orders.where("o_orderstatus <> 'P'")
    return validate.foreign_key_audit([Relation("lines without order", lines, ["l_orderkey"], kept, ["o_orderkey"])])
