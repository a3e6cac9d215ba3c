"""Sources, sinks, publication and incremental landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampNTZType

from tallyloom.bindings.registry import bound, table
from tallyloom.operators import dedup, reconcile
from tallyloom.plans import refresh
from tallyloom.plans import schema as retail_schema
from tallyloom.session import scratch_path
from tallyloom.sources import catalog, publish, readers
from tallyloom.streaming.incremental import land_new_files


def _write_csv(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    publish.write_rejects(df, path, as_csv=True)
    return path


@bound("csv_roundtrip", "select * from customer")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return readers.read_csv(spark, _write_csv(customer, "csv"), customer.schema)


@bound(
    "csv_multiline",
    "select conv_id, turn, role, text from conversations",
)
def csv_multiline(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return readers.read_csv(spark, _write_csv(rows, "text-csv"), rows.schema, multi_line=True)


@bound(
    "csv_inferred",
    "select l_returnflag, count(*) as row_count, sum(l_linenumber)::BIGINT as line_numbers, "
    "sum(l_quantity::DECIMAL(18,2))::DOUBLE as quantity from lineitem group by l_returnflag",
)
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    rows = readers.read_csv(spark, _write_csv(table(spark, folder, "lineitem"), "infer-csv"), infer=True)
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("l_linenumber").alias("line_numbers"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
    )


@bound(
    "csv_schema_load",
    """select o_orderkey, case when o_orderpriority = '5-LOW' then 'rejected' else 'loaded' end as outcome
       from orders""",
)
def csv_schema_load(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    # low priority orders carry a total that is no number
    spoiled = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    raw = orders.select("o_orderkey", "o_custkey", spoiled.alias("o_totalprice"), "o_orderdate")
    schema = StructType(
        [
            StructField("o_orderkey", LongType()),
            StructField("o_custkey", LongType()),
            StructField("o_totalprice", DoubleType()),
            StructField("o_orderdate", TimestampNTZType()),
        ]
    )
    good, bad = readers.load_with_schema(spark, _write_csv(raw, "schema-csv"), schema)
    loaded = good.select("o_orderkey", F.lit("loaded").alias("outcome"))
    return loaded.unionByName(bad.select(F.col("o_orderkey").cast("bigint"), F.lit("rejected").alias("outcome")))


@bound(
    "published_count",
    "select count(*) as row_count, count(distinct l_returnflag) as categories from lineitem",
)
def published_count(spark: SparkSession, folder: str) -> DataFrame:
    catalog.publish_view(spark, "published_lineitem", f"{folder}/lineitem.parquet")
    return catalog.query_published(
        spark,
        "select count(*) as row_count, count(distinct l_returnflag) as categories from published_lineitem",
    )


@bound(
    "sink_verify",
    """select 'orders' as table_name, count(*) as source_rows, count(*) as copy_rows,
       0::BIGINT as row_gap, 'match' as status from orders""",
)
def sink_verify(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    path = scratch_path(spark, "orders")
    publish.publish(orders, path)
    publish.publish(orders, path, compact=True)  # replaces the first version
    return reconcile.count_reconcile(orders, spark.read.parquet(path), "orders")


@bound(
    "partitioned_sink",
    "select event_type, count(*) as row_count, min(event_id) as first_id, max(event_id) as last_id "
    "from events group by event_type",
)
def partitioned_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "events-by-type")
    publish.publish(table(spark, folder, "events"), path, partition_by=["event_type"])
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


@bound(
    "duplicate_audit",
    "select text, lang, count(*) as copies from documents group by text, lang having count(*) > 1",
)
def duplicate_audit(spark: SparkSession, folder: str) -> DataFrame:
    repeated = dedup.duplicate_groups(table(spark, folder, "documents").select("text", "lang"))
    return readers.read_csv(spark, _write_csv(repeated, "audit"), repeated.schema, multi_line=True)


@bound(
    "land_and_verify",
    """select 'customer' as table_name, count(*) as source_rows, count(*) as copy_rows,
       0::BIGINT as row_gap, 'match' as status from customer
       union all
       select 'orders', count(*), count(*), 0, 'match' from orders""",
)
def land_and_verify(spark: SparkSession, folder: str) -> DataFrame:
    zone = scratch_path(spark, "zone")
    sources = {name: table(spark, folder, name) for name in ("customer", "orders")}
    raw = [publish.RawTable(n, _write_csv(df, f"raw-{n}"), df.schema) for n, df in sources.items()]
    publish.land(spark, raw, zone)
    reports = [reconcile.count_reconcile(df, table(spark, zone, n), n) for n, df in sources.items()]
    return reports[0].unionByName(reports[1])


@bound(
    "land_with_rejects",
    """select 'orders' as table_name, count(*) as source_rows, count(*) filter (where o_orderpriority <> '5-LOW')
         as landed_rows, count(*) filter (where o_orderpriority = '5-LOW') as rejected_rows, count(*) filter
         (where o_orderpriority = '5-LOW') as kept_rejects, true as adds_up from orders""",
)
def land_with_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """A source with values that are no numbers: they are set apart and counted, none is lost."""
    orders = table(spark, folder, "orders")
    spoiled = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    raw = _write_csv(orders.select("o_orderkey", spoiled.alias("o_totalprice"), "o_orderdate"), "spoiled")
    zone = scratch_path(spark, "zone")
    schema = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
    landed = publish.land(spark, [publish.RawTable("orders", raw, schema)], zone)[0]
    rejects = spark.read.parquet(f"{zone}/orders_rejects")
    counts = orders.agg(F.count(F.lit(1)).alias("source_rows"))
    return counts.select(
        F.lit("orders").alias("table_name"),
        "source_rows",
        table(spark, zone, "orders").agg(F.count(F.lit(1))).scalar().alias("landed_rows"),
        F.lit(landed.rows_rejected).cast("bigint").alias("rejected_rows"),
        rejects.agg(F.count(F.lit(1))).scalar().alias("kept_rejects"),
        (F.col("source_rows") == F.lit(landed.rows_written + landed.rows_rejected)).alias("adds_up"),
    )


@bound(
    "partitioned_sink_files",
    "select count(distinct event_type) as event_types, count(distinct event_type) as files from events",
)
def partitioned_sink_files(spark: SparkSession, folder: str) -> DataFrame:
    """A value's rows come together before the write: one file for each, not one for each task and value."""
    events = table(spark, folder, "events")
    path = scratch_path(spark, "events-by-type")
    done = publish.publish(events.repartition(6), path, partition_by=["event_type"])
    kinds = spark.read.parquet(path).agg(F.count_distinct("event_type").alias("event_types"))
    return kinds.select("event_types", F.lit(done.files).cast("bigint").alias("files"))


@bound(
    "zone_report",
    """select name as table_name, n as raw_rows, case when name = 'orders' then kept else n end as ready_rows,
         case when name = 'orders' then kept else n end as view_rows,
         case when name = 'orders' then kept else n end as stored_rows,
         case when name = 'orders' and kept <> n then 'mismatch' else 'match' end as status
       from (select 'customer' as name, count(*) as n, 0 as kept from customer
         union all select 'part', count(*), 0 from part
         union all select 'orders', count(*), count(*) filter (where o_orderstatus <> 'P') from orders)""",
)
def zone_report(spark: SparkSession, folder: str) -> DataFrame:
    """Raw, ready, view and stored rows of several tables, one of which lost rows on the way."""
    zone = scratch_path(spark, "zone")
    names = ("customer", "part", "orders")
    for name in names:
        raw = table(spark, folder, name)
        publish.publish(raw.filter("o_orderstatus <> 'P'") if name == "orders" else raw, f"{zone}/{name}.parquet")
    published = refresh.publish_names(spark, zone, list(names), scratch_path(spark, "stored"))
    places = {
        "raw": {name: table(spark, folder, name) for name in names},
        "ready": {name: table(spark, zone, name) for name in names},
        "view": {name: published[f"vw_{name}"] for name in names},
        "stored": {name: published[f"ext_{name}"] for name in names},
    }
    return reconcile.zone_counts(places)


@bound(
    "declared_not_null",
    """with c as (select count(*) as n, count(*) filter (where c_custkey % 5 = 0) as z,
           count(*) filter (where c_custkey % 7 = 0) as u from customer),
         p as (select count(*) as n, count(*) filter (where o_orderkey % 3 = 0) as v,
           count(*) filter (where o_orderstatus = 'P') as k from orders)
       select 'customers' as table_name, unnest(['customer_unique_id_not_null', 'customer_zip_code_prefix_not_null',
           'customer_city_not_null', 'customer_state_not_null']) as rule, unnest([u, z, 0, 0]) as violations,
         n as row_count from c
       union all select 'order_payments', unnest(['payment_type_not_null', 'payment_installments_not_null',
           'payment_value_not_null', 'valid_payment_type']), unnest([k, 0, v, 0]), n from p""",
)
def declared_not_null(spark: SparkSession, folder: str) -> DataFrame:
    """The declared constraints over retail tables with holes in columns that must be filled."""
    key, order = F.col("c_custkey"), F.col("o_orderkey")
    customers = table(spark, folder, "customer").select(
        key.cast("string").alias("customer_id"),
        F.when(key % 7 != 0, F.col("c_name")).alias("customer_unique_id"),
        F.when(key % 5 != 0, key.cast("int")).alias("customer_zip_code_prefix"),
        F.lit("rio").alias("customer_city"),
        F.lit("RJ").alias("customer_state"),
    )
    payments = table(spark, folder, "orders").select(
        order.cast("string").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.when(F.col("o_orderstatus") != "P", "boleto").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.when(order % 3 != 0, F.col("o_totalprice")).alias("payment_value"),
    )
    return retail_schema.audit({"customers": customers, "order_payments": payments})["constraints"]


@bound("incremental_land", "select * from events")
def incremental_land(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    root = scratch_path(spark, "incremental")
    inbox, target, checkpoint = f"{root}/inbox", f"{root}/landed", f"{root}/progress"
    later = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for arrived in (events.filter(~later), events.filter(later)):
        arrived.repartition(4).write.mode("append").parquet(inbox)
        land_new_files(spark, inbox, events.schema, target, checkpoint, files_per_batch=3)
    return spark.read.parquet(target)


@bound("view_over_parquet", "select * from customer")
def view_over_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.publish_view(spark, "vw_customer", f"{folder}/customer.parquet")


@bound("ctas_external", "select * from part")
def ctas_external(spark: SparkSession, folder: str) -> DataFrame:
    catalog.publish_view(spark, "vw_part", f"{folder}/part.parquet")
    return catalog.create_external_table(spark, "ext_part", "vw_part", scratch_path(spark, "ext-part"))


@bound(
    "view_table_parity",
    """select unnest(['view', 'table']) as object_name, count(*) as row_count,
       count(distinct p_type) as categories from part""",
)
def view_table_parity(spark: SparkSession, folder: str) -> DataFrame:
    view = catalog.publish_view(spark, "vw_parity", f"{folder}/part.parquet")
    copy = catalog.create_external_table(spark, "ext_parity", "vw_parity", scratch_path(spark, "parity"))
    return reconcile.parity(view, copy, "p_type", ("view", "table"))


@bound(
    "count_reconcile",
    """select 'orders since 1998' as table_name, count(*) as source_rows,
       count(*) filter (where o_orderdate >= timestamp '1998-01-01') as copy_rows,
       count(*) filter (where o_orderdate >= timestamp '1998-01-01') - count(*) as row_gap,
       case when count(*) filter (where o_orderdate >= timestamp '1998-01-01') = count(*) then 'match'
            else 'mismatch' end as status from orders""",
)
def count_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    path = scratch_path(spark, "recent-orders")
    recent = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    publish.publish(orders.filter(recent), path)
    return reconcile.count_reconcile(orders, spark.read.parquet(path), "orders since 1998")


@bound(
    "column_reconcile",
    """with s as (select count(*) as n, count(distinct o_orderkey) as k, count(distinct o_custkey) as c,
         count(distinct o_orderstatus) as st, count(distinct o_totalprice) as t,
         count(distinct o_orderdate) as d, count(distinct o_orderpriority) as p,
         count(*) filter (where o_orderstatus <> 'P') as known from orders)
       select 'o_orderkey' as column_name, n as source_values, n as copy_values,
         k as source_distinct_values, k as copy_distinct_values, 'match' as status from s
       union all select 'o_custkey', n, n, c, c, 'match' from s
       union all select 'o_orderstatus', n, known, st, st - 1, 'mismatch' from s
       union all select 'o_totalprice', n, n, t, t, 'match' from s
       union all select 'o_orderdate', n, null, d, null, 'missing in copy' from s
       union all select 'o_orderpriority', n, n, p, p, 'mismatch' from s""",
)
def column_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    # a copy that lost a column, blanked a status and changed the case of a text
    changed = orders.drop("o_orderdate").withColumns(
        {
            "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("P")),
            "o_orderpriority": F.lower("o_orderpriority"),
        }
    )
    path = scratch_path(spark, "changed-orders")
    publish.publish(changed, path)
    compared = reconcile.column_reconcile(orders, spark.read.parquet(path), distinct="exact")
    return compared.select(
        "column_name",
        "source_values",
        "copy_values",
        "source_distinct_values",
        "copy_distinct_values",
        "status",
    )
