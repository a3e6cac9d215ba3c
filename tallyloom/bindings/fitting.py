"""Statistics fitted once and applied to batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.bindings import cleaners, domain
from tallyloom.bindings.registry import ORACLES, bound, table
from tallyloom.operators import fitted, stats
from tallyloom.plans import orders as order_plans
from tallyloom.plans import products
from tallyloom.session import materialise, scratch_path
from tallyloom.streaming.incremental import land_new_files

_FITTED = {"l_quantity": "double", "l_extendedprice": "double", "l_linenumber": "int", "l_orderkey": "bigint"}


def _rounded(name: str) -> str:
    return f"round(({name})::decimal(38,12), 4)::double"


def _typed(name: str, kind: str) -> str:
    """A number as text, without the fraction that whole doubles are printed with."""
    return f"({name})::{'double' if kind == 'double' else 'bigint'}::double"


@bound(
    "fitted_figures",
    " union all ".join(
        f"""select '{c}' as column_name, '{kind}' as data_type, count({c}) as value_count, {_rounded(f"avg({c})")} as mean,
            {_rounded(f"stddev_samp({c})")} as stddev, {_typed(f"min({c})", kind)} as min_value,
            {", ".join(f"{_typed(f'quantile_disc({c}, {share})', kind)} as {name}" for share, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")))},
            {_typed(f"max({c})", kind)} as max_value from lineitem"""
        for c, kind in _FITTED.items()
    ),
)
def fitted_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Moments, ends and quartiles of four columns, stored and read back."""
    path = scratch_path(spark, "figures")
    fitted.fit(table(spark, folder, "lineitem"), list(_FITTED), quartiles=list(_FITTED)).store(spark, path)
    figures = fitted.load(spark, path).table(spark)
    values = {c: F.col(c).cast("double") for c in ("min_value", "q1", "median", "q3", "max_value")}
    return figures.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")} | values)


@bound(
    "stream_scored",
    """with s as (select avg(value) as m, stddev_samp(value) as sd, quantile_disc(value, 0.25) as q1,
         quantile_disc(value, 0.5) as q2, quantile_disc(value, 0.75) as q3 from events)
       select event_id, value, coalesce(value > m + 2 * sd, false) as is_outlier,
         round(abs((value - m) / sd), 6) as zscore, abs((value - m) / sd) > 1.5 as is_far,
         case when value <= q1 / 2 then 'Extra Small' when value <= q1 then 'Small' when value <= q2 then 'Medium Small'
           when value <= q3 then 'Medium Large' when value <= q3 * 2 then 'Large' else 'Extra Large' end as tier
       from events, s""",
)
def stream_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive as files, flagged and classed by figures that were fitted and stored before."""
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    root = scratch_path(spark, "scored")
    fitted.fit(events, ["value"], quartiles=["value"]).store(spark, f"{root}/figures")
    figures = fitted.load(spark, f"{root}/figures")

    def scored(rows: DataFrame) -> DataFrame:
        flagged = stats.flag_upper_outliers(rows, {"value": "is_outlier"}, sigmas=2, figures=figures)
        far = stats.add_zscore(flagged, "value", flag="is_far", sigmas=1.5, figures=figures)
        return far.withColumn("tier", stats.volume_tier(F.col("value"), figures.quartiles("value")))

    later = F.col("event_id") % 3 == 0
    for arrived in (events.filter(later), events.filter(~later)):
        arrived.repartition(3).write.mode("append").parquet(f"{root}/inbox")
        land_new_files(spark, f"{root}/inbox", events.schema, f"{root}/landed", f"{root}/progress", files_per_batch=2, transform=scored)
    landed = spark.read.parquet(f"{root}/landed")
    return landed.select("event_id", "value", "is_outlier", F.round("zscore", 6).alias("zscore"), "is_far", "tier")


def _streamed(spark: SparkSession, rows: DataFrame, label: str, deal: str, transform) -> DataFrame:
    """`rows` arriving as files on two days, each transformed and landed on its day."""
    root = scratch_path(spark, label)
    raw = materialise(rows, f"{label}-raw")
    for arrived in (raw.filter(deal), raw.filter(f"not ({deal})")):
        arrived.repartition(2).write.mode("append").parquet(f"{root}/inbox")
        land_new_files(spark, f"{root}/inbox", raw.schema, f"{root}/landed", f"{root}/progress", transform=transform)
    return spark.read.parquet(f"{root}/landed")


@bound("stream_orders_cleaned", ORACLES["orders_cleaned"])
def stream_orders_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The whole order cleaner over orders that arrive as files, by duration figures fitted and stored before."""
    orders = domain.retail_orders(spark, folder)
    path = scratch_path(spark, "order-figures")
    order_plans.fit_orders(orders).store(spark, path)
    figures = fitted.load(spark, path)
    cleaned = _streamed(spark, orders, "orders", "hash(order_id) % 2 = 0", lambda rows: order_plans.clean_orders(rows, figures))
    return cleaned.select(*domain.CLEANED_ORDERS)


@bound("stream_products_cleaned", ORACLES["products_cleaned"])
def stream_products_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The whole product cleaner over products that arrive as files, by quartiles fitted and stored before."""
    raw = cleaners.retail_products(spark, folder)
    categories = materialise(products.clean_categories(cleaners.retail_categories(spark, folder)), "categories")
    path = scratch_path(spark, "product-figures")
    products.fit_products(raw, categories).store(spark, path)
    figures = fitted.load(spark, path)

    def clean(rows: DataFrame) -> DataFrame:
        return products.clean_products(rows, categories, figures=figures)

    return _streamed(spark, raw, "products", "hash(product_id) % 3 = 0", clean).select(*cleaners.PRODUCT_OUT)
