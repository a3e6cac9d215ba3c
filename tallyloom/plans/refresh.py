"""The whole way from raw files to published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyloom.operators.reconcile import zone_counts
from tallyloom.plans import orders, places, products, reviews, schema
from tallyloom.session import temporary_copies
from tallyloom.sources import catalog
from tallyloom.sources.publish import Published, RawTable, land, publish, write_rejects
from tallyloom.sources.readers import read_table


def land_raw(
    spark: SparkSession, sources: Mapping[str, str], zone: str, on_rejects: str = "record"
) -> list[Published]:
    """Land the raw CSV files, by table name, as Parquet tables of the raw zone (see `publish.land`)."""
    tables = [
        RawTable(name, path, StructType.fromDDL(schema.TABLES[name]), name in schema.MULTI_LINE)
        for name, path in sources.items()
    ]
    return land(spark, tables, zone, on_rejects)


def clean_all(
    spark: SparkSession, raw_zone: str, zone: str, as_of: str, dictionary: DataFrame | None = None
) -> dict[str, Published]:
    """Clean the nine raw tables and publish them to the ready zone.

    Tables with derived columns are published twice: under their own name in the published schema,
    and whole as `<name>_enriched`, which is computed once and read back for the former. What each
    stage took out of the order items is reported in `order_items_funnel`.
    `dictionary` translates review texts (`source_text`, `translated_text`). What is stored on the way is
    removed at the end.
    """
    with temporary_copies(spark):
        return _clean_all(spark, raw_zone, zone, as_of, dictionary)


def _clean_all(
    spark: SparkSession, raw_zone: str, zone: str, as_of: str, dictionary: DataFrame | None
) -> dict[str, Published]:
    raw = {name: read_table(spark, raw_zone, name) for name in schema.TABLES}
    done: dict[str, Published] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        done[name] = publish(df, f"{zone}/{name}.parquet")
        return read_table(spark, zone, name)

    geolocation = put("geolocation", places.publish_geolocation(places.clean_geolocation(raw["geolocation"])))
    put("customers", places.clean_customers(raw["customers"], geolocation))
    sellers = put("sellers_enriched", places.clean_sellers(raw["sellers"]))
    put("sellers", places.publish_sellers(sellers))

    categories = put(
        "product_category", products.publish_categories(products.clean_categories(raw["product_category"]))
    )
    enriched = put("products_enriched", products.clean_products(raw["products"], categories))
    put("products", enriched.select("product_id", "product_category_name", *products.SIZES))

    cleaned = put("orders_enriched", orders.clean_orders(raw["orders"]))
    put("orders", orders.publish_orders(cleaned))
    items, funnel = orders.clean_order_items(raw["order_items"], stored=True)
    put("order_items", items)
    write_rejects(funnel, f"{zone}/order_items_funnel")
    put("order_payments", orders.publish_payments(orders.clean_payments(raw["order_payments"])))

    if dictionary is None:
        dictionary = spark.createDataFrame([], "source_text string, translated_text string")
    plain = put("order_reviews_cleaned", reviews.clean_reviews(raw["order_reviews"], as_of))
    put("order_reviews", reviews.publish_reviews(reviews.translate_reviews(plain, dictionary)))
    return done


def publish_names(
    spark: SparkSession, zone: str, tables: list[str], stored_at: str | None = None
) -> dict[str, DataFrame]:
    """A view `vw_<name>` over each table of a zone, and with `stored_at` a stored copy `ext_<name>` too."""
    published = {}
    for name in tables:
        published[f"vw_{name}"] = catalog.publish_view(spark, f"vw_{name}", f"{zone}/{name}.parquet")
        if stored_at:
            published[f"ext_{name}"] = catalog.create_external_table(
                spark, f"ext_{name}", f"vw_{name}", f"{stored_at}/{name}"
            )
    return published


def zone_report(
    spark: SparkSession, raw_zone: str, zone: str, tables: Sequence[str], published: Mapping[str, DataFrame]
) -> DataFrame:
    """Rows of each table in the raw zone, the ready zone, its view and its stored copy, and whether they agree.

    `published` is what `publish_names` returned; a table without view or copy has null there.
    """
    places = {
        "raw": {name: read_table(spark, raw_zone, name) for name in tables if name in schema.TABLES},
        "ready": {name: read_table(spark, zone, name) for name in tables},
        "view": {name: published[f"vw_{name}"] for name in tables if f"vw_{name}" in published},
        "stored": {name: published[f"ext_{name}"] for name in tables if f"ext_{name}" in published},
    }
    return zone_counts(places)
