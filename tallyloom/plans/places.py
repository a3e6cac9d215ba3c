"""Geolocation, customers and sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.ladders import at_least, group_of
from tallyloom.functions.numbers import percent
from tallyloom.operators import classify, joins, stats
from tallyloom.operators.scalars import with_scalar
from tallyloom.plans import rules

CUSTOMER_COLUMNS = (
    "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
)
SELLER_COLUMNS = ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
GEO_COLUMNS = (
    "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_state",
    "geolocation_city_final",
)


def clean_geolocation(geolocation: DataFrame) -> DataFrame:
    """Distinct places with padded codes and one spelling per code, adding the final city name.

    Known names are never outvoted. The vote takes place among distinct rows.
    """
    code = "geolocation_zip_code_prefix"
    padded = geolocation.withColumn(code, text.pad_code(F.col(code)))
    folded = text.correct_from(text.fold_place(F.col("geolocation_city")), rules.CITY_CORRECTIONS)
    standard = padded.distinct().withColumn("__city", folded)
    voted = stats.repair_by_mode(
        standard, [code], "__city", "geolocation_city_final", keep=tuple(rules.CITY_CORRECTIONS)
    )
    return voted.withColumn(
        "geolocation_city_final", text.title_case(F.col("geolocation_city_final"))
    ).drop("__city")


def publish_geolocation(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*GEO_COLUMNS)


def clean_customers(customers: DataFrame, geolocation: DataFrame, on_ambiguous: str = "mode") -> DataFrame:
    """Customers with padded codes and, where the code is known, the city of the geolocation table."""
    code = "customer_zip_code_prefix"
    named = customers.withColumns(
        {
            code: text.pad_code(F.col(code)),
            "customer_city": text.alias_then_title(
                F.col("customer_city"), rules.CITY_ALIASES, rules.CITY_MARKERS
            ),
        }
    )
    placed = joins.prefer_reference(
        named,
        geolocation,
        key=code,
        column="customer_city",
        lookup_key="geolocation_zip_code_prefix",
        lookup_value="geolocation_city_final",
        on_ambiguous=on_ambiguous,
    )
    return placed.select(*CUSTOMER_COLUMNS)


def clean_sellers(sellers: DataFrame, keep_null_city: bool = True) -> DataFrame:
    """Sellers with clean names and market classes.

    `keep_null_city=False` drops sellers whose city could not be read, as an inner join on the
    city counts would.
    """
    cleaned = sellers.withColumns(
        {
            "seller_id": F.trim("seller_id"),
            "seller_city": text.delimited_name(F.trim("seller_city"), rules.SELLER_ABBREVIATIONS),
            "seller_state": F.upper(F.trim("seller_state")),
            "seller_zip_code_prefix": text.pad_code(F.col("seller_zip_code_prefix")),
        }
    )
    total = sellers.agg(F.count(F.lit(1))).scalar()
    groupings = {"sellers_in_state": ["seller_state"], "sellers_in_city": ["seller_city"]}
    counted = joins.attach_group_counts(cleaned, groupings, keep_null_city)
    city, state = F.col("seller_city"), F.col("seller_state")
    classed = counted.withColumns(
        {
            "metropolitan_area": group_of(city, rules.METRO_CITIES, "Other"),
            "seller_region": group_of(state, rules.REGION_STATES, "Unknown"),
            "city_size": at_least(F.col("sellers_in_city"), rules.CITY_SIZE_STEPS, rules.CITY_SIZE_LAST),
            "seller_density": at_least(F.col("sellers_in_city"), rules.DENSITY_STEPS, rules.DENSITY_LAST),
        }
    )
    shared = with_scalar(
        classed, total, lambda t: {"state_market_share": percent(F.col("sellers_in_state"), t)}
    )
    proximity = classify.market_proximity(F.col("metropolitan_area"), state, rules.NEAR_MARKET_STATES)
    placed = shared.withColumn("market_proximity", proximity)
    potential = classify.business_potential(F.col("market_proximity"), F.col("seller_density"))
    return placed.withColumn("business_potential", potential)


def publish_sellers(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*SELLER_COLUMNS)
