"""Schema, keys, references and constraints of the raw retail tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import validate
from tallyloom.operators.validate import Relation, Rule, in_list, not_null
from tallyloom.plans import rules

# Columns and types of the raw files, in file order.
TABLES = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
    "customer_city string, customer_state string",
    "geolocation": "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
    "geolocation_city string, geolocation_state string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp_ntz, price double, freight_value double",
    "order_payments": "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double",
    "order_reviews": "review_id string, order_id string, review_score string, review_comment_title string, "
    "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    "orders": "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp string, order_approved_at string, order_delivered_carrier_date string, "
    "order_delivered_customer_date string, order_estimated_delivery_date string",
    "products": "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g int, "
    "product_length_cm int, product_height_cm int, product_width_cm int",
    "product_category": "product_category_name string, product_category_name_english string",
    "sellers": "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
}
# tables whose text may hold line breaks
MULTI_LINE = ("order_reviews",)

KEYS = {
    "customers": ["customer_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "product_category": ["product_category_name"],
    "sellers": ["seller_id"],
}

REFERENCES = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
    ("products", "product_category_name", "product_category", "product_category_name"),
)

_SIDES = ("length", "height", "width")
CONSTRAINTS = {
    "customers": [
        not_null("customer_unique_id"),
        not_null("customer_zip_code_prefix"),
        not_null("customer_city"),
        not_null("customer_state"),
    ],
    "geolocation": [
        *[not_null(f"geolocation_{part}") for part in ("zip_code_prefix", "lat", "lng", "city", "state")],
        in_list("valid_state", "geolocation_state", rules.STATE_CODES),
    ],
    "order_items": [
        *[not_null(c) for c in ("product_id", "seller_id", "shipping_limit_date", "price", "freight_value")],
        Rule("price_positive", "price > 0"),
        Rule("freight_not_negative", "freight_value >= 0"),
    ],
    "order_payments": [
        *[not_null(c) for c in ("payment_type", "payment_installments", "payment_value")],
        in_list("valid_payment_type", "payment_type", rules.PAYMENT_TYPES),
    ],
    "order_reviews": [
        Rule("score_1_to_5", "try_cast(review_score as int) between 1 and 5", null_ok=False),
        not_null("review_creation_date"),
    ],
    "orders": [
        not_null("customer_id"),
        not_null("order_status"),
        in_list("valid_order_status", "order_status", rules.ORDER_STATUSES),
        not_null("order_purchase_timestamp"),
        not_null("order_estimated_delivery_date"),
    ],
    "products": [
        Rule("weight_not_negative", "product_weight_g >= 0"),
        *[Rule(f"{side}_positive", f"product_{side}_cm > 0") for side in _SIDES],
    ],
    "product_category": [not_null("product_category_name_english")],
    "sellers": [
        *[not_null(f"seller_{part}") for part in ("zip_code_prefix", "city", "state")],
        in_list("valid_state", "seller_state", rules.STATE_CODES),
    ],
}


def audit(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Key, reference and constraint reports over those tables that are given."""
    keyed = [validate.key_audit(tables[t], keys, t) for t, keys in KEYS.items() if t in tables]
    checked = [
        validate.constraint_report(tables[t], checks).select(F.lit(t).alias("table_name"), "*")
        for t, checks in CONSTRAINTS.items()
        if t in tables
    ]
    relations = [
        Relation(f"{child}.{column}", tables[child], [column], tables[parent], [parent_column])
        for child, column, parent, parent_column in REFERENCES
        if child in tables and parent in tables
    ]
    reports = {
        "keys": reduce(DataFrame.unionByName, keyed),
        "constraints": reduce(DataFrame.unionByName, checked),
    }
    if relations:
        reports["references"] = validate.foreign_key_audit(relations)
    return reports
