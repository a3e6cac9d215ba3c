"""Orders, order items and payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates
from tallyloom.functions.text import tidy_label
from tallyloom.operators import classify, fitted, stats, validate
from tallyloom.operators.fitted import Fitted
from tallyloom.operators.validate import Rule
from tallyloom.plans import rules

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
ORDER_COLUMNS = ("order_id", "customer_id", "order_status", *ORDER_TIMES)
ITEM_COLUMNS = (
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
)
PAYMENT_COLUMNS = (
    "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
)


OUTLIER_FLAGS = {"processing_time": "is_processing_outlier", "delivery_time": "is_delivery_outlier"}


def time_orders(orders: DataFrame) -> DataFrame:
    """Orders with repaired status, durations, calendar parts and performance, row by row.

    Rows without an id, customer, status or purchase time are dropped.
    """
    required = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]
    kept = orders.dropna(subset=required)
    kept = kept.withColumns({c: dates.parse_timestamp(F.col(c)) for c in ORDER_TIMES})
    bought, approved, delivered, estimated = (
        F.col("order_purchase_timestamp"),
        F.col("order_approved_at"),
        F.col("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date"),
    )
    timed = kept.withColumns(
        {
            "processing_time": dates.days_between(bought, approved),
            "delivery_time": dates.days_between(approved, delivered),
            "estimated_delivery_time": dates.days_between(bought, estimated),
            **dates.calendar_parts(bought, "purchase"),
            "order_status": classify.repair_status(F.col("order_status"), delivered),
        }
    )
    return timed.withColumn(
        "delivery_performance", classify.delivery_performance(F.col("order_status"), delivered, estimated)
    )


def fit_orders(orders: DataFrame) -> Fitted:
    """The duration figures that `clean_orders` flags outliers by; a small table to keep."""
    return fitted.fit(time_orders(orders), list(OUTLIER_FLAGS))


def clean_orders(orders: DataFrame, figures: Fitted | None = None) -> DataFrame:
    """Orders with repaired status, durations, calendar parts, performance and outlier flags.

    Rows without an id, customer, status or purchase time are dropped. Duration statistics are
    those of the rows kept, or `figures` that `fit_orders` made before; orders may arrive as a stream then.
    """
    return stats.flag_upper_outliers(time_orders(orders), OUTLIER_FLAGS, rules.OUTLIER_SIGMAS, figures)


def publish_orders(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*ORDER_COLUMNS)


ITEM_RULES = (
    Rule("invalid price or freight", "price > 0 and freight_value >= 0", null_ok=False),
    Rule(
        "invalid shipping date",
        "shipping_limit_date between timestamp_ntz '{} 00:00:00' and timestamp_ntz '{} 00:00:00'".format(
            *rules.SHIPPING_WINDOW
        ),
        null_ok=False,
    ),
)


def clean_order_items(items: DataFrame, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid distinct order items, and a report of the rows each stage removed (see `validate.funnel`)."""
    typed = items.withColumn("shipping_limit_date", dates.parse_timestamp(F.col("shipping_limit_date")))
    return validate.funnel(typed.select(*ITEM_COLUMNS), ITEM_RULES, stored)


def clean_payments(payments: DataFrame) -> DataFrame:
    """Payments with readable types, cents, and a flag for zero values or instalments."""
    is_zero = (F.col("payment_installments") == 0) | (F.col("payment_value") == 0)
    return payments.withColumns(
        {
            "is_problematic": F.coalesce(is_zero, F.lit(False)),
            "payment_type": tidy_label(F.col("payment_type")),
            "payment_sequential": F.col("payment_sequential").try_cast("int"),
            "payment_installments": F.col("payment_installments").try_cast("int"),
            "payment_value": F.round(F.col("payment_value").try_cast("double"), 2),
        }
    )


def publish_payments(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*PAYMENT_COLUMNS)
