"""Bronze staging views (M-01…M-05 / P-01…P-06).

Each is a projection of the raw feed plus a surrogate key and the audit
columns stamped at ingest.  Pure narrow transformations: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.functions.columns import audit_columns, surrogate_key, url_query


def _audit(df: DataFrame) -> list:
    return [v.alias(k) for k, v in audit_columns().items()]


def stg_sales(raw: DataFrame) -> DataFrame:
    """P-01: ten columns, key over (transaction_id, transaction_date), rows
    without a date dropped."""
    return raw.select(
        "transaction_id", "store_id", "product_sku", "quantity", "unit_price", "amount",
        "currency", "payment_method", "customer_email",
        F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"),
        surrogate_key("transaction_id", F.col("transaction_date").cast("timestamp_ntz")).alias("surrogate_key"),
        *_audit(raw),
    ).filter(F.col("transaction_date").isNotNull())


def stg_customers(raw: DataFrame) -> DataFrame:
    """P-02."""
    return raw.select(
        "customer_id", "email", "full_name", "phone_number", "date_of_birth",
        "address_line1", "address_city", "address_country",
        F.col("registration_date").cast("date").alias("registration_date"),
        "loyalty_tier",
        surrogate_key("customer_id").alias("surrogate_key"),
        *_audit(raw),
    )


def stg_inventory(raw: DataFrame) -> DataFrame:
    """P-03."""
    return raw.select(
        "movement_id", "product_sku", "warehouse_id", "quantity", "movement_type",
        "from_location", "to_location",
        F.col("movement_date").cast("timestamp_ntz").alias("movement_date"),
        "reference_order_id",
        surrogate_key("movement_id").alias("surrogate_key"),
        *_audit(raw),
    )


def stg_web_events(raw: DataFrame) -> DataFrame:
    """P-04: adds the URL query string (UTM parameters live there)."""
    ts = F.col("event_timestamp").cast("timestamp_ntz")
    return raw.select(
        "event_id", "session_id", "user_id", "event_type", "page_url", "referrer_url",
        "device_type", "browser", "country_code",
        ts.alias("event_timestamp"),
        url_query("page_url").alias("page_query_string"),
        surrogate_key("event_id", ts).alias("surrogate_key"),
        *_audit(raw),
    )


def stg_iot(raw: DataFrame) -> DataFrame:
    """P-05."""
    ts = F.col("reading_timestamp").cast("timestamp_ntz")
    return raw.select(
        "device_id", "sensor_type", "reading_value", "reading_unit", "battery_level",
        "firmware_version", ts.alias("reading_timestamp"),
        surrogate_key("device_id", ts, "sensor_type").alias("surrogate_key"),
        *_audit(raw),
    )


STAGING = {
    "sales": stg_sales, "customers": stg_customers, "inventory": stg_inventory,
    "web_events": stg_web_events, "iot": stg_iot,
}
