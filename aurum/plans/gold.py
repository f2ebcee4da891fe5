"""Gold models (M-11…M-15) plus the LTV model from the docs (J-06/A-16).

Aggregates are expressed once and left to Catalyst: partial (map-side)
aggregation before every shuffle, one Window node per partition spec.
Averages are exact ``sum / count`` in DOUBLE; averages of DOUBLE inputs are
taken in integer micro-units (``micro_avg``) so summation order cannot change
the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aurum.config import Settings
from aurum.functions.columns import (
    abc_class, avg_order_value, churn_risk_score, days_on_hand, ltv_tier, micro_avg, pct_round2,
    ratio, rfm_segment, stockout_risk,
)

MONEY_SUM = "decimal(38,2)"


def daily_sales_summary(sales: DataFrame) -> DataFrame:
    """M-11 (A-01, W-06): KPIs per (day, store, currency) and growth against
    the previous *row* of the same store/currency (D16)."""
    g = sales.groupBy(
        F.to_date("transaction_date").alias("sales_date"), "store_id", "currency"
    ).agg(
        F.count_distinct("transaction_id").alias("order_count"),
        F.count_distinct("customer_email_hashed").alias("unique_customers"),
        F.sum("amount_local").cast(MONEY_SUM).alias("total_revenue_local"),
        F.sum("amount_usd").cast(MONEY_SUM).alias("total_revenue_usd"),
        F.count("amount_local").alias("_n_local"),
        F.count("amount_usd").alias("_n_usd"),
        F.sum("quantity").cast("bigint").alias("items_sold"),
    )
    w = Window.partitionBy("store_id", "currency").orderBy("sales_date")
    prev = F.lag("total_revenue_usd").over(w)
    return g.select(
        "sales_date", "store_id", "currency", "order_count", "unique_customers",
        "total_revenue_local", "total_revenue_usd",
        ratio("total_revenue_local", "_n_local").alias("avg_order_value_local"),
        ratio("total_revenue_usd", "_n_usd").alias("avg_order_value_usd"),
        "items_sold",
        F.when(prev > 0, ratio(F.col("total_revenue_usd") - prev, prev)).alias("mom_revenue_growth"),
    )


def rfm(sales: DataFrame, as_of) -> DataFrame:
    """A-02: recency / frequency / monetary per hashed e-mail.

    Rows without an e-mail hash are excluded: they can never join a customer
    and would otherwise form one hot group of every anonymous sale (D9).
    """
    return sales.filter(F.col("customer_email_hashed").isNotNull()).groupBy("customer_email_hashed").agg(
        F.max("transaction_date").alias("last_purchase_date"),
        F.count_distinct("transaction_id").alias("frequency"),
        F.sum("amount_usd").cast(MONEY_SUM).alias("monetary"),
        F.min("transaction_date").alias("first_purchase_date"),
    ).withColumn("recency_days", F.datediff(F.lit(as_of), F.to_date("last_purchase_date")))


def _left_join_split_nulls(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """Left join where rows with a NULL key skip the shuffle join entirely:
    they cannot match, and as one hash bucket they would land in one task."""
    rcols = [c for c in right.columns]
    nulls = left.filter(F.col(lkey).isNull())
    for c in rcols:
        nulls = nulls.withColumn(c, F.lit(None).cast(right.schema[c].dataType))
    matched = left.filter(F.col(lkey).isNotNull()).join(right, F.col(lkey) == F.col(rkey), "left")
    return matched.unionByName(nulls)


def customer_360(customers: DataFrame, sales: DataFrame, settings: Settings,
                 include_name: bool = False) -> DataFrame:
    """M-12 (A-02, J-02, F-18…F-20).  The customer name is personal data and
    stays out of gold unless asked for (D39)."""
    r = rfm(sales, settings.as_of)
    j = _left_join_split_nulls(customers, r, "email_hashed", "customer_email_hashed")
    reg_ts = F.col("registration_date").cast("timestamp_ntz")
    cols = ["customer_id"] + (["full_name_clean"] if include_name else []) + [
        "email_hashed", "country_code", "registration_date", "loyalty_tier", "age_bucket",
        F.coalesce("first_purchase_date", reg_ts).alias("first_purchase_date"),
        F.coalesce("last_purchase_date", reg_ts).alias("last_purchase_date"),
        F.coalesce("recency_days", F.lit(9999)).alias("recency_days"),
        F.coalesce("frequency", F.lit(0).cast("bigint")).alias("lifetime_orders"),
        F.coalesce("monetary", F.lit(0).cast(MONEY_SUM)).alias("lifetime_value"),
        rfm_segment("monetary", "frequency", "recency_days").alias("customer_segment"),
        churn_risk_score("monetary", "recency_days").alias("churn_risk_score"),
        avg_order_value("monetary", "frequency").alias("avg_order_value"),
    ]
    return j.select(*cols)


def customer_ltv(customers: DataFrame, sales: DataFrame, settings: Settings) -> DataFrame:
    """J-06 / A-16 / F-25: lifetime spend and tier per customer."""
    s = sales.filter(F.col("customer_email_hashed").isNotNull()).groupBy("customer_email_hashed").agg(
        F.sum("amount_usd").cast(MONEY_SUM).alias("total_spend_usd"),
        F.count_distinct("transaction_id").alias("total_orders"),
        F.min("transaction_date").alias("first_purchase_date"),
        F.max("transaction_date").alias("last_purchase_date"),
    ).withColumn("days_since_last_purchase",
                 F.datediff(F.lit(settings.as_of), F.to_date("last_purchase_date")))
    j = _left_join_split_nulls(customers, s, "email_hashed", "customer_email_hashed")
    spend = F.coalesce("total_spend_usd", F.lit(0).cast(MONEY_SUM))
    return j.select(
        "customer_id", "email_hashed", "country_code", "loyalty_tier",
        spend.alias("lifetime_value_usd"),
        F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("lifetime_orders"),
        "first_purchase_date", "last_purchase_date", "days_since_last_purchase",
        ltv_tier(spend).alias("ltv_tier"),
    )


def daily_demand(sales: DataFrame) -> DataFrame:
    """A-06: units sold per (sku, day)."""
    return sales.groupBy("product_sku", F.to_date("transaction_date").alias("sale_date")).agg(
        F.sum("quantity").cast("bigint").alias("daily_quantity_sold"))


def demand_moving_average(sales: DataFrame, rows: int = 30, calendar: bool = False) -> DataFrame:
    """W-04: average daily demand over the last ``rows`` rows (reference
    parity, D15) or, with ``calendar``, the last ``rows`` calendar days."""
    d = daily_demand(sales)
    if calendar:
        w = (Window.partitionBy("product_sku").orderBy(F.unix_date("sale_date"))
             .rangeBetween(-(rows - 1), 0))
    else:
        w = Window.partitionBy("product_sku").orderBy("sale_date").rowsBetween(-(rows - 1), 0)
    return d.select(
        "product_sku", "sale_date", "daily_quantity_sold",
        ratio(F.sum("daily_quantity_sold").over(w), F.count("daily_quantity_sold").over(w))
        .alias("avg_daily_demand_30d"),
    )


def latest_demand(sales: DataFrame, rows: int = 30) -> DataFrame:
    """W-08: the moving average on each SKU's latest sale date
    (``max_by`` in one aggregate instead of window + DISTINCT)."""
    return demand_moving_average(sales, rows).groupBy("product_sku").agg(
        F.max_by("avg_daily_demand_30d", "sale_date").alias("avg_daily_demand_30d"))


def latest_inventory(snapshots: DataFrame) -> DataFrame:
    """W-02 / P-10: newest non-negative snapshot per SKU; ties on the date go
    to the highest warehouse id (D17).  One partial aggregate, no sort of a
    whole SKU partition."""
    m = snapshots.filter(F.col("quantity_on_hand") >= 0).groupBy("product_sku").agg(F.max(F.struct(
        "snapshot_date", "warehouse_id", "quantity_on_hand", "inbound_qty", "outbound_qty")).alias("m"))
    return m.select("m.snapshot_date", "product_sku", "m.warehouse_id", "m.quantity_on_hand",
                    "m.inbound_qty", "m.outbound_qty")


def inventory_health(snapshots: DataFrame, sales: DataFrame, settings: Settings | None = None) -> DataFrame:
    """M-13 (J-03, F-21…F-23)."""
    rows = settings.demand_window_rows if settings else 30
    li = latest_inventory(snapshots)
    ma = latest_demand(sales, rows)
    j = li.join(ma, "product_sku", "left")
    d = F.col("avg_daily_demand_30d")
    return j.select(
        "snapshot_date", "product_sku", "warehouse_id", "quantity_on_hand", "inbound_qty", "outbound_qty",
        F.coalesce(d, F.lit(0.0)).alias("avg_daily_demand_30d"),
        days_on_hand("quantity_on_hand", d).alias("days_on_hand"),
        stockout_risk("quantity_on_hand", d).alias("stockout_risk"),
        abc_class(d).alias("abc_class"),
    )


FUNNEL_STAGES = (("page_view", "had_page_view"), ("product_view", "had_product_view"),
                 ("add_to_cart", "had_add_to_cart"), ("checkout", "had_checkout"),
                 ("purchase", "had_purchase"))


def funnel_flags(events: DataFrame) -> DataFrame:
    """A-08: one row per session id with 0/1 stage flags (pre-aggregated so
    the join to sessions is 1:1, J-04)."""
    return events.groupBy("session_id").agg(*[
        F.max(F.when(F.col("event_type") == t, 1).otherwise(0)).alias(name)
        for t, name in FUNNEL_STAGES])


def web_conversion_funnel(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """M-14 (J-04, A-08, A-09): per (day, country, device) funnel counts and
    rates rounded to 2 decimals with NULL-safe denominators."""
    per_session = sessions.groupBy("session_id", "country_code", "device_type").agg(
        F.min("event_date").alias("funnel_date"))
    flags = funnel_flags(events)
    j = per_session.join(flags, "session_id", "left").fillna(0, [n for _, n in FUNNEL_STAGES])
    g = j.groupBy("funnel_date", "country_code", "device_type").agg(
        F.count(F.lit(1)).alias("sessions"),
        *[F.sum(n).cast("bigint").alias(out) for (_, n), out in zip(
            FUNNEL_STAGES, ("page_views", "product_views", "added_to_cart", "checkouts", "purchases"))])
    return g.select(
        "*",
        pct_round2("product_views", "sessions").alias("view_rate_pct"),
        pct_round2("added_to_cart", "page_views").alias("cart_rate_pct"),
        pct_round2("purchases", "added_to_cart").alias("purchase_rate_pct"),
        pct_round2("purchases", "sessions").alias("overall_conversion_pct"),
    )


def iot_device_daily(validated: DataFrame) -> DataFrame:
    """A-07: per (device, sensor, day) health figures."""
    return validated.groupBy("device_id", "sensor_type", "reading_date").agg(
        F.count(F.lit(1)).alias("readings_count"),
        F.count_if(F.col("is_outlier")).alias("outlier_count"),
        micro_avg("reading_value_validated").alias("avg_reading"),
        F.min("reading_value_validated").alias("min_reading"),
        F.max("reading_value_validated").alias("max_reading"),
        micro_avg("battery_level").alias("avg_battery_level"),
        micro_avg("z_score").alias("avg_z_score"),
        F.max("reading_timestamp").alias("last_reading"),
    )


def iot_anomaly_dashboard(validated: DataFrame, settings: Settings | None = None,
                          calendar: bool = False) -> DataFrame:
    """M-15 (W-05, W-07): rolling outlier share over the last 7 rows (or 7
    calendar days) and the gap to the previous reading day, in hours (D14)."""
    n = settings.anomaly_window_rows if settings else 7
    dd = iot_device_daily(validated)
    w = Window.partitionBy("device_id", "sensor_type").orderBy("reading_date")
    roll = (Window.partitionBy("device_id", "sensor_type").orderBy(F.unix_date("reading_date"))
            .rangeBetween(-(n - 1), 0)) if calendar else w.rowsBetween(-(n - 1), 0)
    prev = F.lag("last_reading").over(w)
    return dd.select(
        "device_id", "sensor_type", F.col("reading_date").alias("report_date"),
        "readings_count", "outlier_count", "avg_reading", "min_reading", "max_reading",
        "avg_battery_level", "avg_z_score", "last_reading",
        ratio(F.sum("outlier_count").over(roll) * 100, F.sum("readings_count").over(roll))
        .alias("anomaly_rate_7d_pct"),
        ((F.unix_timestamp("last_reading") - F.unix_timestamp(prev)).cast("double") / F.lit(3600.0))
        .alias("hours_since_last"),
        F.datediff(F.to_date("last_reading"), F.to_date(prev)).alias("days_since_last"),
    )
