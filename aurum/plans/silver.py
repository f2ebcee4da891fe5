"""Silver models (M-06…M-10): deduplicated, validated, PII-masked.

Each function is ``(bronze staging DataFrame(s), Settings) -> DataFrame``.
Incremental runs reuse the same functions through ``operators.upsert``;
statistics and sessions are always computed from the full bronze input
(D11), never from a partial batch.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.config import Settings
from aurum.functions.columns import (
    INBOUND_TYPES, OUTBOUND_TYPES, TRANSFER_TYPES, age_bucket, audit_columns, elapsed_seconds,
    is_bot, is_valid_email, standardize_name, surrogate_key, url_param,
)
from aurum.functions.privacy import mask_phone, salted_hash
from aurum.operators.dedup import dedup_latest
from aurum.operators.fifo import fifo_value
from aurum.operators.joins import sized

AUDIT = ["_loaded_at", "_loaded_by", "_runtime_version"]

# dedup order after _loaded_at DESC: remaining business columns, DESC NULLS LAST
SALES_TIEBREAK = ["transaction_date", "store_id", "product_sku", "quantity", "unit_price",
                  "amount", "currency", "payment_method", "customer_email"]
INVENTORY_TIEBREAK = ["movement_date", "product_sku", "warehouse_id", "movement_type", "quantity"]


def _apply_fx(df: DataFrame, fx_rates: DataFrame | None) -> DataFrame:
    """F-29 / E-05: ``amount_usd`` from a (currency, rate_date) table; identity
    when no table is given (D12).  The rate table grows by currencies × days: it is
    broadcast while it is small, else the rows are shuffled by currency and day."""
    if fx_rates is None:
        return df.withColumn("amount_usd", F.col("amount_local"))
    r = fx_rates.select("currency", F.col("rate_date").alias("_fx_date"), "usd_rate")
    j = df.withColumn("_fx_date", F.to_date("transaction_date")).join(sized(r), ["currency", "_fx_date"], "left")
    usd = F.when(F.col("currency") == "USD", F.col("amount_local")).otherwise(
        (F.col("amount_local") * F.col("usd_rate")).cast("decimal(18,2)"))
    return j.withColumn("amount_usd", usd).drop("_fx_date", "usd_rate")


def sales_transactions_cleaned(stg: DataFrame, settings: Settings, fx_rates: DataFrame | None = None,
                               validate: bool = True) -> DataFrame:
    """M-06: latest row per transaction_id, valid amounts, hashed e-mail.

    ``validate=False`` keeps non-positive rows and applies the negative clamp
    instead (P-08; with validation on the clamp is dead code, D13).
    """
    # what is a function of the picked row is made after the pick, not shuffled with every version
    made = [c for c in ("surrogate_key", *AUDIT[1:]) if c in stg.columns]
    latest = dedup_latest(stg.drop(*made), "transaction_id", "_loaded_at", SALES_TIEBREAK, drop_null_keys=True)
    if validate:
        latest = latest.filter((F.col("amount") > 0) & (F.col("quantity") > 0))
    amount = F.when(F.col("amount") < 0, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("amount"))
    out = _apply_fx(latest.withColumn("amount_local", amount.cast("decimal(18,2)")), fx_rates)
    # hashes last: they are twice as long as the rows, and don't compress
    out = out.withColumn("customer_email_hashed", salted_hash("customer_email", settings.salt))
    out = out.withColumn("surrogate_key", surrogate_key("transaction_id", "transaction_date"))
    out = out.withColumns({k: v for k, v in audit_columns("_loaded_at").items() if k != "_loaded_at"})
    return out.select(
        "transaction_id", "store_id", "product_sku", "quantity", "amount_local", "currency",
        "payment_method", "transaction_date", "customer_email_hashed", "amount_usd",
        "surrogate_key", *AUDIT,
    )


def customers_cleaned(stg: DataFrame, settings: Settings) -> DataFrame:
    """M-07: names standardised, valid e-mails hashed (others NULL), phone
    masked, age bucket from a fixed ``as_of``."""
    return stg.select(
        "customer_id",
        standardize_name("full_name").alias("full_name_clean"),
        F.when(is_valid_email("email"), salted_hash("email", settings.salt)).alias("email_hashed"),
        mask_phone("phone_number").alias("phone_masked"),
        "date_of_birth", "address_city",
        F.upper("address_country").alias("country_code"),
        "registration_date", "loyalty_tier",
        age_bucket("date_of_birth", settings.as_of).alias("age_bucket"),
        "surrogate_key", "_loaded_at",
    )


def _signed(types, qty, sign: int):
    """Plain ADJUSTMENT counts by the sign of its quantity (D18)."""
    t, q = F.col("movement_type"), F.col(qty)
    hit = t.isin(*types)
    if sign > 0:
        hit = hit | ((t == "ADJUSTMENT") & (q > 0))
        return F.when(hit, q).otherwise(0)
    hit = hit | ((t == "ADJUSTMENT") & (q < 0))
    return F.when(hit & (t == "ADJUSTMENT"), -q).when(hit, q).otherwise(0)


def inventory_daily_flows(stg: DataFrame, unit_costs: DataFrame | None = None) -> DataFrame:
    """W-01 + A-05: latest row per movement, then in/out/transfer per
    (day, sku, warehouse).

    With ``unit_costs`` (``movement_id, unit_cost``) the receipts' total
    cost in cents is added as ``inbound_cost_cents``; the join meets the
    deduplicated movements, which are already partitioned by movement id.
    """
    return daily_flows(latest_movements(stg), unit_costs)


def latest_movements(stg: DataFrame) -> DataFrame:
    """W-01: the latest version of each movement, with what the flows need."""
    mv = stg.select("movement_id", "product_sku", "warehouse_id", "movement_type", "quantity",
                    "movement_date", "_loaded_at")
    return dedup_latest(mv, "movement_id", "_loaded_at", INVENTORY_TIEBREAK)


def daily_flows(latest: DataFrame, unit_costs: DataFrame | None = None) -> DataFrame:
    """A-05: in/out/transfer per (day, sku, warehouse) of deduplicated movements."""
    aggs = [
        F.sum(_signed(INBOUND_TYPES, "quantity", 1)).cast("bigint").alias("inbound_qty"),
        F.sum(_signed(OUTBOUND_TYPES, "quantity", -1)).cast("bigint").alias("outbound_qty"),
        F.sum(F.when(F.col("movement_type").isin(*TRANSFER_TYPES), F.col("quantity")).otherwise(0))
         .cast("bigint").alias("transfer_qty"),
        F.max("_loaded_at").alias("_loaded_at"),
    ]
    if unit_costs is not None:
        latest = latest.join(unit_costs.select("movement_id", "unit_cost"), "movement_id", "left")
        cents = (F.col("unit_cost") * F.lit(100)).cast("bigint")
        received = _signed(INBOUND_TYPES, "quantity", 1).cast("bigint")
        aggs.append(F.sum(F.when(received != 0, received * cents).otherwise(0)).alias("inbound_cost_cents"))
    return latest.groupBy(
        F.to_date("movement_date").alias("movement_date"), "product_sku", "warehouse_id"
    ).agg(*aggs)


def _cents_to_money(c) -> Column:
    return (c.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def inventory_fifo_snapshots(stg: DataFrame, unit_costs: DataFrame) -> DataFrame:
    """E-04 (declared ``total_cost`` of M-08): daily stock per (sku,
    warehouse) valued first-in first-out; see ``operators.fifo``."""
    flows = inventory_daily_flows(stg, unit_costs)
    v = fifo_value(flows, ["product_sku", "warehouse_id"], "movement_date", "inbound_qty",
                   "inbound_cost_cents", "outbound_qty", value_col="_value_cents")
    return v.select(
        F.col("movement_date").alias("snapshot_date"), "product_sku", "warehouse_id",
        (F.col("_received") - F.col("_issued")).alias("quantity_on_hand"),
        "inbound_qty", "outbound_qty",
        _cents_to_money(F.col("inbound_cost_cents")).alias("inbound_cost"),
        _cents_to_money(F.col("_value_cents")).alias("total_cost"),
    )


def inventory_snapshots(stg: DataFrame, settings: Settings | None = None) -> DataFrame:
    """M-08: running stock per (sku, warehouse) over days (W-03).  The window
    partitions hold one row per day, so they stay small at any scale."""
    return running_stock(inventory_daily_flows(stg))


def running_stock(flows: DataFrame, carried: Column | None = None, pair=("product_sku", "warehouse_id")) -> DataFrame:
    """W-03 over daily flows; ``carried`` is the balance before a pair's first day,
    ``pair`` the columns that tell pairs apart (where flows are dealt by others than these).

    The key is made of the window's rows: what one select makes beside a window
    is made below it, and shuffled."""
    w = (Window.partitionBy(*pair).orderBy("movement_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stock = F.sum(F.col("inbound_qty") - F.col("outbound_qty")).over(w)
    run = flows.withColumn("quantity_on_hand", stock if carried is None else stock + carried)
    return run.select(
        F.col("movement_date").alias("snapshot_date"),
        "product_sku", "warehouse_id", "quantity_on_hand",
        "inbound_qty", "outbound_qty", "transfer_qty",
        surrogate_key("product_sku", "warehouse_id", "movement_date").alias("surrogate_key"),
        "_loaded_at",
    )


def _session_aggregate(stg: DataFrame) -> DataFrame:
    """A-03 in two aggregates: first one row per (session, user, type, URL), so that
    the distinct counts become plain sums; no row is copied per distinct count."""
    first = F.min(F.struct(
        F.col("event_timestamp").alias("ts"), F.col("event_id").alias("id"),
        F.col("device_type").alias("device_type"), F.col("browser").alias("browser"),
        F.col("country_code").alias("country_code"), F.col("referrer_url").alias("referrer_url"),
        F.col("page_url").alias("page_url"),
    ))
    pages = stg.groupBy("session_id", "user_id", "event_type", "page_url").agg(
        F.min("event_timestamp").alias("_start"), F.max("event_timestamp").alias("_end"), first.alias("_first"),
        F.count(F.lit(1)).alias("_events"), F.max("_loaded_at").alias("_loaded_at"))
    t, url = F.col("event_type"), F.col("page_url")
    return pages.groupBy("session_id", "user_id").agg(
        F.min("_start").alias("session_start"),
        F.max("_end").alias("session_end"),
        F.count(F.when(t == "page_view", url)).alias("pages_viewed"),
        F.count(F.when(t == "purchase", url)).alias("purchases"),
        F.size(F.collect_set(t)).cast("bigint").alias("distinct_event_types"),  # a handful of types
        F.min("_first").alias("_first"),
        F.min(F.to_date("_start")).alias("event_date"),
        F.sum("_events").alias("_events"),
        F.max("_loaded_at").alias("_loaded_at"),
    )


def web_sessions_enriched(stg: DataFrame, settings: Settings, keep_bots: bool = False,
                          with_utm: bool = False) -> DataFrame:
    """M-09 (A-03, F-24, P-09): one row per (session_id, user_id).

    "First" values come from the earliest event (ties by event id), never
    from an arbitrary row.  Bots are filtered unless ``keep_bots``.
    """
    s = _session_aggregate(stg)
    dur = elapsed_seconds("session_start", "session_end")
    s = s.withColumn("session_duration_seconds", dur)
    bot = is_bot("session_duration_seconds", "_events", "_first.browser",
                 settings.bot_burst_events, settings.bot_events_per_second)
    cols = [
        "session_id", "user_id", "session_start", "session_end", "session_duration_seconds",
        "pages_viewed", "purchases", "distinct_event_types",
        F.col("_first.device_type").alias("device_type"),
        F.col("_first.browser").alias("browser"),
        F.col("_first.country_code").alias("country_code"),
        F.col("_first.referrer_url").alias("landing_referrer"),
        "event_date", bot.alias("is_bot"),
    ]
    if with_utm:
        cols += [F.col("_first.page_url").alias("landing_page"),
                 url_param("_first.page_url", "utm_source").alias("utm_source")]
    out = s.select(*cols, "_loaded_at")
    return out if keep_bots else out.filter(~F.col("is_bot"))


def sensor_stats(readings: DataFrame) -> DataFrame:
    """A-04: mean and sample stddev per (sensor_type, unit)."""
    return readings.groupBy("sensor_type", "reading_unit").agg(
        F.avg("reading_value").alias("mean_value"),
        F.stddev_samp("reading_value").alias("stddev_value"),
        F.count("reading_value").alias("n"),
    )


def iot_readings_validated(stg: DataFrame, settings: Settings, stats: DataFrame | None = None) -> DataFrame:
    """M-10 (J-01, F-17): z-score against full-history stats; > k·σ → outlier,
    value nulled; σ NULL or 0 → raw value kept, z = 0.

    The stats side has one row per (sensor type, unit); AQE sees its runtime
    size and broadcasts it, so readings are never shuffled for this join.
    """
    stats = sensor_stats(stg) if stats is None else stats
    k = float(settings.zscore_threshold)
    r = stg.withColumn("reading_date", F.to_date("reading_timestamp"))
    j = r.join(stats.select("sensor_type", "reading_unit", "mean_value", "stddev_value"),
               ["sensor_type", "reading_unit"], "left")
    v, m, sd = F.col("reading_value"), F.col("mean_value"), F.col("stddev_value")
    far = F.abs(v - m) > F.lit(k) * sd
    return j.select(
        "device_id", "sensor_type",
        v.alias("reading_value_raw"),
        "reading_unit", "battery_level", "firmware_version", "reading_timestamp", "reading_date",
        F.when(sd.isNull() | (sd == 0), v).when(far, F.lit(None).cast("double")).otherwise(v)
         .alias("reading_value_validated"),
        # a constant group (σ = 0) has no outliers, matching the kept value
        F.coalesce((sd > 0) & far, F.lit(False)).alias("is_outlier"),
        F.round(F.when(sd > 0, (v - m) / sd).otherwise(F.lit(0.0)), 6).alias("z_score"),
        "surrogate_key", "_loaded_at",
    )
