"""Registered queries: name → ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through the adapters, so its work grows
with them; none runs on fixed inline data.  Audit columns that depend on the
run (``_loaded_by``, ``_runtime_version``) are left out of query outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aurum.plans.bed import Bed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RUN_AUDIT = ("_loaded_by", "_runtime_version")


def query(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Bed(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


def _drop_audit(df: DataFrame) -> DataFrame:
    return df.drop(*RUN_AUDIT)


# ------------------------------------------------------------ staging (P-01…P-05)
@query("stg_sales")
def _stg_sales(b: Bed):
    """P-01 / F-01 / P-06."""
    return _drop_audit(b.stg("sales"))


@query("stg_customers")
def _stg_customers(b: Bed):
    """P-02."""
    return _drop_audit(b.stg("customers"))


@query("stg_inventory")
def _stg_inventory(b: Bed):
    """P-03."""
    return _drop_audit(b.stg("inventory")).drop("from_location", "to_location")


@query("stg_web_events")
def _stg_web(b: Bed):
    """P-04 / F-11."""
    return _drop_audit(b.stg("web_events"))


@query("stg_iot")
def _stg_iot(b: Bed):
    """P-05."""
    return _drop_audit(b.stg("iot"))


# ------------------------------------------------------------ silver (M-06…M-10)
@query("sales_clean")
def _sales_clean(b: Bed):
    """M-06: W-01 dedup, P-07 validity filter, F-02 hashed e-mail."""
    return _drop_audit(b.sales)


@query("customers_clean")
def _customers_clean(b: Bed):
    """M-07: F-07…F-10, P-15, F-04."""
    return b.customers


@query("inventory_snapshots")
def _inventory_snapshots(b: Bed):
    """M-08: W-01, A-05, W-03."""
    return b.inventory


@query("web_sessions")
def _web_sessions(b: Bed):
    """M-09: A-03, F-24, P-09."""
    return b.sessions


@query("iot_validated")
def _iot_validated(b: Bed):
    """M-10: A-04, J-01, F-17."""
    return b.iot


# ------------------------------------------------------------ gold (M-11…M-15)
@query("daily_sales_summary")
def _daily_sales_summary(b: Bed):
    """M-11: A-01 + W-06."""
    return b.daily_sales


@query("customer_360")
def _customer_360(b: Bed):
    """M-12: A-02, J-02, F-18…F-20."""
    return b.customer_360


@query("inventory_health")
def _inventory_health(b: Bed):
    """M-13: A-06, W-04, W-08, P-10, W-02, J-03, F-21…F-23."""
    return b.inventory_health


@query("web_funnel")
def _web_funnel(b: Bed):
    """M-14: J-04, A-08, A-09."""
    return b.funnel


@query("iot_anomaly")
def _iot_anomaly(b: Bed):
    """M-15: A-07, W-05, W-07."""
    return b.iot_dashboard


# ================================================================ widened set
import datetime as _dt  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from aurum.functions.columns import is_valid_email, micro_avg, surrogate_key  # noqa: E402
from aurum.functions.privacy import apply_policy, drop_pii, mask_email, mask_phone, salted_hash  # noqa: E402
from aurum.operators import diff, quality, scd, upsert  # noqa: E402
from aurum.operators.dedup import dedup_latest, duplicate_keys  # noqa: E402
from aurum.plans import dq, gold, increments, reports, silver  # noqa: E402
from aurum.plans.silver import SALES_TIEBREAK  # noqa: E402
from aurum.sources import adapters  # noqa: E402
from aurum.sources.sinks import cut, discard  # noqa: E402

# first load = rows ingested before this instant; the rest is the next batch
BATCH_CUTOFF = _dt.datetime(1998, 1, 1)
EVENTS_CUTOFF = _dt.datetime(2024, 1, 20)
SCD_AS_OF = _dt.datetime(1998, 1, 1)
SNAPSHOTS = (_dt.datetime(1995, 1, 1), _dt.datetime(1997, 1, 1))
SALES_COMPARE = ["store_id", "product_sku", "quantity", "amount_local", "currency", "payment_method",
                 "transaction_date", "customer_email_hashed", "amount_usd"]


def _first_load(b: Bed):
    stg = b.stg("sales").filter(F.col("_loaded_at") < F.lit(BATCH_CUTOFF).cast("timestamp_ntz"))
    return _drop_audit(silver.sales_transactions_cleaned(stg, b.sales_settings))


def _next_batch(b: Bed, target):
    """S-10: staged rows newer than the target's high-water mark."""
    stg = upsert.incremental_batch(b.stg("sales"), target)
    return _drop_audit(silver.sales_transactions_cleaned(stg, b.sales_settings))


# ---------------------------------------------------------------- filters P-08…P-15
@query("amount_clamp")
def _amount_clamp(b: Bed):
    """P-08: validation off → negative amounts clamped to 0 instead of dropped."""
    return _drop_audit(silver.sales_transactions_cleaned(b.stg("sales"), b.sales_settings, validate=False))


@query("drop_pii")
def _drop_pii(b: Bed):
    """P-11: PII columns removed outright."""
    return drop_pii(_drop_audit(b.stg("customers")),
                    ["email", "full_name", "phone_number", "address_line1", "date_of_birth"])


@query("iot_alerts")
def _iot_alerts(b: Bed):
    """P-12 / T-02: today's device alerts, by anomaly rate."""
    return reports.iot_alerts(b.iot_dashboard, b.events_settings.as_of)


@query("iot_recent_outliers")
def _iot_recent(b: Bed):
    """P-13: outliers of one sensor type in the last 7 days."""
    return reports.recent_outliers(b.iot, "view", b.events_settings.as_of)


@query("stockout_watch")
def _stockout(b: Bed):
    """P-14: SKUs stocked out or critical."""
    return reports.stockout_watch(b.inventory_health)


@query("email_validity")
def _email_validity(b: Bed):
    """P-15: e-mail format check per customer."""
    return b.stg("customers").select("customer_id", is_valid_email("email").alias("email_valid"))


# ---------------------------------------------------------------- joins J-05…J-08
@query("customer_ltv")
def _customer_ltv(b: Bed):
    """J-06 / A-16 / F-25."""
    return gold.customer_ltv(b.customers, b.sales, b.sales_settings)


@query("upsert_merge")
def _upsert_merge(b: Bed):
    """S-07 / J-05: first load merged with the next batch (full-row update)."""
    t = _first_load(b)
    return upsert.upsert(t, _next_batch(b, t), "transaction_id")


@query("upsert_partial")
def _upsert_partial(b: Bed):
    """S-07 with update_columns: matched rows take only the listed columns."""
    t = _first_load(b)
    return upsert.upsert(t, _next_batch(b, t), "transaction_id",
                         update_columns=["quantity", "amount_local", "amount_usd"])


@query("upsert_insert_only")
def _upsert_insert_only(b: Bed):
    """S-08 / J-07: keep existing rows, add unseen keys."""
    t = _first_load(b)
    return upsert.upsert(t, _next_batch(b, t), "transaction_id", insert_only=True)


@query("incremental_filter")
def _incremental_filter(b: Bed):
    """S-10: staged rows past the first load's high-water mark."""
    return _drop_audit(upsert.incremental_batch(b.stg("sales"), _first_load(b)))


# ---------------------------------------------------------------- S-10: a first load, then one batch
def _split(b: Bed, feed: str, cutoff):
    """The feed's first load and the batch after it."""
    early = F.col("_loaded_at") < F.lit(cutoff).cast("timestamp_ntz")
    return b.stg(feed).where(early), b.stg(feed).where(~early | early.isNull())


@query("sales_incremental")
def _sales_incremental(b: Bed):
    """M-06 / S-10: touched transactions from all their copies replace the stored ones."""
    first, batch = _split(b, "sales", BATCH_CUTOFF)
    stored = silver.sales_transactions_cleaned(first, b.sales_settings)
    own, rows = increments.sales_changes(b.stg("sales"), batch, b.sales_settings)
    return _drop_audit(upsert.replace_scope(stored, rows, own))


@query("sessions_incremental")
def _sessions_incremental(b: Bed):
    """M-09 / S-10: touched sessions from all their events."""
    first, batch = _split(b, "web_events", EVENTS_CUTOFF)
    stored = silver.web_sessions_enriched(first, b.events_settings, keep_bots=True)
    own, rows = increments.session_changes(b.stg("web_events"), batch, b.events_settings)
    return upsert.replace_scope(stored, rows, own).where("NOT is_bot")


@query("inventory_incremental")
def _inventory_incremental(b: Bed):
    """M-08 / W-03 / S-10: running stock carried on from the stored balances.

    What the jobs store is stored here too, except the stock's key, which is a
    function of its row; a table goes when nothing reads it any more."""
    first, batch = _split(b, "inventory", BATCH_CUTOFF)
    movements = cut(silver.latest_movements(first), "movements")
    now, starts = increments.movement_changes(movements, batch, store=lambda now: cut(now, "now"))
    starts = cut(starts, "starts")
    stored = cut(silver.running_stock(silver.daily_flows(movements)).drop("surrogate_key"), "stock")
    rows = increments.stock_rows(stored, movements, now, starts, store=lambda flows: cut(flows, "flows"))
    discard(movements, now)
    kept = increments.stock_kept(stored, starts)
    return rows.unionByName(kept.withColumn("surrogate_key", surrogate_key("product_sku", "warehouse_id", "snapshot_date")))


@query("iot_incremental")
def _iot_incremental(b: Bed):
    """M-10 / A-04 / S-10: statistics merged from moments, days with moved groups scored again."""
    first, batch = _split(b, "iot", EVENTS_CUTOFF)
    readings = increments.latest_readings(first)
    moments = increments.day_moments(readings)
    stored = silver.iot_readings_validated(readings, b.events_settings, stats=increments.merged_stats(moments))
    change = increments.sensor_changes(stored, moments, batch)
    again = increments.rescored(increments.only(stored, change.days), batch, change.stats, b.events_settings)
    return increments.only(stored, change.days, "left_anti").unionByName(again)


@query("customer_snapshot")
def _customer_snapshot(b: Bed):
    """M-16 / S-11: history from two snapshots of the customers; the second lacks
    some, changes some and adds some."""
    ch = reports.customer_priority_changes(b.table("orders")).withColumn("_h", surrogate_key("priority_tier"))

    def at(t):
        seen = ch.where(F.col("updated_at") <= F.lit(t).cast("timestamp_ntz"))
        return dedup_latest(seen, "customer_id", "updated_at", ["_h"]).drop("updated_at", "_h")

    empty = at(SNAPSHOTS[0]).limit(0).selectExpr(
        "*", "CAST(NULL AS string) AS _change_hash", "CAST(NULL AS timestamp_ntz) AS valid_from", "CAST(NULL AS timestamp_ntz) AS valid_to")
    one = scd.scd2_step(empty, at(SNAPSHOTS[0]), "customer_id", ["priority_tier"], SNAPSHOTS[0])
    later = at(SNAPSHOTS[1]).where(~F.col("customer_id").endswith("7"))
    return scd.scd2_step(one.drop("is_current"), later, "customer_id", ["priority_tier"], SNAPSHOTS[1]).drop("_change_hash")


@query("customers_by_region")
def _by_region(b: Bed):
    """J-08: sessions per region through the broadcast countries seed."""
    return reports.sessions_by_region(b.sessions)


# ---------------------------------------------------------------- aggregates A-02…A-14
@query("rfm")
def _rfm(b: Bed):
    """A-02."""
    return gold.rfm(b.sales, b.sales_settings.as_of)


@query("iot_stats")
def _iot_stats(b: Bed):
    """A-04: per (sensor type, unit) mean (exact micro-unit average) and
    sample stddev rounded to 6."""
    return b.stg("iot").groupBy("sensor_type", "reading_unit").agg(
        micro_avg("reading_value").alias("mean_value"),
        F.round(F.stddev_samp("reading_value"), 6).alias("stddev_value"),
        F.count("reading_value").alias("n"))


@query("inventory_daily_flows")
def _inv_flows(b: Bed):
    """A-05."""
    return silver.inventory_daily_flows(b.stg("inventory"))


@query("daily_demand")
def _daily_demand(b: Bed):
    """A-06."""
    return gold.daily_demand(b.sales)


@query("iot_device_daily")
def _iot_device_daily(b: Bed):
    """A-07."""
    return gold.iot_device_daily(b.iot)


@query("web_funnel_flags")
def _funnel_flags(b: Bed):
    """A-08."""
    return gold.funnel_flags(b.stg("web_events"))


@query("freshness_check")
def _freshness(b: Bed):
    """A-10 / Q-02: newest row age per table, pass / warn / fail."""
    s, e = reports.end_of_day(b.sales_settings.as_of), reports.end_of_day(b.events_settings.as_of)
    return (quality.freshness(b.sales, "transaction_date", s, table="sales_transactions_cleaned")
            .unionByName(quality.freshness(b.stg("web_events"), "event_timestamp", e, table="web_events"))
            .unionByName(quality.freshness(b.iot, "reading_timestamp", e, table="iot_readings_validated")))


@query("iot_profile")
def _iot_profile(b: Bed):
    """A-11 / T-04."""
    return reports.iot_profile(b.iot)


@query("segment_distribution")
def _segments(b: Bed):
    """A-12: top-5 segments by size."""
    return reports.segment_distribution(b.customer_360)


@query("inventory_summary")
def _inv_summary(b: Bed):
    """A-13."""
    return reports.inventory_summary(b.inventory)


@query("duplicate_keys")
def _dupes(b: Bed):
    """A-14: bronze keys present more than once."""
    return duplicate_keys(b.stg("sales"), ["transaction_id", "transaction_date"])


@query("dq_trend")
def _dq_trend(b: Bed):
    """A-15 / F-26: JSON DQ reports (one per event day) → explode → trend."""
    runs = dq.daily_runs(b.stg("web_events"), b.iot)
    return quality.dq_trend(runs)


# ---------------------------------------------------------------- windows W-01…W-09
@query("dedup_latest")
def _dedup_latest(b: Bed):
    """W-01: latest staged row per transaction id (aggregate form)."""
    return dedup_latest(_drop_audit(b.stg("sales")), "transaction_id", "_loaded_at", SALES_TIEBREAK,
                        drop_null_keys=True)


@query("latest_inventory")
def _latest_inventory(b: Bed):
    """W-02."""
    return gold.latest_inventory(b.inventory)


@query("demand_ma30")
def _demand_ma30(b: Bed):
    """W-04."""
    return gold.demand_moving_average(b.sales)


@query("latest_demand")
def _latest_demand(b: Bed):
    """W-08."""
    return gold.latest_demand(b.sales)


@query("scd2_history")
def _scd2_history(b: Bed):
    """S-11 / W-09: customer priority history from the order stream."""
    ch = reports.customer_priority_changes(b.table("orders"))
    return scd.scd2_history(ch, "customer_id", "updated_at", ["priority_tier"]).drop("_change_hash")


@query("scd2_as_of")
def _scd2_as_of(b: Bed):
    """R-10: the version of every customer valid at a point in time."""
    ch = reports.customer_priority_changes(b.table("orders"))
    h = scd.scd2_history(ch, "customer_id", "updated_at", ["priority_tier"]).drop("_change_hash")
    return scd.as_of(h, SCD_AS_OF)


@query("snapshot_diff")
def _snapshot_diff(b: Bed):
    """R-09: change feed between the first load and the full silver table."""
    return diff.snapshot_diff(_first_load(b), _drop_audit(b.sales), "transaction_id", SALES_COMPARE)


# ---------------------------------------------------------------- top-k T-01, T-03
@query("top_customers")
def _top_customers(b: Bed):
    """T-01."""
    return reports.top_customers(b.customer_360)


@query("funnel_recent")
def _funnel_recent(b: Bed):
    """T-03."""
    return reports.funnel_recent(b.funnel, b.events_settings.as_of)


# ---------------------------------------------------------------- PII F-02…F-06
@query("pii_hash")
def _pii_hash(b: Bed):
    """F-02: salted hash, NULL in → NULL out."""
    return b.stg("customers").select("customer_id", salted_hash("email", b.sales_settings.salt).alias("email_hashed"))


@query("pii_mask_email")
def _pii_mask_email(b: Bed):
    """F-03."""
    return b.stg("customers").select("customer_id", mask_email("email").alias("email_masked"))


@query("pii_mask_phone")
def _pii_mask_phone(b: Bed):
    """F-04."""
    return b.stg("customers").select("customer_id", mask_phone("phone_number").alias("phone_masked"))


@query("pii_policy")
def _pii_policy(b: Bed):
    """F-05 / F-06: a policy map applied in one projection."""
    return apply_policy(_drop_audit(b.stg("customers")),
                        {"email": "hash", "phone_number": "mask_phone", "full_name": "null",
                         "address_line1": "drop", "date_of_birth": "keep"}, salt=b.sales_settings.salt)


@query("utm_attribution")
def _utm(b: Bed):
    """E-01 / F-11: sessions by landing utm_source."""
    s = silver.web_sessions_enriched(b.stg("web_events"), b.events_settings, with_utm=True)
    return reports.utm_attribution(s)


@query("sales_clean_fx")
def _sales_fx(b: Bed):
    """F-29 / E-05: USD amounts through a (currency, day) rate table.

    The staged rows are read twice and stored once (without what is a function of
    them); so is the rate table, whose size is then known to the join."""
    stg = cut(_drop_audit(b.stg("sales")).drop("surrogate_key"), "staged")
    rates = cut(reports.fx_rates_for(stg), "rates")
    return _drop_audit(silver.sales_transactions_cleaned(stg, b.sales_settings, fx_rates=rates))


# ---------------------------------------------------------------- data quality Q-01…Q-10
@query("null_ratio")
def _null_ratio(b: Bed):
    """Q-01: one aggregate per table over all columns."""
    return (quality.null_ratio(_drop_audit(b.sales), table="sales_transactions_cleaned")
            .unionByName(quality.null_ratio(b.customers, table="customers_cleaned")))


@query("layer_reconciliation")
def _layer_rec(b: Bed):
    """Q-04."""
    return dq.layer_reconciliation(b.stg("sales"), b.sales, b.daily_sales)


@query("customer_completeness")
def _completeness(b: Bed):
    """Q-05."""
    return dq.customer_completeness(b.customer_360)


@query("revenue_integrity")
def _revenue(b: Bed):
    """Q-06."""
    return dq.revenue_integrity(b.daily_sales, b.sales)


@query("outlier_rate")
def _outlier_rate(b: Bed):
    """Q-07."""
    return dq.outlier_rate(b.iot)


# The declared column tests.
NOT_NULL_TESTS = [  # (frame, column, model, key) — declared column tests
    ("stg:sales", "transaction_id", "stg_sales_transactions", "transaction_id"),
    ("stg:sales", "amount", "stg_sales_transactions", "transaction_id"),
    ("stg:sales", "transaction_date", "stg_sales_transactions", "transaction_id"),
    ("stg:customers", "customer_id", "stg_customer_profiles", "customer_id"),
    ("stg:inventory", "movement_id", "stg_inventory_movements", "movement_id"),
    ("stg:web_events", "event_id", "stg_web_events", "event_id"),
    ("stg:iot", "device_id", "stg_iot_readings", "device_id"),
    ("sales", "transaction_id", "sales_transactions_cleaned", "transaction_id"),
    ("sales", "surrogate_key", "sales_transactions_cleaned", "transaction_id"),
    ("customers", "customer_id", "customers_cleaned", "customer_id"),
    ("inventory", "snapshot_date", "inventory_snapshots", "surrogate_key"),
    ("inventory", "product_sku", "inventory_snapshots", "surrogate_key"),
    ("daily_sales", "sales_date", "daily_sales_summary", "store_id"),
    ("customer_360", "customer_id", "customer_360", "customer_id"),
    ("inventory_health", "product_sku", "inventory_health", "product_sku"),
]
UNIQUE_TESTS = [
    ("stg:sales", "transaction_id", "stg_sales_transactions"),
    ("stg:customers", "customer_id", "stg_customer_profiles"),
    ("stg:inventory", "movement_id", "stg_inventory_movements"),
    ("sales", "transaction_id", "sales_transactions_cleaned"),
    ("sales", "surrogate_key", "sales_transactions_cleaned"),
    ("customers", "customer_id", "customers_cleaned"),
    ("customer_360", "customer_id", "customer_360"),
]


def _frame(b: Bed, ref: str):
    return b.stg(ref[4:]) if ref.startswith("stg:") else getattr(b, ref)


@query("test_not_null")
def _test_not_null(b: Bed):
    """Q-08: violating rows of every declared not_null test."""
    groups: dict[tuple, list] = {}  # one pass per (frame, model, key)
    for f, c, m, k in NOT_NULL_TESTS:
        groups.setdefault((f, m, k), []).append(c)
    parts = [quality.not_null_violations_many(_frame(b, f), cs, m, k) for (f, m, k), cs in groups.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("test_unique")
def _test_unique(b: Bed):
    """Q-09: duplicated values of every declared unique test."""
    groups: dict[tuple, list] = {}  # one scan and one aggregate per (frame, model)
    for f, c, m in UNIQUE_TESTS:
        groups.setdefault((f, m), []).append(c)
    parts = [quality.unique_violations_many(_frame(b, f), cs, m) for (f, m), cs in groups.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("dq_report")
def _dq_report(b: Bed):
    """Q-10: check rows with the run's overall status.  The status window
    spans only the check rows (one per check, a fixed handful)."""
    from pyspark.sql import Window
    c = dq.checks(b)
    ok = F.min(F.col("passed").cast("int")).over(Window.partitionBy())
    return c.select("name", "passed", F.when(ok == 1, "PASSED").otherwise("FAILED").alias("overall_status"))


@query("dq_retention")
def _dq_retention(b: Bed):
    """S-16: DQ runs kept by a 7-day retention window at the events as-of."""
    runs = dq.daily_runs(b.stg("web_events"), b.iot)
    return quality.retention(runs, "run_ts", reports.end_of_day(b.events_settings.as_of), 168) \
        .select("run_ts", "overall_status")


# ---------------------------------------------------------------- declared extras E-02…E-08
@query("sensor_gaps")
def _sensor_gaps(b: Bed):
    """E-02."""
    return reports.sensor_gaps(b.iot)


@query("sensor_interpolation")
def _sensor_interp(b: Bed):
    """E-03."""
    return reports.sensor_interpolation(b.iot)


@query("inventory_fifo_cost")
def _fifo_cost(b: Bed):
    """E-04: daily stock per (sku, warehouse) valued first-in first-out."""
    return silver.inventory_fifo_snapshots(b.stg("inventory"), adapters.receipt_costs(b.spark, b.sf_dir))


@query("inventory_turnover")
def _turnover(b: Bed):
    """E-06."""
    return reports.inventory_turnover(b.inventory, b.sales)


@query("row_count_anomaly")
def _row_anomaly(b: Bed):
    """E-07."""
    return reports.row_count_anomaly(b.sales)


@query("monthly_sales_growth")
def _monthly(b: Bed):
    """E-08."""
    return reports.monthly_sales_growth(b.sales)
