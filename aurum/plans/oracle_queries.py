"""Oracle SQL per registered query name (DuckDB dialect)."""

from __future__ import annotations

from aurum.plans.oracle import sql

ORACLE: dict[str, str] = {}


def oracle(name: str, final: str, *ctes: str) -> None:
    ORACLE[name] = sql(final, *ctes)


# staging
oracle("stg_sales", "SELECT * FROM stg_sales", "stg_sales")
oracle("stg_customers", "SELECT * FROM stg_customers", "stg_customers")
oracle("stg_inventory", "SELECT * FROM stg_inventory", "stg_inventory")
oracle("stg_web_events", "SELECT * FROM stg_web", "stg_web")
oracle("stg_iot", "SELECT * FROM stg_iot", "stg_iot")

# silver
oracle("sales_clean", "SELECT * FROM silver_sales", "silver_sales")
oracle("customers_clean", "SELECT * FROM silver_customers", "silver_customers")
oracle("inventory_snapshots", "SELECT * FROM silver_inventory", "silver_inventory")
oracle("web_sessions", "SELECT * EXCLUDE (landing_page) FROM silver_sessions", "silver_sessions")
oracle("iot_validated", "SELECT * FROM silver_iot", "silver_iot")

# gold
oracle("daily_sales_summary", "SELECT * FROM gold_daily_sales", "gold_daily_sales")
oracle("customer_360", "SELECT * FROM gold_customer_360", "gold_customer_360")
oracle("inventory_health", "SELECT * FROM gold_inventory_health", "gold_inventory_health")
oracle("web_funnel", "SELECT * FROM gold_funnel", "gold_funnel")
oracle("iot_anomaly", "SELECT * FROM gold_iot", "gold_iot")

# ------------------------------------------------------------ widened set
from aurum.plans.oracle import (  # noqa: E402
    COMPARE, E_AS_OF, E_EOD, S_AS_OF, S_EOD, SCD_T, _micro_avg, _pct2, _ratio, _hash, _skey,
)

oracle("amount_clamp", "SELECT * FROM sales_unvalidated", "sales_unvalidated")
oracle("drop_pii", "SELECT customer_id, address_city, address_country, registration_date, loyalty_tier, "
       "surrogate_key, _loaded_at FROM stg_customers", "stg_customers")
oracle("iot_alerts", f"""
SELECT device_id, sensor_type, report_date, anomaly_rate_7d_pct, avg_battery_level, hours_since_last, last_reading,
       coalesce(anomaly_rate_7d_pct > 10.0, FALSE) AS high_anomaly, coalesce(avg_battery_level < 20.0, FALSE) AS low_battery,
       coalesce(hours_since_last > 24.0, FALSE) AS offline
FROM gold_iot WHERE report_date = {E_AS_OF}
  AND (coalesce(anomaly_rate_7d_pct > 10.0, FALSE) OR coalesce(avg_battery_level < 20.0, FALSE)
       OR coalesce(hours_since_last > 24.0, FALSE))""", "gold_iot")
oracle("iot_recent_outliers", f"""
SELECT device_id, reading_timestamp, reading_value_raw, z_score FROM silver_iot
WHERE sensor_type = 'view' AND is_outlier AND reading_date >= {E_AS_OF} - 7""", "silver_iot")
oracle("stockout_watch", """
SELECT product_sku, quantity_on_hand, days_on_hand, stockout_risk FROM gold_inventory_health
WHERE stockout_risk IN ('stocked_out', 'critical')""", "gold_inventory_health")
oracle("email_validity", """
SELECT customer_id, regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$') AS email_valid
FROM stg_customers""", "stg_customers")
oracle("customer_ltv", """
SELECT c.customer_id, c.email_hashed, c.country_code, c.loyalty_tier,
       CAST(coalesce(s.total_spend_usd, 0) AS DECIMAL(38,2)) AS lifetime_value_usd,
       CAST(coalesce(s.total_orders, 0) AS BIGINT) AS lifetime_orders,
       s.first_purchase_date, s.last_purchase_date, s.days_since_last_purchase,
       CASE WHEN coalesce(s.total_spend_usd, 0) > 10000 THEN 'platinum'
            WHEN coalesce(s.total_spend_usd, 0) > 5000 THEN 'gold'
            WHEN coalesce(s.total_spend_usd, 0) > 1000 THEN 'silver' ELSE 'bronze' END AS ltv_tier
FROM silver_customers c LEFT JOIN ltv_sales s ON c.email_hashed = s.customer_email_hashed""",
       "silver_customers", "ltv_sales")
oracle("upsert_merge", """
SELECT * FROM sales_first t WHERE NOT EXISTS (SELECT 1 FROM sales_next s WHERE s.transaction_id = t.transaction_id)
UNION ALL SELECT * FROM sales_next""", "sales_first", "sales_next")
oracle("upsert_partial", """
SELECT * FROM sales_first t WHERE NOT EXISTS (SELECT 1 FROM sales_next s WHERE s.transaction_id = t.transaction_id)
UNION ALL
SELECT t.transaction_id, t.store_id, t.product_sku, s.quantity, s.amount_local, t.currency, t.payment_method,
       t.transaction_date, t.customer_email_hashed, s.amount_usd, t.surrogate_key, t._loaded_at
FROM sales_first t JOIN sales_next s ON s.transaction_id = t.transaction_id
UNION ALL
SELECT * FROM sales_next s WHERE NOT EXISTS (SELECT 1 FROM sales_first t WHERE s.transaction_id = t.transaction_id)""",
       "sales_first", "sales_next")
oracle("upsert_insert_only", """
SELECT * FROM sales_first
UNION ALL
SELECT * FROM sales_next s WHERE NOT EXISTS (SELECT 1 FROM sales_first t WHERE s.transaction_id = t.transaction_id)""",
       "sales_first", "sales_next")
oracle("incremental_filter", "SELECT * FROM next_stg", "next_stg")
# an incremental run gives what a rebuild gives
oracle("sales_incremental", "SELECT * FROM silver_sales", "silver_sales")
oracle("sessions_incremental", "SELECT * EXCLUDE (landing_page) FROM silver_sessions", "silver_sessions")
oracle("inventory_incremental", "SELECT * FROM silver_inventory", "silver_inventory")
oracle("iot_incremental", "SELECT * FROM silver_iot", "silver_iot")


def _at(t):
    return f"""
  SELECT customer_id, priority_tier FROM (
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS priority_tier, row_number() OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate DESC, {_skey('o_orderpriority')} DESC) AS rn
    FROM orders WHERE CAST(o_orderdate AS TIMESTAMP) <= {t}) WHERE rn = 1"""


_S1, _S2 = "TIMESTAMP '1995-01-01 00:00:00'", "TIMESTAMP '1997-01-01 00:00:00'"
oracle("customer_snapshot", f"""
SELECT a.customer_id, a.priority_tier, {_S1} AS valid_from, CASE WHEN b.priority_tier = a.priority_tier THEN NULL ELSE {_S2} END AS valid_to,
       coalesce(b.priority_tier = a.priority_tier, FALSE) AS is_current
FROM ({_at(_S1)}) a LEFT JOIN (SELECT * FROM ({_at(_S2)}) WHERE NOT ends_with(customer_id, '7')) b ON a.customer_id = b.customer_id
UNION ALL
SELECT b.customer_id, b.priority_tier, {_S2}, NULL, TRUE
FROM ({_at(_S2)}) b LEFT JOIN ({_at(_S1)}) a ON a.customer_id = b.customer_id
WHERE NOT ends_with(b.customer_id, '7') AND a.priority_tier IS DISTINCT FROM b.priority_tier""")
oracle("customers_by_region", """
SELECT coalesce(r.region, 'unknown') AS region, count(*) AS sessions, count(DISTINCT s.user_id) AS users
FROM silver_sessions s LEFT JOIN seed_countries r ON s.country_code = r.country_code GROUP BY 1""",
       "silver_sessions", "seed_countries")
oracle("rfm", "SELECT * FROM rfm", "rfm")
oracle("iot_stats", f"""
SELECT sensor_type, reading_unit, {_micro_avg('reading_value')} AS mean_value,
       round(stddev_samp(reading_value), 6) AS stddev_value, count(reading_value) AS n
FROM stg_iot GROUP BY sensor_type, reading_unit""", "stg_iot")
oracle("inventory_daily_flows", "SELECT * FROM inv_flows", "inv_flows")
oracle("daily_demand", "SELECT * FROM daily_demand", "daily_demand")
oracle("iot_device_daily", "SELECT * FROM iot_daily", "iot_daily")
oracle("web_funnel_flags", "SELECT * FROM funnel_flags", "funnel_flags")


def _fresh(table, src, col, eod):
    age = f"(floor(epoch({eod})) - floor(epoch(max({col})))) / 3600.0"
    return (f"SELECT '{table}' AS table_name, max({col}) AS max_ts, {age} AS age_hours, "
            f"CASE WHEN max({col}) IS NULL THEN 'fail' WHEN {age} > 48 THEN 'fail' WHEN {age} > 24 THEN 'warn' "
            f"ELSE 'pass' END AS status FROM {src}")


oracle("freshness_check", " UNION ALL ".join([
    _fresh("sales_transactions_cleaned", "silver_sales", "transaction_date", S_EOD),
    _fresh("web_events", "stg_web", "event_timestamp", E_EOD),
    _fresh("iot_readings_validated", "silver_iot", "reading_timestamp", E_EOD)]),
    "silver_sales", "stg_web", "silver_iot")
oracle("iot_profile", """
SELECT count(*) AS readings, count(DISTINCT device_id) AS devices, count(DISTINCT sensor_type) AS sensor_types
FROM silver_iot""", "silver_iot")
oracle("segment_distribution", """
SELECT customer_segment, count(*) AS customers FROM gold_customer_360 GROUP BY 1
ORDER BY customers DESC, customer_segment ASC LIMIT 5""", "gold_customer_360")
oracle("inventory_summary", f"""
SELECT product_sku, max(CASE WHEN rn = 1 THEN quantity_on_hand END) AS current_stock,
       {_ratio('sum(outbound_qty)', 'count(outbound_qty)')} AS avg_daily_demand
FROM (SELECT *, row_number() OVER (PARTITION BY product_sku ORDER BY snapshot_date DESC, warehouse_id DESC) AS rn
      FROM silver_inventory) GROUP BY product_sku""", "silver_inventory")
oracle("duplicate_keys", """
SELECT transaction_id, transaction_date, count(*) AS copies FROM stg_sales GROUP BY 1, 2 HAVING count(*) > 1""",
       "stg_sales")
oracle("dq_trend", """
SELECT d AS run_date, check_name, CAST(sum(CASE WHEN passed THEN 0 ELSE 1 END) AS BIGINT) AS failure_count,
       count(*) AS total_runs,
       CAST((sum(CASE WHEN passed THEN 0 ELSE 1 END) * 2000 + count(*)) // (2 * count(*)) AS DOUBLE) / 10
         AS failure_rate_pct
FROM day_checks GROUP BY 1, 2""", "day_checks")
oracle("dedup_latest", "SELECT * FROM sales_latest", "sales_latest")
oracle("latest_inventory", "SELECT * FROM latest_inv", "latest_inv")
oracle("demand_ma30", "SELECT * FROM demand_ma", "demand_ma")
oracle("latest_demand", "SELECT * FROM latest_demand", "latest_demand")
oracle("scd2_history", "SELECT * FROM scd2", "scd2")
oracle("scd2_as_of", f"""
SELECT * FROM scd2 WHERE valid_from <= {SCD_T} AND (valid_to IS NULL OR valid_to > {SCD_T})""", "scd2")
_vals_o = ", ".join(f"o.{c}" for c in COMPARE)
_vals_n = ", ".join(f"n.{c}" for c in COMPARE)
_changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in COMPARE)
oracle("snapshot_diff", f"""
SELECT n.transaction_id, {_vals_n}, 'insert' AS _change_type FROM silver_sales n
  WHERE NOT EXISTS (SELECT 1 FROM sales_first o WHERE o.transaction_id = n.transaction_id)
UNION ALL SELECT o.transaction_id, {_vals_o}, 'delete' FROM sales_first o
  WHERE NOT EXISTS (SELECT 1 FROM silver_sales n WHERE o.transaction_id = n.transaction_id)
UNION ALL SELECT o.transaction_id, {_vals_o}, 'update_preimage' FROM sales_first o
  JOIN silver_sales n ON o.transaction_id = n.transaction_id WHERE {_changed}
UNION ALL SELECT n.transaction_id, {_vals_n}, 'update_postimage' FROM sales_first o
  JOIN silver_sales n ON o.transaction_id = n.transaction_id WHERE {_changed}""", "silver_sales", "sales_first")
oracle("top_customers", """
SELECT customer_id, lifetime_value, customer_segment FROM gold_customer_360
WHERE customer_segment <> 'never_purchased' ORDER BY lifetime_value DESC, customer_id ASC LIMIT 10""",
       "gold_customer_360")
oracle("funnel_recent", f"""
SELECT funnel_date, country_code, device_type, overall_conversion_pct, purchase_rate_pct FROM gold_funnel
WHERE funnel_date >= {E_AS_OF} - 7""", "gold_funnel")
oracle("pii_hash", f"SELECT customer_id, {_hash('email')} AS email_hashed FROM stg_customers", "stg_customers")
_EM = "'^([^@]{2})[^@]*@([^@])[^@]*(\\.[^.@]+)$'"
oracle("pii_mask_email", f"""
SELECT customer_id, CASE WHEN regexp_matches(email, {_EM}) THEN regexp_replace(email, {_EM}, '\\1***@\\2***\\3')
                         ELSE repeat('*', length(email)) END AS email_masked
FROM stg_customers""", "stg_customers")
oracle("pii_mask_phone", "SELECT customer_id, phone_masked FROM silver_customers", "silver_customers")
oracle("pii_policy", f"""
SELECT customer_id, {_hash('email')} AS email, CAST(NULL AS VARCHAR) AS full_name,
       CASE WHEN regexp_matches(phone_number, '(\\+?\\d{{2,3}})\\d{{6,}}(\\d{{2}})')
            THEN regexp_replace(phone_number, '(\\+?\\d{{2,3}})\\d{{6,}}(\\d{{2}})', '\\1******\\2')
            ELSE repeat('*', length(phone_number)) END AS phone_number,
       date_of_birth, address_city, address_country, registration_date, loyalty_tier, surrogate_key, _loaded_at
FROM stg_customers""", "stg_customers")
oracle("utm_attribution", """
SELECT event_date, NULLIF(regexp_extract(landing_page, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
       count(*) AS sessions, count(CASE WHEN purchases > 0 THEN 1 END) AS buying_sessions
FROM silver_sessions GROUP BY 1, 2""", "silver_sessions")
oracle("sales_clean_fx", """
SELECT s.transaction_id, s.store_id, s.product_sku, s.quantity, s.amount_local, s.currency, s.payment_method,
       s.transaction_date, s.customer_email_hashed,
       CASE WHEN s.currency = 'USD' THEN s.amount_local
            ELSE CAST(s.amount_local * r.usd_rate AS DECIMAL(18,2)) END AS amount_usd,
       s.surrogate_key, s._loaded_at
FROM silver_sales s LEFT JOIN fx_rates r ON s.currency = r.currency AND CAST(s.transaction_date AS DATE) = r.rate_date""",
       "silver_sales", "fx_rates")
oracle("null_ratio", "SELECT * FROM null_ratio", "null_ratio")
oracle("layer_reconciliation", "SELECT * FROM layer_rec", "layer_rec")
oracle("customer_completeness", "SELECT * FROM completeness", "completeness")
oracle("revenue_integrity", "SELECT * FROM revenue", "revenue")
oracle("outlier_rate", "SELECT * FROM outliers", "outliers")

_NN = [("stg_sales", "transaction_id", "stg_sales_transactions", "transaction_id"),
       ("stg_sales", "amount", "stg_sales_transactions", "transaction_id"),
       ("stg_sales", "transaction_date", "stg_sales_transactions", "transaction_id"),
       ("stg_customers", "customer_id", "stg_customer_profiles", "customer_id"),
       ("stg_inventory", "movement_id", "stg_inventory_movements", "movement_id"),
       ("stg_web", "event_id", "stg_web_events", "event_id"),
       ("stg_iot", "device_id", "stg_iot_readings", "device_id"),
       ("silver_sales", "transaction_id", "sales_transactions_cleaned", "transaction_id"),
       ("silver_sales", "surrogate_key", "sales_transactions_cleaned", "transaction_id"),
       ("silver_customers", "customer_id", "customers_cleaned", "customer_id"),
       ("silver_inventory", "snapshot_date", "inventory_snapshots", "surrogate_key"),
       ("silver_inventory", "product_sku", "inventory_snapshots", "surrogate_key"),
       ("gold_daily_sales", "sales_date", "daily_sales_summary", "store_id"),
       ("gold_customer_360", "customer_id", "customer_360", "customer_id"),
       ("gold_inventory_health", "product_sku", "inventory_health", "product_sku")]
oracle("test_not_null", " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, CAST({k} AS VARCHAR) AS row_key FROM {t} WHERE {c} IS NULL"
    for t, c, m, k in _NN), *sorted({t for t, *_ in _NN}))
_UQ = [("stg_sales", "transaction_id", "stg_sales_transactions"),
       ("stg_customers", "customer_id", "stg_customer_profiles"),
       ("stg_inventory", "movement_id", "stg_inventory_movements"),
       ("silver_sales", "transaction_id", "sales_transactions_cleaned"),
       ("silver_sales", "surrogate_key", "sales_transactions_cleaned"),
       ("silver_customers", "customer_id", "customers_cleaned"),
       ("gold_customer_360", "customer_id", "customer_360")]
oracle("test_unique", " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS copies "
    f"FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1" for t, c, m in _UQ),
    *sorted({t for t, *_ in _UQ}))
oracle("dq_report", """
SELECT name, passed, CASE WHEN bool_and(passed) OVER () THEN 'PASSED' ELSE 'FAILED' END AS overall_status
FROM dq_checks""", "dq_checks")
oracle("dq_retention", f"""
SELECT CAST(d AS TIMESTAMP) + INTERVAL '23 hours 59 minutes 59 seconds' AS run_ts,
       CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END AS overall_status
FROM day_checks GROUP BY d
HAVING CAST(d AS TIMESTAMP) + INTERVAL '23 hours 59 minutes 59 seconds' >= {E_EOD} - INTERVAL '168 hours'""",
       "day_checks")
oracle("sensor_gaps", """
SELECT * FROM (
  SELECT device_id, sensor_type, previous_reading, reading_timestamp,
         (floor(epoch(reading_timestamp)) - floor(epoch(previous_reading))) / 3600.0 AS gap_hours
  FROM (SELECT device_id, sensor_type, reading_timestamp,
               lag(reading_timestamp) OVER (PARTITION BY device_id, sensor_type
                                            ORDER BY reading_timestamp, surrogate_key) AS previous_reading
        FROM silver_iot)) WHERE gap_hours > 24""", "silver_iot")
oracle("sensor_interpolation", """
SELECT device_id, sensor_type, reading_timestamp, reading_value_raw,
       round(CASE WHEN p_t IS NOT NULL AND n_t IS NOT NULL AND n_t <> p_t
                  THEN p_v + (n_v - p_v) * (CAST(t - p_t AS DOUBLE) / CAST(n_t - p_t AS DOUBLE))
                  WHEN p_t IS NOT NULL THEN p_v ELSE n_v END, 6) AS interpolated_value
FROM (SELECT *, epoch_us(reading_timestamp) AS t,
        last_value(CASE WHEN reading_value_validated IS NOT NULL THEN epoch_us(reading_timestamp) END IGNORE NULLS)
          OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p_t,
        last_value(reading_value_validated IGNORE NULLS)
          OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p_v,
        first_value(CASE WHEN reading_value_validated IS NOT NULL THEN epoch_us(reading_timestamp) END IGNORE NULLS)
          OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n_t,
        first_value(reading_value_validated IGNORE NULLS)
          OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n_v
      FROM silver_iot WINDOW w AS (PARTITION BY device_id, sensor_type ORDER BY reading_timestamp, surrogate_key))
WHERE reading_value_validated IS NULL AND is_outlier""", "silver_iot")
oracle("inventory_turnover", f"""
SELECT st.product_sku, coalesce(so.units_sold, 0) AS units_sold, {_ratio('st.s', 'st.n')} AS avg_stock,
       {_ratio('coalesce(so.units_sold, 0) * st.n', 'st.s')} AS turnover
FROM (SELECT product_sku, sum(quantity_on_hand) AS s, count(quantity_on_hand) AS n
      FROM silver_inventory GROUP BY 1) st
LEFT JOIN (SELECT product_sku, CAST(sum(quantity) AS BIGINT) AS units_sold FROM silver_sales GROUP BY 1) so
  ON st.product_sku = so.product_sku""", "silver_inventory", "silver_sales")
oracle("row_count_anomaly", """
SELECT sales_date, row_count, z_score, coalesce(abs(z_score) > 3.0, FALSE) AS is_anomaly
FROM (SELECT sales_date, row_count,
             round(CASE WHEN stddev_samp(row_count) OVER w > 0
                        THEN (row_count - avg(row_count) OVER w) / stddev_samp(row_count) OVER w END, 6) AS z_score
      FROM (SELECT CAST(transaction_date AS DATE) AS sales_date, count(*) AS row_count FROM silver_sales GROUP BY 1)
      WINDOW w AS (ORDER BY sales_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""", "silver_sales")
oracle("monthly_sales_growth", f"""
SELECT sales_month, store_id, currency, revenue_usd,
       CASE WHEN lag(revenue_usd) OVER w > 0 AND date_diff('month', lag(sales_month) OVER w, sales_month) = 1
            THEN {_ratio('revenue_usd - lag(revenue_usd) OVER w', 'lag(revenue_usd) OVER w')} END AS mom_growth
FROM (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS sales_month, store_id, currency,
             CAST(sum(amount_usd) AS DECIMAL(38,2)) AS revenue_usd FROM silver_sales GROUP BY 1, 2, 3)
WINDOW w AS (PARTITION BY store_id, currency ORDER BY sales_month)""", "silver_sales")

# declared E-04
oracle("inventory_fifo_cost", "SELECT * FROM silver_inventory_fifo", "silver_inventory_fifo")
