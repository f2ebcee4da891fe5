"""Independent DuckDB SQL for every registered query (the correctness gate).

Written directly in SQL from the model semantics — it shares no code with
the Spark plans.  Common layers are CTEs; ``sql(final, *ctes)`` prepends the
CTEs a query needs (with their dependencies) in order.
"""

# Fixed values in the SQL below: declared cut-offs, labels and column lists.
from __future__ import annotations

from aurum.config import EVENTS_AS_OF, SALES_AS_OF, TEST_SALT

SALT = TEST_SALT
S_AS_OF = f"DATE '{SALES_AS_OF.isoformat()}'"
E_AS_OF = f"DATE '{EVENTS_AS_OF.isoformat()}'"


def _email(k: str) -> str:
    return (f"CASE WHEN {k} % 50 = 0 THEN NULL WHEN {k} % 37 = 0 THEN 'user' || CAST({k} AS VARCHAR) || "
            f"'.example.com' ELSE 'user' || CAST({k} AS VARCHAR) || '@example.com' END")


def _qty(pk: str, q: str) -> str:
    return (f"CAST(CASE {pk} % 3 WHEN 0 THEN ceil({q} / 10) WHEN 1 THEN {q} ELSE {q} * 5 END AS INTEGER)")


def _hash(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE sha256(concat_ws('|', '{SALT}', lower(trim({c})))) END"


def _skey(*cols) -> str:
    return "sha256(concat_ws('|', " + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '_null_')" for c in cols) + "))"


def _ratio(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / CAST(NULLIF({d}, 0) AS DOUBLE))"


def _pct2(n: str, d: str) -> str:
    # exact HALF_UP of n*100/d at two decimals, via integer arithmetic
    return (f"(CAST((CAST({n} AS BIGINT) * 20000 + NULLIF({d}, 0)) // (2 * NULLIF({d}, 0)) AS DOUBLE) / 100)")


def _micro_avg(c: str) -> str:
    m = f"CAST(round({c} * 1e6) AS BIGINT)"
    return f"(CAST(sum({m}) AS DOUBLE) / CAST(count({m}) AS DOUBLE) / 1e6)"


CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTE[name] = (deps, body)


# ---------------------------------------------------------------- feeds
cte("sales_feed", (), f"""
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
       'STORE-' || CAST(s.s_nationkey AS VARCHAR) AS store_id,
       'SKU-' || CAST(l.l_partkey AS VARCHAR) AS product_sku,
       {_qty('l.l_partkey', 'l.l_quantity')} AS quantity,
       CASE WHEN NOT (l.l_linenumber = 6 AND l.l_partkey % 53 = 0)
            THEN CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(0.002 AS DECIMAL(4,3)) AS DECIMAL(18,2)) END AS amount,
       CASE r.r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR' ELSE 'XOF' END AS currency,
       o.o_orderpriority AS payment_method,
       {_email('o.o_custkey')} AS customer_email,
       CAST(o.o_orderdate AS TIMESTAMP) AS transaction_date,
       CAST(l.l_shipdate AS TIMESTAMP) AS _ingested_at
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("sales_feed2", ("sales_feed",), """
SELECT transaction_id, store_id, product_sku, quantity,
       CAST(CAST((CAST(amount * 100 AS BIGINT) * 2 + quantity) // (2 * NULLIF(quantity, 0)) AS DECIMAL(18,0))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS unit_price,
       amount, currency, payment_method, customer_email, transaction_date, _ingested_at
FROM sales_feed""")

cte("customers_feed", (), f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
       {_email('c.c_custkey')} AS email,
       '  ' || lower(c.c_name) || '  ' AS full_name,
       '+1' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS phone_number,
       CASE WHEN c.c_custkey % 41 = 0 THEN NULL
            ELSE CAST(DATE '1950-01-01' + CAST((c.c_custkey * 37) % 20000 AS INTEGER) AS DATE) END AS date_of_birth,
       CAST(c.c_custkey AS VARCHAR) || ' Market Street' AS address_line1,
       'CITY-' || CAST(c.c_custkey % 100 AS VARCHAR) AS address_city,
       lower(n.n_name) AS address_country,
       CAST(DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS registration_date,
       c.c_mktsegment AS loyalty_tier,
       CAST(CAST(DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS TIMESTAMP) AS _ingested_at
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("inventory_feed", (), f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS movement_id,
       'SKU-' || CAST(l_partkey AS VARCHAR) AS product_sku,
       'WH-' || CAST(l_suppkey % 2 AS VARCHAR) AS warehouse_id,
       CAST(CASE WHEN l_returnflag = 'N' OR (l_returnflag = 'A' AND l_linestatus = 'O')
                 THEN {_qty('l_partkey', 'l_quantity')} * CAST(l_partkey % 40 + 1 AS INTEGER)
                 ELSE {_qty('l_partkey', 'l_quantity')} END AS INTEGER) AS quantity,
       CASE WHEN l_returnflag = 'N' THEN 'INBOUND' WHEN l_returnflag = 'R' THEN 'OUTBOUND'
            WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'ADJUSTMENT+'
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'TRANSFER' END AS movement_type,
       CAST(l_shipdate AS TIMESTAMP) AS movement_date,
       CAST(l_orderkey AS VARCHAR) AS reference_order_id,
       CAST(l_shipdate AS TIMESTAMP) AS _ingested_at
FROM lineitem""")

cte("web_feed", (), """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
       CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view'
            WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'checkout'
            WHEN 'purchase' THEN 'purchase' END AS event_type,
       'https://shop.example.com/p/' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR)
         || '?utm_source=' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS VARCHAR) AS page_url,
       'https://ref' || CAST(event_id % 5 AS VARCHAR) || '.example.org/' AS referrer_url,
       (['desktop', 'mobile', 'tablet'])[CAST(user_id % 3 AS INTEGER) + 1] AS device_type,
       CASE WHEN user_id % 17 = 0 THEN NULL
            ELSE (['chrome', 'firefox', 'safari', 'edge'])[CAST(user_id % 4 AS INTEGER) + 1] END AS browser,
       (['SN', 'CI', 'ML', 'BF', 'FR', 'US', 'GB', 'DE', 'CA', 'NG'])[CAST(user_id % 10 AS INTEGER) + 1] AS country_code,
       CAST(ts AS TIMESTAMP) AS event_timestamp,
       CAST(ts AS TIMESTAMP) AS _ingested_at
FROM events""")

cte("iot_feed", (), """
SELECT CASE WHEN event_id % 101 <> 0 THEN 'DEV-' || CAST(user_id AS VARCHAR) END AS device_id, event_type AS sensor_type,
       CAST(value AS DOUBLE) AS reading_value, CASE WHEN user_id % 2 = 0 THEN 'unit' ELSE 'unit2' END AS reading_unit,
       CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS battery_level,
       'fw-1.0' AS firmware_version, CAST(ts AS TIMESTAMP) AS reading_timestamp,
       CAST(ts AS TIMESTAMP) AS _ingested_at
FROM events""")

# -------------------------------------------------------------- staging
cte("stg_sales", ("sales_feed2",), f"""
SELECT transaction_id, store_id, product_sku, quantity, unit_price, amount, currency, payment_method,
       customer_email, transaction_date, {_skey('transaction_id', 'transaction_date')} AS surrogate_key,
       _ingested_at AS _loaded_at
FROM sales_feed2 WHERE transaction_date IS NOT NULL""")

cte("stg_customers", ("customers_feed",), f"""
SELECT customer_id, email, full_name, phone_number, date_of_birth, address_line1, address_city,
       address_country, registration_date, loyalty_tier, {_skey('customer_id')} AS surrogate_key,
       _ingested_at AS _loaded_at
FROM customers_feed""")

cte("stg_inventory", ("inventory_feed",), f"""
SELECT movement_id, product_sku, warehouse_id, quantity, movement_type, movement_date, reference_order_id,
       {_skey('movement_id')} AS surrogate_key, _ingested_at AS _loaded_at
FROM inventory_feed""")

cte("stg_web", ("web_feed",), f"""
SELECT event_id, session_id, user_id, event_type, page_url, referrer_url, device_type, browser, country_code,
       event_timestamp, regexp_extract(page_url, '\\?([^#]*)', 1) AS page_query_string,
       {_skey('event_id', 'event_timestamp')} AS surrogate_key, _ingested_at AS _loaded_at
FROM web_feed""")

cte("stg_iot", ("iot_feed",), f"""
SELECT device_id, sensor_type, reading_value, reading_unit, battery_level, firmware_version, reading_timestamp,
       {_skey('device_id', 'reading_timestamp', 'sensor_type')} AS surrogate_key, _ingested_at AS _loaded_at
FROM iot_feed""")

# --------------------------------------------------------------- silver
cte("sales_latest", ("stg_sales",), """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _loaded_at DESC NULLS LAST,
      transaction_date DESC NULLS LAST, store_id DESC NULLS LAST, product_sku DESC NULLS LAST,
      quantity DESC NULLS LAST, unit_price DESC NULLS LAST, amount DESC NULLS LAST,
      currency DESC NULLS LAST, payment_method DESC NULLS LAST, customer_email DESC NULLS LAST) AS rn
  FROM stg_sales WHERE transaction_id IS NOT NULL) WHERE rn = 1""")

cte("silver_sales", ("sales_latest",), f"""
SELECT transaction_id, store_id, product_sku, quantity, amount AS amount_local, currency, payment_method,
       transaction_date, {_hash('customer_email')} AS customer_email_hashed, amount AS amount_usd,
       surrogate_key, _loaded_at
FROM sales_latest WHERE amount > 0 AND quantity > 0""")

AGE = (f"(year({S_AS_OF}) - year(date_of_birth) - CASE WHEN month({S_AS_OF}) * 100 + day({S_AS_OF}) "
       f"< month(date_of_birth) * 100 + day(date_of_birth) THEN 1 ELSE 0 END)")

cte("silver_customers", ("stg_customers",), f"""
SELECT customer_id,
       upper(substr(trim(full_name), 1, 1)) || lower(substr(trim(full_name), 2)) AS full_name_clean,
       CASE WHEN regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$')
            THEN {_hash('email')} END AS email_hashed,
       CASE WHEN regexp_matches(phone_number, '(\\+?\\d{{2,3}})\\d{{6,}}(\\d{{2}})')
            THEN regexp_replace(phone_number, '(\\+?\\d{{2,3}})\\d{{6,}}(\\d{{2}})', '\\1******\\2')
            ELSE repeat('*', length(phone_number)) END AS phone_masked,
       date_of_birth, address_city, upper(address_country) AS country_code, registration_date, loyalty_tier,
       CASE WHEN date_of_birth IS NULL THEN 'unknown' WHEN {AGE} < 18 THEN 'under_18'
            WHEN {AGE} < 25 THEN '18_24' WHEN {AGE} < 35 THEN '25_34' WHEN {AGE} < 45 THEN '35_44'
            WHEN {AGE} < 55 THEN '45_54' WHEN {AGE} < 65 THEN '55_64' ELSE '65_plus' END AS age_bucket,
       surrogate_key, _loaded_at
FROM stg_customers""")

cte("inv_latest", ("stg_inventory",), """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY movement_id ORDER BY _loaded_at DESC NULLS LAST,
      movement_date DESC NULLS LAST, product_sku DESC NULLS LAST, warehouse_id DESC NULLS LAST,
      movement_type DESC NULLS LAST, quantity DESC NULLS LAST) AS rn
  FROM stg_inventory) WHERE rn = 1""")

cte("inv_flows", ("inv_latest",), """
SELECT CAST(movement_date AS DATE) AS movement_date, product_sku, warehouse_id,
       CAST(sum(CASE WHEN movement_type IN ('INBOUND', 'ADJUSTMENT+') OR (movement_type = 'ADJUSTMENT' AND quantity > 0)
                     THEN quantity ELSE 0 END) AS BIGINT) AS inbound_qty,
       CAST(sum(CASE WHEN movement_type IN ('OUTBOUND', 'ADJUSTMENT-') THEN quantity
                     WHEN movement_type = 'ADJUSTMENT' AND quantity < 0 THEN -quantity ELSE 0 END) AS BIGINT) AS outbound_qty,
       CAST(sum(CASE WHEN movement_type = 'TRANSFER' THEN quantity ELSE 0 END) AS BIGINT) AS transfer_qty,
       max(_loaded_at) AS _loaded_at
FROM inv_latest GROUP BY 1, 2, 3""")

cte("silver_inventory", ("inv_flows",), f"""
SELECT movement_date AS snapshot_date, product_sku, warehouse_id,
       CAST(sum(inbound_qty - outbound_qty) OVER (PARTITION BY product_sku, warehouse_id ORDER BY movement_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS quantity_on_hand,
       inbound_qty, outbound_qty, transfer_qty,
       {_skey('product_sku', 'warehouse_id', 'movement_date')} AS surrogate_key, _loaded_at
FROM inv_flows""")

cte("session_first", ("stg_web",), """
SELECT * EXCLUDE (rn) FROM (
  SELECT session_id, user_id, device_type, browser, country_code, referrer_url, page_url,
         row_number() OVER (PARTITION BY session_id, user_id ORDER BY event_timestamp, event_id) AS rn
  FROM stg_web) WHERE rn = 1""")

cte("session_agg", ("stg_web",), """
SELECT session_id, user_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
       CAST(floor(epoch(max(event_timestamp))) - floor(epoch(min(event_timestamp))) AS BIGINT) AS session_duration_seconds,
       count(DISTINCT CASE WHEN event_type = 'page_view' THEN page_url END) AS pages_viewed,
       count(DISTINCT CASE WHEN event_type = 'purchase' THEN page_url END) AS purchases,
       count(DISTINCT event_type) AS distinct_event_types,
       min(CAST(event_timestamp AS DATE)) AS event_date, count(*) AS n_events, max(_loaded_at) AS _loaded_at
FROM stg_web GROUP BY session_id, user_id""")

cte("sessions_all", ("session_agg", "session_first"), """
SELECT a.session_id, a.user_id, a.session_start, a.session_end, a.session_duration_seconds, a.pages_viewed,
       a.purchases, a.distinct_event_types, f.device_type, f.browser, f.country_code,
       f.referrer_url AS landing_referrer, a.event_date,
       ((a.session_duration_seconds = 0 AND a.n_events > 50)
        OR (a.session_duration_seconds > 0 AND CAST(a.n_events AS DOUBLE) > 10.0 * CAST(a.session_duration_seconds AS DOUBLE))
        OR f.browser IS NULL) AS is_bot,
       f.page_url AS landing_page, a._loaded_at
FROM session_agg a JOIN session_first f ON a.session_id = f.session_id AND a.user_id IS NOT DISTINCT FROM f.user_id""")

cte("silver_sessions", ("sessions_all",), "SELECT * FROM sessions_all WHERE NOT is_bot")

cte("iot_stats", ("stg_iot",), """
SELECT sensor_type, reading_unit, avg(reading_value) AS mean_value, stddev_samp(reading_value) AS stddev_value,
       count(reading_value) AS n
FROM stg_iot GROUP BY sensor_type, reading_unit""")

cte("silver_iot", ("stg_iot", "iot_stats"), """
SELECT r.device_id, r.sensor_type, r.reading_value AS reading_value_raw, r.reading_unit, r.battery_level,
       r.firmware_version, r.reading_timestamp, CAST(r.reading_timestamp AS DATE) AS reading_date,
       CASE WHEN s.stddev_value IS NULL OR s.stddev_value = 0 THEN r.reading_value
            WHEN abs(r.reading_value - s.mean_value) > 3 * s.stddev_value THEN NULL
            ELSE r.reading_value END AS reading_value_validated,
       coalesce(s.stddev_value > 0 AND abs(r.reading_value - s.mean_value) > 3 * s.stddev_value, FALSE) AS is_outlier,
       round(CASE WHEN s.stddev_value > 0 THEN (r.reading_value - s.mean_value) / s.stddev_value ELSE 0 END, 6) AS z_score,
       r.surrogate_key, r._loaded_at
FROM stg_iot r LEFT JOIN iot_stats s ON r.sensor_type = s.sensor_type AND r.reading_unit = s.reading_unit""")

# ----------------------------------------------------------------- gold
cte("gold_daily_sales", ("silver_sales",), f"""
SELECT *, CASE WHEN lag(total_revenue_usd) OVER w > 0
               THEN {_ratio('total_revenue_usd - lag(total_revenue_usd) OVER w', 'lag(total_revenue_usd) OVER w')}
          END AS mom_revenue_growth
FROM (SELECT CAST(transaction_date AS DATE) AS sales_date, store_id, currency,
             count(DISTINCT transaction_id) AS order_count,
             count(DISTINCT customer_email_hashed) AS unique_customers,
             CAST(sum(amount_local) AS DECIMAL(38,2)) AS total_revenue_local,
             CAST(sum(amount_usd) AS DECIMAL(38,2)) AS total_revenue_usd,
             {_ratio('sum(amount_local)', 'count(amount_local)')} AS avg_order_value_local,
             {_ratio('sum(amount_usd)', 'count(amount_usd)')} AS avg_order_value_usd,
             CAST(sum(quantity) AS BIGINT) AS items_sold
      FROM silver_sales GROUP BY 1, 2, 3) g
WINDOW w AS (PARTITION BY store_id, currency ORDER BY sales_date)""")

cte("rfm", ("silver_sales",), f"""
SELECT customer_email_hashed, max(transaction_date) AS last_purchase_date,
       count(DISTINCT transaction_id) AS frequency, CAST(sum(amount_usd) AS DECIMAL(38,2)) AS monetary,
       min(transaction_date) AS first_purchase_date,
       CAST(datediff('day', CAST(max(transaction_date) AS DATE), {S_AS_OF}) AS INTEGER) AS recency_days
FROM silver_sales WHERE customer_email_hashed IS NOT NULL GROUP BY customer_email_hashed""")

cte("gold_customer_360", ("silver_customers", "rfm"), f"""
SELECT c.customer_id, c.email_hashed, c.country_code, c.registration_date, c.loyalty_tier, c.age_bucket,
       coalesce(r.first_purchase_date, CAST(c.registration_date AS TIMESTAMP)) AS first_purchase_date,
       coalesce(r.last_purchase_date, CAST(c.registration_date AS TIMESTAMP)) AS last_purchase_date,
       coalesce(r.recency_days, 9999) AS recency_days,
       CAST(coalesce(r.frequency, 0) AS BIGINT) AS lifetime_orders,
       CAST(coalesce(r.monetary, 0) AS DECIMAL(38,2)) AS lifetime_value,
       CASE WHEN r.monetary IS NULL THEN 'never_purchased'
            WHEN r.monetary > 1000 AND r.frequency > 10 AND r.recency_days < 30 THEN 'champion'
            WHEN r.monetary > 500 AND r.frequency > 5 AND r.recency_days < 60 THEN 'loyal'
            WHEN r.recency_days < 30 THEN 'new_active'
            WHEN r.recency_days BETWEEN 30 AND 90 THEN 'at_risk'
            WHEN r.recency_days > 90 THEN 'lapsed' ELSE 'needs_attention' END AS customer_segment,
       CASE WHEN r.monetary IS NULL THEN 0 WHEN r.recency_days > 90 THEN 90 WHEN r.recency_days > 60 THEN 70
            WHEN r.recency_days > 30 THEN 40 WHEN r.recency_days > 14 THEN 20 ELSE 5 END AS churn_risk_score,
       CASE WHEN r.frequency > 0 THEN {_ratio('r.monetary', 'r.frequency')} ELSE 0.0 END AS avg_order_value
FROM silver_customers c LEFT JOIN rfm r ON c.email_hashed = r.customer_email_hashed""")

cte("daily_demand", ("silver_sales",), """
SELECT product_sku, CAST(transaction_date AS DATE) AS sale_date, CAST(sum(quantity) AS BIGINT) AS daily_quantity_sold
FROM silver_sales GROUP BY 1, 2""")

cte("demand_ma", ("daily_demand",), f"""
SELECT product_sku, sale_date, daily_quantity_sold,
       {_ratio('sum(daily_quantity_sold) OVER w', 'count(daily_quantity_sold) OVER w')} AS avg_daily_demand_30d
FROM daily_demand
WINDOW w AS (PARTITION BY product_sku ORDER BY sale_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")

cte("latest_demand", ("demand_ma",), """
SELECT product_sku, avg_daily_demand_30d FROM (
  SELECT *, row_number() OVER (PARTITION BY product_sku ORDER BY sale_date DESC) AS rn FROM demand_ma) WHERE rn = 1""")

cte("latest_inv", ("silver_inventory",), """
SELECT snapshot_date, product_sku, warehouse_id, quantity_on_hand, inbound_qty, outbound_qty FROM (
  SELECT *, row_number() OVER (PARTITION BY product_sku ORDER BY snapshot_date DESC, warehouse_id DESC,
         quantity_on_hand DESC, inbound_qty DESC, outbound_qty DESC) AS rn
  FROM silver_inventory WHERE quantity_on_hand >= 0) WHERE rn = 1""")

cte("gold_inventory_health", ("latest_inv", "latest_demand"), """
SELECT li.snapshot_date, li.product_sku, li.warehouse_id, li.quantity_on_hand, li.inbound_qty, li.outbound_qty,
       coalesce(ma.avg_daily_demand_30d, 0.0) AS avg_daily_demand_30d,
       CASE WHEN ma.avg_daily_demand_30d > 0 THEN CAST(li.quantity_on_hand AS DOUBLE) / ma.avg_daily_demand_30d
            ELSE 999.0 END AS days_on_hand,
       CASE WHEN li.quantity_on_hand = 0 THEN 'stocked_out'
            WHEN ma.avg_daily_demand_30d > 0 AND CAST(li.quantity_on_hand AS DOUBLE) / ma.avg_daily_demand_30d < 7 THEN 'critical'
            WHEN ma.avg_daily_demand_30d > 0 AND CAST(li.quantity_on_hand AS DOUBLE) / ma.avg_daily_demand_30d < 30 THEN 'low'
            WHEN ma.avg_daily_demand_30d > 0 AND CAST(li.quantity_on_hand AS DOUBLE) / ma.avg_daily_demand_30d < 90 THEN 'healthy'
            ELSE 'overstocked' END AS stockout_risk,
       CASE WHEN ma.avg_daily_demand_30d IS NULL OR ma.avg_daily_demand_30d = 0 THEN 'C'
            WHEN ma.avg_daily_demand_30d > 50 THEN 'A' WHEN ma.avg_daily_demand_30d > 10 THEN 'B'
            ELSE 'C' END AS abc_class
FROM latest_inv li LEFT JOIN latest_demand ma ON li.product_sku = ma.product_sku""")

cte("funnel_flags", ("stg_web",), """
SELECT session_id,
       max(CASE WHEN event_type = 'page_view' THEN 1 ELSE 0 END) AS had_page_view,
       max(CASE WHEN event_type = 'product_view' THEN 1 ELSE 0 END) AS had_product_view,
       max(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS had_add_to_cart,
       max(CASE WHEN event_type = 'checkout' THEN 1 ELSE 0 END) AS had_checkout,
       max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS had_purchase
FROM stg_web GROUP BY session_id""")

cte("session_metrics", ("silver_sessions", "funnel_flags"), """
SELECT s.session_id, s.funnel_date, s.country_code, s.device_type,
       coalesce(f.had_page_view, 0) AS had_page_view, coalesce(f.had_product_view, 0) AS had_product_view,
       coalesce(f.had_add_to_cart, 0) AS had_add_to_cart, coalesce(f.had_checkout, 0) AS had_checkout,
       coalesce(f.had_purchase, 0) AS had_purchase
FROM (SELECT session_id, country_code, device_type, min(event_date) AS funnel_date
      FROM silver_sessions GROUP BY session_id, country_code, device_type) s
LEFT JOIN funnel_flags f ON s.session_id = f.session_id""")

cte("gold_funnel", ("session_metrics",), f"""
SELECT funnel_date, country_code, device_type, sessions, page_views, product_views, added_to_cart, checkouts,
       purchases,
       {_pct2('product_views', 'sessions')} AS view_rate_pct,
       {_pct2('added_to_cart', 'page_views')} AS cart_rate_pct,
       {_pct2('purchases', 'added_to_cart')} AS purchase_rate_pct,
       {_pct2('purchases', 'sessions')} AS overall_conversion_pct
FROM (SELECT funnel_date, country_code, device_type, count(*) AS sessions,
             CAST(sum(had_page_view) AS BIGINT) AS page_views, CAST(sum(had_product_view) AS BIGINT) AS product_views,
             CAST(sum(had_add_to_cart) AS BIGINT) AS added_to_cart, CAST(sum(had_checkout) AS BIGINT) AS checkouts,
             CAST(sum(had_purchase) AS BIGINT) AS purchases
      FROM session_metrics GROUP BY 1, 2, 3) g""")

cte("iot_daily", ("silver_iot",), f"""
SELECT device_id, sensor_type, reading_date, count(*) AS readings_count,
       count(CASE WHEN is_outlier THEN 1 END) AS outlier_count,
       {_micro_avg('reading_value_validated')} AS avg_reading,
       min(reading_value_validated) AS min_reading, max(reading_value_validated) AS max_reading,
       {_micro_avg('battery_level')} AS avg_battery_level, {_micro_avg('z_score')} AS avg_z_score,
       max(reading_timestamp) AS last_reading
FROM silver_iot GROUP BY device_id, sensor_type, reading_date""")

cte("gold_iot", ("iot_daily",), f"""
SELECT device_id, sensor_type, reading_date AS report_date, readings_count, outlier_count, avg_reading,
       min_reading, max_reading, avg_battery_level, avg_z_score, last_reading,
       {_ratio('sum(outlier_count) OVER w7 * 100', 'sum(readings_count) OVER w7')} AS anomaly_rate_7d_pct,
       (floor(epoch(last_reading)) - floor(epoch(lag(last_reading) OVER w))) / 3600.0 AS hours_since_last,
       CAST(datediff('day', CAST(lag(last_reading) OVER w AS DATE), CAST(last_reading AS DATE)) AS INTEGER) AS days_since_last
FROM iot_daily
WINDOW w AS (PARTITION BY device_id, sensor_type ORDER BY reading_date),
       w7 AS (PARTITION BY device_id, sensor_type ORDER BY reading_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in CTE[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(final: str, *ctes: str) -> str:
    order = _closure(ctes)
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order) + "\n" + final.strip()


# ============================================================ widened set
CUTOFF = "TIMESTAMP '1998-01-01 00:00:00'"
SCD_T = "TIMESTAMP '1998-01-01 00:00:00'"
S_EOD = "TIMESTAMP '2001-08-16 00:00:00'"
E_EOD = "TIMESTAMP '2024-01-31 00:00:00'"
SALES_COLS = ("transaction_id, store_id, product_sku, quantity, amount_local, currency, payment_method, "
              "transaction_date, customer_email_hashed, amount_usd, surrogate_key, _loaded_at")
COMPARE = ["store_id", "product_sku", "quantity", "amount_local", "currency", "payment_method",
           "transaction_date", "customer_email_hashed", "amount_usd"]


def _latest_sales(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _loaded_at DESC NULLS LAST,
      transaction_date DESC NULLS LAST, store_id DESC NULLS LAST, product_sku DESC NULLS LAST,
      quantity DESC NULLS LAST, unit_price DESC NULLS LAST, amount DESC NULLS LAST,
      currency DESC NULLS LAST, payment_method DESC NULLS LAST, customer_email DESC NULLS LAST) AS rn
  FROM {src} WHERE transaction_id IS NOT NULL) WHERE rn = 1"""


def _silver_from(latest: str, validate: bool = True) -> str:
    amt = "amount" if validate else "CAST(CASE WHEN amount < 0 THEN 0 ELSE amount END AS DECIMAL(18,2))"
    where = "WHERE amount > 0 AND quantity > 0" if validate else ""
    return f"""SELECT transaction_id, store_id, product_sku, quantity, {amt} AS amount_local, currency,
       payment_method, transaction_date, {_hash('customer_email')} AS customer_email_hashed,
       {amt} AS amount_usd, surrogate_key, _loaded_at
FROM {latest} {where}"""


cte("first_stg", ("stg_sales",), f"SELECT * FROM stg_sales WHERE _loaded_at < {CUTOFF}")
cte("first_latest", ("first_stg",), _latest_sales("first_stg"))
cte("sales_first", ("first_latest",), _silver_from("first_latest"))
cte("next_stg", ("stg_sales", "sales_first"),
    "SELECT * FROM stg_sales WHERE _loaded_at > (SELECT max(_loaded_at) FROM sales_first)")
cte("next_latest", ("next_stg",), _latest_sales("next_stg"))
cte("sales_next", ("next_latest",), _silver_from("next_latest"))
cte("sales_unvalidated", ("sales_latest",), _silver_from("sales_latest", validate=False))

cte("seed_countries", (), "SELECT * FROM (VALUES " + ", ".join(
    "('{}', '{}')".format(code, region.replace("'", "''")) for code, region in [
        ("SN", "West Africa"), ("CI", "West Africa"), ("ML", "West Africa"), ("BF", "West Africa"),
        ("FR", "Europe"), ("US", "North America"), ("GB", "Europe"), ("DE", "Europe"),
        ("CA", "North America"), ("NG", "West Africa")]) + ") AS t(country_code, region)")

cte("ltv_sales", ("silver_sales",), f"""
SELECT customer_email_hashed, CAST(sum(amount_usd) AS DECIMAL(38,2)) AS total_spend_usd,
       count(DISTINCT transaction_id) AS total_orders, min(transaction_date) AS first_purchase_date,
       max(transaction_date) AS last_purchase_date,
       CAST(datediff('day', CAST(max(transaction_date) AS DATE), {S_AS_OF}) AS INTEGER) AS days_since_last_purchase
FROM silver_sales WHERE customer_email_hashed IS NOT NULL GROUP BY customer_email_hashed""")

cte("scd2", (), f"""
SELECT customer_id, priority_tier, updated_at AS valid_from,
       lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS valid_to,
       lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) IS NULL AS is_current
FROM (SELECT *, lag(h) OVER (PARTITION BY customer_id ORDER BY updated_at) AS prev FROM (
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY customer_id, updated_at ORDER BY h DESC) AS rn FROM (
            SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS updated_at,
                   o_orderpriority AS priority_tier, {_skey('o_orderpriority')} AS h FROM orders))
        WHERE rn = 1))
WHERE prev IS NULL OR prev <> h""")

cte("day_checks", ("stg_web", "silver_iot"), f"""
SELECT d, c.check_name, c.passed FROM (
  SELECT coalesce(w.d, o.d) AS d, w.events, w.null_browser, o.readings, o.outliers
  FROM (SELECT CAST(event_timestamp AS DATE) AS d, count(*) AS events,
               sum(CASE WHEN browser IS NULL THEN 1 ELSE 0 END) AS null_browser FROM stg_web GROUP BY 1) w
  FULL JOIN (SELECT reading_date AS d, count(*) AS readings, count(CASE WHEN is_outlier THEN 1 END) AS outliers
             FROM silver_iot GROUP BY 1) o ON w.d = o.d) j,
LATERAL (SELECT * FROM (VALUES
   ('null_ratio_browser', coalesce({_ratio('j.null_browser * 100', 'j.events')}, 0.0) <= 5.0),
   ('iot_outlier_rate', coalesce({_ratio('j.outliers * 100', 'j.readings')}, 0.0) < 10.0),
   ('row_count_web_events', coalesce(j.events, 0) > 0)) AS v(check_name, passed)) c""")

cte("null_ratio_all", ("silver_sales", "silver_customers"), " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS total "
    f"FROM {src}" for t, src, cols in [
        ("sales_transactions_cleaned", "silver_sales", SALES_COLS.split(", ")),
        ("customers_cleaned", "silver_customers",
         "customer_id, full_name_clean, email_hashed, phone_masked, date_of_birth, address_city, country_code, "
         "registration_date, loyalty_tier, age_bucket, surrogate_key, _loaded_at".split(", "))]
    for c in cols))

cte("null_ratio", ("null_ratio_all",), f"""
SELECT table_name, column_name, null_count, total,
       coalesce({_ratio('null_count * 100', 'total')}, 0.0) AS null_pct,
       coalesce({_ratio('null_count * 100', 'total')}, 0.0) <= 5.0 AS passed
FROM null_ratio_all""")

cte("layer_counts", ("stg_sales", "silver_sales", "gold_daily_sales"), """
SELECT (SELECT count(*) FROM stg_sales) AS bronze, (SELECT count(*) FROM silver_sales) AS silver,
       (SELECT count(*) FROM gold_daily_sales) AS gold""")

cte("layer_rec", ("layer_counts",), f"""
SELECT 'row_count_bronze' AS check_name, CAST(bronze AS DOUBLE) AS metric, bronze > 0 AS passed FROM layer_counts
UNION ALL SELECT 'row_count_silver', CAST(silver AS DOUBLE), silver > 0 FROM layer_counts
UNION ALL SELECT 'row_count_gold', CAST(gold AS DOUBLE), gold > 0 FROM layer_counts
UNION ALL SELECT 'dedup_reduction_pct', {_ratio('(bronze - silver) * 100', 'bronze')},
                 coalesce({_ratio('(bronze - silver) * 100', 'bronze')} >= 0, FALSE) FROM layer_counts""")

cte("completeness", ("gold_customer_360",), f"""
SELECT customers, active, coalesce({_ratio('active * 100', 'customers')}, 0.0) AS active_pct,
       coalesce({_ratio('active * 100', 'customers')}, 0.0) > 0 AS passed
FROM (SELECT count(*) AS customers, count(CASE WHEN customer_segment <> 'never_purchased' THEN 1 END) AS active
      FROM gold_customer_360)""")

cte("revenue", ("gold_daily_sales", "silver_sales"), """
SELECT g AS gold_revenue_usd, s AS silver_revenue_usd, coalesce(g IS NOT NULL AND g > 0 AND g = s, FALSE) AS passed
FROM (SELECT (SELECT CAST(sum(total_revenue_usd) AS DECIMAL(38,2)) FROM gold_daily_sales) AS g,
             (SELECT CAST(sum(amount_usd) AS DECIMAL(38,2)) FROM silver_sales) AS s)""")

cte("outliers", ("silver_iot",), f"""
SELECT readings, outliers, coalesce({_ratio('outliers * 100', 'readings')}, 0.0) AS outlier_pct,
       coalesce({_ratio('outliers * 100', 'readings')}, 0.0) < 10.0 AS passed
FROM (SELECT count(*) AS readings, count(CASE WHEN is_outlier THEN 1 END) AS outliers FROM silver_iot)""")

cte("fresh_sales", ("silver_sales",), f"""
SELECT max(transaction_date) AS max_ts,
       (floor(epoch({S_EOD})) - floor(epoch(max(transaction_date)))) / 3600.0 AS age_hours FROM silver_sales""")

cte("dq_checks", ("layer_rec", "fresh_sales", "null_ratio", "completeness", "revenue", "outliers"), """
SELECT check_name AS name, passed FROM layer_rec
UNION ALL SELECT 'freshness_sales', NOT (max_ts IS NULL OR age_hours > 48) FROM fresh_sales
UNION ALL SELECT 'null_ratio_sales', bool_and(passed) FROM null_ratio WHERE table_name = 'sales_transactions_cleaned'
UNION ALL SELECT 'null_ratio_customers', bool_and(passed) FROM null_ratio WHERE table_name = 'customers_cleaned'
UNION ALL SELECT 'customer_completeness', passed FROM completeness
UNION ALL SELECT 'revenue_integrity', passed FROM revenue
UNION ALL SELECT 'iot_outlier_rate', passed FROM outliers""")

cte("fx_rates", ("stg_sales",), """
SELECT currency, rate_date,
       CAST(CASE WHEN currency = 'USD' THEN 1 WHEN currency = 'EUR' THEN 1.05 + (day(rate_date) % 10) * 0.01
                 ELSE 0.0016 + (day(rate_date) % 5) * 0.0001 END AS DECIMAL(18,6)) AS usd_rate
FROM (SELECT DISTINCT currency, CAST(transaction_date AS DATE) AS rate_date FROM stg_sales)""")


# ------------------------------------------------------------ E-04 FIFO cost
INBOUND_SQL = ("movement_type IN ('INBOUND', 'ADJUSTMENT+') OR (movement_type = 'ADJUSTMENT' AND quantity > 0)")

cte("receipt_costs", (), f"""
SELECT movement_id,
       CAST(CAST((CAST(amount * 100 AS BIGINT) * 2 + quantity) // (2 * NULLIF(quantity, 0)) AS DECIMAL(18,0))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS unit_cost
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS movement_id,
             {_qty('l_partkey', 'l_quantity')} AS quantity,
             CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.002 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS amount
      FROM lineitem WHERE l_returnflag = 'N' OR (l_returnflag = 'A' AND l_linestatus = 'O'))""")

cte("fifo_flows", ("inv_latest", "receipt_costs"), f"""
SELECT CAST(m.movement_date AS DATE) AS movement_date, m.product_sku, m.warehouse_id,
       CAST(sum(CASE WHEN {INBOUND_SQL} THEN quantity ELSE 0 END) AS BIGINT) AS inbound_qty,
       CAST(sum(CASE WHEN movement_type IN ('OUTBOUND', 'ADJUSTMENT-') THEN quantity
                     WHEN movement_type = 'ADJUSTMENT' AND quantity < 0 THEN -quantity ELSE 0 END) AS BIGINT) AS outbound_qty,
       CAST(sum(CASE WHEN {INBOUND_SQL} THEN CAST(quantity AS BIGINT) * CAST(c.unit_cost * 100 AS BIGINT) ELSE 0 END)
            AS BIGINT) AS in_cents
FROM inv_latest m LEFT JOIN receipt_costs c ON m.movement_id = c.movement_id
GROUP BY 1, 2, 3""")

cte("fifo_run", ("fifo_flows",), """
SELECT *, CAST(sum(inbound_qty) OVER w AS BIGINT) AS ci, CAST(sum(in_cents) OVER w AS BIGINT) AS ck,
       CAST(sum(outbound_qty) OVER w AS BIGINT) AS co
FROM fifo_flows
WINDOW w AS (PARTITION BY product_sku, warehouse_id ORDER BY movement_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

cte("fifo_layers", ("fifo_run",), """
SELECT product_sku, warehouse_id, ci - inbound_qty AS s, inbound_qty AS q, in_cents AS k, ck - in_cents AS ckb
FROM fifo_run WHERE inbound_qty > 0""")

# the containing layer = the one with the greatest start <= the consumed position
cte("fifo_pick", ("fifo_run", "fifo_layers"), """
SELECT * EXCLUDE (rn) FROM (
  SELECT r.*, least(r.co, r.ci) AS p, l.s, l.q, l.k, l.ckb,
         row_number() OVER (PARTITION BY r.product_sku, r.warehouse_id, r.movement_date
                            ORDER BY l.s DESC NULLS LAST) AS rn
  FROM fifo_run r LEFT JOIN fifo_layers l
    ON l.product_sku = r.product_sku AND l.warehouse_id = r.warehouse_id AND l.s <= least(r.co, r.ci)) WHERE rn = 1""")

cte("silver_inventory_fifo", ("fifo_pick",), """
SELECT movement_date AS snapshot_date, product_sku, warehouse_id, ci - co AS quantity_on_hand,
       inbound_qty, outbound_qty,
       CAST(CAST(in_cents AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS inbound_cost,
       CAST(CAST(ck - coalesce(ckb + (k // q) * (p - s) + (2 * (k % q) * (p - s) + q) // (2 * q), 0)
                 AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS total_cost
FROM fifo_pick""")
