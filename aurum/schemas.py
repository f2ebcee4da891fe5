"""Explicit StructType per feed (no inference: it typed ids as timestamps)."""

from pyspark.sql import types as T

S, I, L, D, TS, DT, B = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                         T.TimestampNTZType(), T.DateType(), T.BooleanType())
MONEY = T.DecimalType(18, 2)


def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SALES = _s(
    ("transaction_id", S, False), ("store_id", S, True), ("product_sku", S, True),
    ("quantity", I, True), ("unit_price", MONEY, True), ("amount", MONEY, True),
    ("currency", S, True), ("payment_method", S, True), ("customer_email", S, True),
    ("transaction_date", TS, True), ("_ingested_at", TS, True),
)

CUSTOMERS = _s(
    ("customer_id", S, False), ("email", S, True), ("full_name", S, True),
    ("phone_number", S, True), ("date_of_birth", DT, True), ("address_line1", S, True),
    ("address_city", S, True), ("address_country", S, True), ("registration_date", DT, True),
    ("loyalty_tier", S, True), ("_ingested_at", TS, True),
)

INVENTORY = _s(
    ("movement_id", S, False), ("product_sku", S, True), ("warehouse_id", S, True),
    ("quantity", I, True), ("movement_type", S, True), ("from_location", S, True),
    ("to_location", S, True), ("movement_date", TS, True), ("reference_order_id", S, True),
    ("_ingested_at", TS, True),
)

WEB_EVENTS = _s(
    ("event_id", S, False), ("session_id", S, True), ("user_id", S, True),
    ("event_type", S, True), ("page_url", S, True), ("referrer_url", S, True),
    ("device_type", S, True), ("browser", S, True), ("country_code", S, True),
    ("event_timestamp", TS, True), ("_ingested_at", TS, True),
)

IOT = _s(
    ("device_id", S, False), ("sensor_type", S, True), ("reading_value", D, True),
    ("reading_unit", S, True), ("battery_level", D, True), ("firmware_version", S, True),
    ("reading_timestamp", TS, True), ("_ingested_at", TS, True),
)

COUNTRIES = _s(("country_code", S, False), ("country_name", S, True), ("region", S, True))

FX_RATES = _s(("currency", S, False), ("rate_date", DT, False), ("usd_rate", T.DecimalType(18, 6), False))

EVENT_HUB = _s(("key", T.BinaryType(), True), ("value", T.BinaryType(), True), ("timestamp", T.TimestampType(), True))

DQ_CHECK = T.StructType([
    T.StructField("name", S), T.StructField("passed", B), T.StructField("detail", S),
])
DQ_REPORT = T.StructType([
    T.StructField("run_timestamp", S), T.StructField("environment", S),
    T.StructField("checks", T.ArrayType(DQ_CHECK)), T.StructField("overall_status", S),
])

# Driver tables the adapters read (TESTDATA.md).  Declared so a read plans
# without a schema-inference job per table and per query.
DRIVER_TABLES = {
    "region": _s(("r_regionkey", I, True), ("r_name", S, True)),
    "nation": _s(("n_nationkey", I, True), ("n_name", S, True), ("n_regionkey", I, True)),
    "customer": _s(("c_custkey", L, True), ("c_name", S, True), ("c_nationkey", I, True),
                   ("c_acctbal", D, True), ("c_mktsegment", S, True)),
    "supplier": _s(("s_suppkey", L, True), ("s_name", S, True), ("s_nationkey", I, True),
                   ("s_acctbal", D, True)),
    "part": _s(("p_partkey", L, True), ("p_name", S, True), ("p_brand", S, True), ("p_type", S, True),
               ("p_size", I, True), ("p_retailprice", D, True)),
    "orders": _s(("o_orderkey", L, True), ("o_custkey", L, True), ("o_orderstatus", S, True),
                 ("o_totalprice", D, True), ("o_orderdate", TS, True), ("o_orderpriority", S, True)),
    "lineitem": _s(("l_orderkey", L, True), ("l_partkey", L, True), ("l_suppkey", L, True),
                   ("l_linenumber", I, True), ("l_quantity", D, True), ("l_extendedprice", D, True),
                   ("l_discount", D, True), ("l_tax", D, True), ("l_returnflag", S, True),
                   ("l_linestatus", S, True), ("l_shipdate", TS, True)),
    "events": _s(("event_id", L, True), ("ts", TS, True), ("user_id", L, True), ("event_type", S, True),
                 ("value", D, True), ("props", S, True)),
    "pages": _s(("page_id", L, True), ("url", S, True), ("html", S, True)),
}

FEEDS = {
    "sales": SALES, "customers": CUSTOMERS, "inventory": INVENTORY,
    "web_events": WEB_EVENTS, "iot": IOT,
}
