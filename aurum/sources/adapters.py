"""Driver tables → the five landing feeds (FIXTURES.md §3).

The reference ingests retail / IoT feeds; the test bed ships TPC-H-like
tables plus an event stream.  These adapters derive each feed with plain
projections and equi-joins so they scale with the input, and every column
rule is expressible in ANSI SQL (the oracle repeats them in DuckDB).

Joins are left to the planner: region/nation are tiny and fall under the
automatic broadcast threshold (a size Spark checks), supplier and orders grow
with the scale factor: supplier is broadcast while its files are small
(``joins.sized``), orders is shuffled or broadcast by AQE from runtime sizes.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.operators.joins import sized
from aurum.schemas import DRIVER_TABLES
from aurum.seeds import COUNTRY_CODES

# --- fixed mapping values (FIXTURES.md §3) ----------------------------------
EVENT_TYPE_MAP = {"view": "page_view", "click": "product_view", "signup": "add_to_cart",
                  "error": "checkout", "purchase": "purchase"}
DEVICES = ("desktop", "mobile", "tablet")
BROWSERS = ("chrome", "firefox", "safari", "edge")
CURRENCY_BY_REGION = {"AMERICA": "USD", "EUROPE": "EUR"}
DEFAULT_CURRENCY = "XOF"
AMOUNT_SCALE = "0.002"
# ----------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "pages")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table by name, with its declared schema when known (no
    inference job; a file whose types disagree fails the scan loudly)."""
    reader = spark.read
    if name in DRIVER_TABLES:
        reader = reader.schema(DRIVER_TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(c) -> Column:
    return F.col(c).cast("timestamp_ntz")


def _email(key: Column) -> Column:
    """``user<k>@example.com``; NULL when k % 50 = 0; no ``@`` when k % 37 = 0."""
    k = key.cast("string")
    return (F.when(key % 50 == 0, F.lit(None).cast("string"))
            .when(key % 37 == 0, F.concat(F.lit("user"), k, F.lit(".example.com")))
            .otherwise(F.concat(F.lit("user"), k, F.lit("@example.com"))))


def _quantity(partkey: Column, qty: Column) -> Column:
    r = partkey % 3
    return (F.when(r == 0, F.ceil(qty / 10)).when(r == 1, qty).otherwise(qty * 5)).cast("int")


def _amount(price: Column) -> Column:
    return (price.cast("decimal(18,2)") * F.lit(AMOUNT_SCALE).cast("decimal(4,3)")).cast("decimal(18,2)")


def _unit_price(amount: Column, qty: Column) -> Column:
    """``round(amount / quantity, 2)`` (HALF_UP) in exact integer cents — no
    decimal division on the hot path (identical results, checked on sf0.1)."""
    cents = (amount * F.lit(100)).cast("bigint")
    q = F.nullif(qty, F.lit(0)).cast("bigint")
    num, den = cents * 2 + q, q * 2
    half_up = ((num - F.pmod(num, den)) / den).cast("bigint")  # exact floor division of integers
    return (half_up.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def _line_id(li=None) -> Column:
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def _currency(region_name: Column) -> Column:
    e = F.when(F.lit(False), F.lit(None))
    for name, cur in CURRENCY_BY_REGION.items():
        e = e.when(region_name == name, cur)
    return e.otherwise(DEFAULT_CURRENCY)


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Joined one dimension at a time from the fact side: each small side is
    # then sized from its own scan (a pre-joined supplier ⋈ nation ⋈ region
    # is estimated as the product of its inputs, looks huge, and drags the
    # fact table through a sort-merge shuffle).
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(sized(s), li.l_suppkey == s.s_suppkey)
         .join(n, s.s_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey)
         .withColumn("currency", _currency(F.col("r_name"))))
    qty = _quantity(F.col("l_partkey"), F.col("l_quantity"))
    # some lines have no amount (the declared not_null test finds them)
    amount = F.when(~((F.col("l_linenumber") == 6) & (F.col("l_partkey") % 53 == 0)), _amount(F.col("l_extendedprice")))
    return j.select(
        _line_id().alias("transaction_id"),
        F.concat(F.lit("STORE-"), F.col("s_nationkey").cast("string")).alias("store_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("product_sku"),
        qty.alias("quantity"),
        _unit_price(amount, qty).alias("unit_price"),
        amount.alias("amount"),
        F.col("currency"),
        F.col("o_orderpriority").alias("payment_method"),
        _email(F.col("o_custkey")).alias("customer_email"),
        _ntz("o_orderdate").alias("transaction_date"),
        _ntz("l_shipdate").alias("_ingested_at"),
    )


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    reg = F.date_add(F.lit("1994-01-01").cast("date"), (k % 365).cast("int"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        k.cast("string").alias("customer_id"),
        _email(k).alias("email"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit("  ")).alias("full_name"),
        F.concat(F.lit("+1"), F.lpad(k.cast("string"), 9, "0")).alias("phone_number"),
        F.when(k % 41 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(F.lit("1950-01-01").cast("date"), ((k * 37) % 20000).cast("int")))
         .alias("date_of_birth"),
        F.concat(k.cast("string"), F.lit(" Market Street")).alias("address_line1"),
        F.concat(F.lit("CITY-"), (k % 100).cast("string")).alias("address_city"),
        F.lower("n_name").alias("address_country"),
        reg.alias("registration_date"),
        F.col("c_mktsegment").alias("loyalty_tier"),
        reg.cast("timestamp_ntz").alias("_ingested_at"),
    )


def inventory_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    mtype = (F.when(flag == "N", "INBOUND").when(flag == "R", "OUTBOUND")
             .when((flag == "A") & (status == "O"), "ADJUSTMENT+")
             .when((flag == "A") & (status == "F"), "TRANSFER"))
    base_q = _quantity(F.col("l_partkey"), F.col("l_quantity"))
    qty = F.when(mtype.isin("INBOUND", "ADJUSTMENT+"), base_q * (F.col("l_partkey") % 40 + 1).cast("int")) \
        .otherwise(base_q)
    wh = F.concat(F.lit("WH-"), (F.col("l_suppkey") % 2).cast("string"))
    other_wh = F.concat(F.lit("WH-"), ((F.col("l_suppkey") + 1) % 2).cast("string"))
    return li.select(
        _line_id().alias("movement_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("product_sku"),
        wh.alias("warehouse_id"),
        qty.cast("int").alias("quantity"),
        mtype.alias("movement_type"),
        F.when(mtype == "INBOUND", F.concat(F.lit("SUP-"), F.col("l_suppkey").cast("string"))).otherwise(wh)
         .alias("from_location"),
        F.when(mtype == "OUTBOUND", F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")))
         .when(mtype == "TRANSFER", other_wh).otherwise(wh).alias("to_location"),
        _ntz("l_shipdate").alias("movement_date"),
        F.col("l_orderkey").cast("string").alias("reference_order_id"),
        _ntz("l_shipdate").alias("_ingested_at"),
    )


def receipt_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit cost of each receiving movement (INBOUND / ADJUSTMENT+ lines of
    the inventory feed): the line's unit price, as in the sales feed."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    qty = _quantity(F.col("l_partkey"), F.col("l_quantity"))
    return li.filter((flag == "N") | ((flag == "A") & (status == "O"))).select(
        _line_id().alias("movement_id"),
        _unit_price(_amount(F.col("l_extendedprice")), qty).alias("unit_cost"),
    )


def _props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def web_events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    uid = F.col("user_id")
    k = _props_k()
    etype = F.when(F.lit(False), F.lit(None))
    for src, dst in EVENT_TYPE_MAP.items():
        etype = etype.when(F.col("event_type") == src, dst)
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(uid.cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        F.when(F.col("event_id") % 97 != 0, uid.cast("string")).alias("user_id"),  # some events are anonymous
        etype.alias("event_type"),
        F.concat(F.lit("https://shop.example.com/p/"), k.cast("string"),
                 F.lit("?utm_source="), (k % 3).cast("string")).alias("page_url"),
        F.concat(F.lit("https://ref"), (F.col("event_id") % 5).cast("string"),
                 F.lit(".example.org/")).alias("referrer_url"),
        F.element_at(F.array(*[F.lit(d) for d in DEVICES]), (uid % 3 + 1).cast("int")).alias("device_type"),
        F.when(uid % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.element_at(F.array(*[F.lit(b) for b in BROWSERS]), (uid % 4 + 1).cast("int")))
         .alias("browser"),
        F.element_at(F.array(*[F.lit(c) for c in COUNTRY_CODES]), (uid % 10 + 1).cast("int")).alias("country_code"),
        _ntz("ts").alias("event_timestamp"),
        _ntz("ts").alias("_ingested_at"),
    )


def iot_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        # some readings name no device; devices measure in one of two units
        F.when(F.col("event_id") % 101 != 0, F.concat(F.lit("DEV-"), F.col("user_id").cast("string"))).alias("device_id"),
        F.col("event_type").alias("sensor_type"),
        F.col("value").cast("double").alias("reading_value"),
        F.when(F.col("user_id") % 2 == 0, "unit").otherwise("unit2").alias("reading_unit"),
        _props_k().cast("double").alias("battery_level"),
        F.lit("fw-1.0").alias("firmware_version"),
        _ntz("ts").alias("reading_timestamp"),
        _ntz("ts").alias("_ingested_at"),
    )


FEEDS = {
    "sales": sales_feed,
    "customers": customers_feed,
    "inventory": inventory_feed,
    "web_events": web_events_feed,
    "iot": iot_feed,
}


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FEEDS[name](spark, sf_dir)
