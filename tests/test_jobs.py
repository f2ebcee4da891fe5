"""Catalog writes and reads, failure store, report append, stream dedup and
the bronze → silver → gold → data-quality jobs end to end."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from aurum.config import SALES_AS_OF, TEST_SALT, Settings
from aurum.operators import quality
from aurum.plans import jobs
from aurum.plans.bed import Bed
from aurum.sources import readers, sinks
from aurum.streaming import streams
from helpers import SF_SMOKE, rows

T = dt.datetime


# ------------------------------------------------------------------ S-02 / S-20 / R-05
def test_table_write_persists_docs_and_reads_back(spark, settings):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    name = sinks.layer_table(settings, "silver", "sales", "docs_demo")
    assert name == "silver_sales.docs_demo"
    sinks.write_table(spark, df, name, comment="Cleaned sales; it's the silver copy",
                      properties={"quality": "silver"}, column_comments={"id": "business key"})
    assert rows(readers.read_catalog_table(spark, name)) == [(1, "a"), (2, "b")]
    desc = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert desc["Comment"] == "Cleaned sales; it's the silver copy"
    cols = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert cols["id"] == "business key" and cols["name"] is None
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props["quality"] == "silver"
    # overwrite replaces the rows, append adds
    sinks.write_table(spark, df.limit(1), name, mode="append")
    assert readers.read_catalog_table(spark, name).count() == 3


# ------------------------------------------------------------------ S-06
def test_external_table_over_a_path(spark, scratch):
    path = os.path.join(scratch, "ext")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "id int, d date")
    sinks.write_path(df, path, partition_by=["d"])
    sinks.register_external(spark, "bronze_ext.events", path)
    assert rows(spark.table("bronze_ext.events"), "id", "d") == rows(df)
    sinks.register_external(spark, "bronze_ext.events", path)  # IF NOT EXISTS: a no-op
    assert spark.table("bronze_ext.events").count() == 2
    assert readers.read_table_path(spark, path).count() == 2


# ------------------------------------------------------------------ S-19 / S-18 / A-15
def test_store_failures_and_report_append(spark, scratch):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, None)], "id int, v string")
    bad = quality.not_null_violations(df, "v", "demo", "id")
    dest = sinks.store_failures(bad, scratch, "not_null_demo_v")
    assert dest.endswith("test_failures/not_null_demo_v")
    assert rows(spark.read.parquet(dest), "row_key") == [("2",), ("3",)]

    reports = os.path.join(scratch, "reports")
    for ts, ok in (("2024-01-01T01:00:00", True), ("2024-01-01T02:00:00", False)):
        checks = spark.createDataFrame([("a", True, ""), ("b", ok, "")], "name string, passed boolean, detail string")
        sinks.append_report(quality.report(checks, ts, "dev"), reports)
    stored = spark.read.parquet(reports)
    assert rows(stored, "overall_status") == [("FAILED",), ("PASSED",)]
    trend = {r["check_name"]: (r["failure_count"], r["total_runs"], r["failure_rate_pct"])
             for r in quality.dq_trend(stored).collect()}
    assert trend == {"a": (0, 2, 0.0), "b": (1, 2, 50.0)}


# ------------------------------------------------------------------ X-07
def test_stream_dedup_within_watermark(spark, scratch):
    src, out, ck = (os.path.join(scratch, d) for d in ("src", "out", "ck"))
    os.makedirs(src)
    schema = spark.createDataFrame([], "id string, ts timestamp, v int").schema

    def drop(name, recs):
        with open(os.path.join(src, name), "w", encoding="utf-8") as fh:
            fh.write("".join(json.dumps(r) + "\n" for r in recs))

    def run():
        s = readers.read_stream(spark, src, schema, "json")
        q = (streams.dedup_stream(s, "id", "ts", "1 hour").writeStream.format("parquet")
             .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
        q.awaitTermination()
        return spark.read.parquet(out)

    drop("a.json", [{"id": "k1", "ts": "2024-01-01T10:00:00", "v": 1},
                    {"id": "k1", "ts": "2024-01-01T10:05:00", "v": 2},
                    {"id": "k2", "ts": "2024-01-01T10:10:00", "v": 3}])
    assert rows(run(), "id") == [("k1",), ("k2",)]
    # a later copy of k1 inside the delay is dropped; a new key is kept
    drop("b.json", [{"id": "k1", "ts": "2024-01-01T10:20:00", "v": 4},
                    {"id": "k3", "ts": "2024-01-01T10:30:00", "v": 5}])
    got = run()
    assert rows(got, "id") == [("k1",), ("k2",), ("k3",)]
    assert rows(got.filter("id = 'k1'"), "v") == [(1,)]


# ------------------------------------------------------------------ jobs
def test_medallion_jobs_end_to_end_and_idempotent(spark, scratch):
    bed = Bed(spark, SF_SMOKE)
    root = os.path.join(scratch, "lake")
    sales_settings = Settings(salt=TEST_SALT, as_of=SALES_AS_OF, root=root)
    events_settings = bed.events_settings
    feeds = {n: bed.raw(n) for n in jobs.BRONZE}

    jobs.bronze_job(spark, sales_settings, feeds)
    jobs.silver_job(spark, sales_settings)
    jobs.gold_job(spark, sales_settings, events_settings)
    checks = jobs.dq_job(spark, sales_settings, "2024-01-30T06:00:00", as_of_ts=dt.datetime.combine(SALES_AS_OF, dt.time()), raise_on_failure=False)

    daily = jobs.read(spark, sales_settings, "gold", "daily_sales")
    assert sorted(daily.columns) == sorted(bed.daily_sales.columns)
    assert rows(daily, *bed.daily_sales.columns) == rows(bed.daily_sales)
    assert jobs.silver_view(spark, sales_settings, "sales").count() == bed.sales.count()
    assert rows(jobs.silver_view(spark, sales_settings, "sessions"), "session_id", "user_id") == \
        rows(bed.sessions, "session_id", "user_id")
    assert jobs.read(spark, sales_settings, "gold", "customer_360").count() == bed.customer_360.count()
    got = {r["name"]: r["passed"] for r in checks.collect()}
    assert got["revenue_integrity"] is True
    reports = spark.read.parquet(os.path.join(root, "checkpoint", "data_quality_reports"))
    assert reports.count() == 1

    # a retried run adds nothing to bronze and changes nothing in silver
    before = {n: jobs.read(spark, sales_settings, "silver", n).count() for n in jobs.SILVER}
    bronze_before = jobs.read(spark, sales_settings, "bronze", "sales").count()
    jobs.bronze_job(spark, sales_settings, feeds)
    jobs.silver_job(spark, sales_settings)
    assert jobs.read(spark, sales_settings, "bronze", "sales").count() == bronze_before
    assert {n: jobs.read(spark, sales_settings, "silver", n).count() for n in jobs.SILVER} == before
    assert jobs.read(spark, sales_settings, "silver", "iot").agg(F.countDistinct("surrogate_key")).first()[0] == \
        before["iot"]
