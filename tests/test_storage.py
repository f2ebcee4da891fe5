"""Stored tables: merges with NULLs, deletes, new columns, full refresh,
compaction, Z-order, external tables, incremental silver against a rebuild."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from aurum.config import SALES_AS_OF, TEST_SALT, Settings
from aurum.operators import quality, upsert
from aurum.plans import jobs
from aurum.plans.bed import Bed
from aurum.sources import readers, sinks
from aurum.streaming import streams
from helpers import SF_SMOKE, rows

D = dt.date


def stored(spark, path):
    return spark.read.option("mergeSchema", "true").parquet(path)


# ------------------------------------------------------------------ merges (S-07, S-08, S-12)
def test_merge_keeps_rows_of_the_null_partition(spark, scratch):
    path = os.path.join(scratch, "t")
    kind = "k string, d date, v int"
    sinks.merge_into_path(spark, spark.createDataFrame([("k1", None, 1), ("k2", None, 2), ("k3", D(2024, 1, 1), 3)], kind), path, "k", partition_by="d")
    sinks.merge_into_path(spark, spark.createDataFrame([("k9", None, 9), ("k2", D(2024, 1, 2), 20)], kind), path, "k", partition_by="d")
    assert rows(stored(spark, path), "k", "v") == [("k1", 1), ("k2", 20), ("k3", 3), ("k9", 9)]
    sinks.merge_into_path(spark, spark.createDataFrame([("k1", D(2024, 1, 1), 1), ("k9", D(2024, 1, 1), 9)], kind), path, "k", partition_by="d")
    assert rows(stored(spark, path), "k") == [("k1",), ("k2",), ("k3",), ("k9",)]
    assert not os.path.exists(os.path.join(path, "d=__HIVE_DEFAULT_PARTITION__"))


def test_null_safe_keys_match_each_other(spark, scratch):
    path = os.path.join(scratch, "t")
    src = spark.createDataFrame([("s1", None, 1), ("s1", "u", 2)], "s string, u string, v int")
    for _ in range(2):
        sinks.merge_into_path(spark, src, path, ["s", "u"], null_safe=True)
    assert rows(stored(spark, path)) == rows(src)
    plain = upsert.upsert(src, src, ["s", "u"])  # SQL MERGE: a NULL key matches nothing
    assert plain.count() == 3
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.assert_unique_keys(src.union(src), ["s", "u"], null_safe=True)


def test_added_column_survives_later_merges(spark, scratch):
    path = os.path.join(scratch, "t")
    sinks.merge_into_path(spark, spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, p int, v int"), path, "k", partition_by="p")
    sinks.merge_into_path(spark, spark.createDataFrame([("c", 1, 30, "x")], "k string, p int, v int, extra string"), path, "k", partition_by="p")
    sinks.merge_into_path(spark, spark.createDataFrame([("a", 1, 11)], "k string, p int, v int"), path, "k", partition_by="p")
    assert rows(stored(spark, path), "k", "v", "extra") == [("a", 11, None), ("b", 20, None), ("c", 30, "x")]
    new = spark.createDataFrame([("d", 1, 1, "n")], "k string, p int, v int, more string")
    with pytest.raises(ValueError):
        sinks.merge_into_path(spark, new, path, "k", partition_by="p", on_schema_change="fail")
    sinks.merge_into_path(spark, new, path, "k", partition_by="p", on_schema_change="ignore")
    assert "more" not in stored(spark, path).columns and stored(spark, path).count() == 4
    sinks.merge_into_path(spark, new, path, "k", partition_by="p", on_schema_change="sync_all_columns")
    assert set(stored(spark, path).columns) == {"k", "p", "v", "more"} and stored(spark, path).count() == 4


def test_scope_removes_keys_that_no_longer_qualify(spark, scratch):
    path = os.path.join(scratch, "t")
    sinks.merge_into_path(spark, spark.createDataFrame([("a", 1), ("b", 1), (None, 2)], "k string, p int"), path, "k", partition_by="p")
    scope = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    sinks.merge_into_path(spark, spark.createDataFrame([("z", 3)], "k string, p int"), path, "k", partition_by="p", scope=scope)
    assert rows(stored(spark, path), "k", "p") == [("b", 1), ("z", 3)]
    assert sorted(f for f in os.listdir(path) if "=" in f) == ["p=1", "p=3"]
    assert [f for f in os.listdir(scratch) if "__staged" in f] == []


def test_merge_by_table_name(spark):
    name = "silver_merge.demo"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.merge_into_table(spark, spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), name, "id")
    sinks.merge_into_table(spark, spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string"), name, "id")
    assert rows(spark.table(name)) == [(1, "a"), (2, "B"), (3, "c")]
    sinks.merge_into_table(spark, spark.createDataFrame([(1, "x"), (4, "d")], "id int, v string"), name, "id", insert_only=True)
    assert rows(spark.table(name)) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


# ------------------------------------------------------------------ full refresh, compaction, layout
def test_full_refresh_leaves_no_old_partition(spark, scratch):
    path = os.path.join(scratch, "gold")
    for day in (D(2024, 1, 1), D(2024, 1, 2)):
        sinks.replace_path(spark, spark.createDataFrame([("SKU-1", day)], "sku string, d date"), path, ["d"])
    assert rows(stored(spark, path), "sku", "d") == [("SKU-1", D(2024, 1, 2))]
    assert os.listdir(scratch) == ["gold"]


def test_compaction_keeps_partitions(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.range(600).select("id", (F.col("id") % 7).cast("string").alias("s"), (F.col("id") % 3).cast("int").alias("p"), (F.col("id") % 2).cast("int").alias("q"))
    df.repartition(10).write.partitionBy("p", "q").parquet(path)
    for k, order in enumerate((None, ["id"], ["s", "id"])):
        dest = sinks.compact(spark, path, zorder_by=order, out_path=os.path.join(scratch, f"c{k}"))
        assert sorted(f for f in os.listdir(dest) if "=" in f) == ["p=0", "p=1", "p=2"]
        assert rows(stored(spark, dest), *df.columns) == rows(df)
        assert sinks.file_count(stored(spark, dest)) < sinks.file_count(stored(spark, path))


def test_zorder_of_any_orderable_type(spark):
    df = spark.createDataFrame([(f"store{k % 13}", k, D(2024, 1, 1) + dt.timedelta(days=k % 50), None if k % 9 == 0 else k / 3) for k in range(500)],
                               "store string, n int, d date, x double")
    z = sinks.morton_key(df, ["store", "n", "d", "x"], buckets=16)
    assert z.count() == 500 and z.select("_zorder").distinct().count() > 100
    assert z.filter("_zorder < 0").count() == 0
    wide = sinks.morton_key(df, ["n"] * 1 + ["store", "d", "x"], buckets=1 << 20)  # bits are shared out
    assert wide.filter("_zorder < 0").count() == 0
    alone = sinks.morton_key(df, ["n"], buckets=16).orderBy("n").collect()
    assert [r["_zorder"] for r in alone] == sorted(r["_zorder"] for r in alone)


def test_external_table_registers_partitions(spark, scratch):
    path = os.path.join(scratch, "it's")
    sinks.write_path(spark.range(10).withColumn("p", F.col("id") % 3), path, partition_by=["p"])
    sinks.register_external(spark, "bronze_ext.parts", path)
    assert spark.table("bronze_ext.parts").count() == 10
    spark.sql("DROP TABLE bronze_ext.parts")


def test_expired_partitions_are_removed(spark, scratch):
    path = os.path.join(scratch, "reports")
    df = spark.createDataFrame([(k, D(2024, 1, k)) for k in (1, 2, 3)] + [(9, None)], "v int, d date")
    sinks.write_path(df, path, partition_by=["d"])
    assert sinks.drop_expired(spark, path, "d", D(2024, 1, 3)) == ["d=2024-01-01", "d=2024-01-02"]
    assert rows(stored(spark, path), "v") == [(3,), (9,)]


# ------------------------------------------------------------------ streams (X-03, X-06)
def test_two_streams_and_a_new_checkpoint_write_one_table(spark, scratch):
    tgt = os.path.join(scratch, "silver")
    schema = spark.createDataFrame([], "id string, v int").schema

    def run(name, recs, checkpoint):
        src = os.path.join(scratch, name)
        os.makedirs(src, exist_ok=True)
        with open(os.path.join(src, f"{len(os.listdir(src))}.json"), "w", encoding="utf-8") as fh:
            fh.write("".join(json.dumps(r) + "\n" for r in recs))
        streams.upsert_stream(spark.readStream.schema(schema).json(src), tgt, "id", os.path.join(scratch, checkpoint))

    run("a", [{"id": "x", "v": 1}], "ck1")
    run("b", [{"id": "y", "v": 2}], "ck2")
    run("c", [{"id": "x", "v": 3}], "ck3")
    assert rows(stored(spark, tgt), "id", "v") == [("x", 3), ("y", 2)]


def test_one_feed_definition_for_every_job(spark, scratch):
    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "1.json"), "w", encoding="utf-8") as fh:
        fh.write(json.dumps({"id": "a", "ts": "2024-01-01 10:00:00"}) + "\n")
    schema = spark.createDataFrame([], "id string, ts timestamp_ntz").schema
    feeds = {("web", "events"): streams.Feed("web", "events", schema, land, scratch, partition_by={"day": "ts"})}
    for _ in range(2):
        streams.ingest_feed(spark, feeds, "web", "events")
    assert spark.read.parquet(feeds["web", "events"].target).count() == 1
    with pytest.raises(KeyError):
        streams.ingest_feed(spark, feeds, "web", "clicks")


def test_widened_schema_on_the_same_checkpoint(spark, scratch):
    """R-06: a stream restarted with a wider schema reads the new column of new files."""
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    for k, (rec, ddl) in enumerate([({"id": "a"}, "id string"), ({"id": "b", "extra": 5}, "id string, extra int")]):
        with open(os.path.join(src, f"{k}.json"), "w", encoding="utf-8") as fh:
            fh.write(json.dumps(rec) + "\n")
        stream = readers.read_stream(spark, src, spark.createDataFrame([], ddl).schema)
        stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out).awaitTermination()
    assert rows(stored(spark, out), "id", "extra") == [("a", None), ("b", 5)]


# ------------------------------------------------------------------ incremental silver = rebuild (S-10)
def test_incremental_silver_equals_a_rebuild(spark, scratch):
    bed = Bed(spark, SF_SMOKE)
    feeds = {}
    for n in jobs.BRONZE:  # a few ingest days: every day is a folder
        raw = bed.raw(n)
        day = F.to_date("_ingested_at")
        feeds[n] = raw.where(day.isin([r[0] for r in raw.select(day.alias("d")).distinct().orderBy("d").limit(6).collect()]))
    first = Settings(salt=TEST_SALT, as_of=SALES_AS_OF, root=os.path.join(scratch, "incremental"))
    whole = Settings(salt=TEST_SALT, as_of=SALES_AS_OF, root=os.path.join(scratch, "whole"))
    jobs.bronze_job(spark, first, feeds)
    jobs.silver_job(spark, first)

    later = {n: F.col("_ingested_at") + F.expr("INTERVAL 10000 DAYS") for n in feeds}
    sales, moves = feeds["sales"], feeds["inventory"]
    gone = sales.orderBy("transaction_id").limit(3).withColumn("amount", F.lit(0).cast(sales.schema["amount"].dataType))
    moved = moves.orderBy("movement_id").limit(3).withColumn("product_sku", F.lit("SKU-OTHER"))
    shifted = moves.orderBy(F.desc("movement_id")).limit(3).withColumn("movement_date", F.col("movement_date") + F.expr("INTERVAL 2 DAYS"))
    batch = {"sales": gone.withColumn("_ingested_at", later["sales"]),
             "inventory": moved.unionByName(shifted).withColumn("_ingested_at", later["inventory"]),
             "customers": feeds["customers"]}
    jobs.bronze_job(spark, first, batch)
    jobs.silver_job(spark, first)

    for name in feeds:
        jobs.bronze_job(spark, whole, {name: jobs.read(spark, first, "bronze", name)})
    jobs.silver_job(spark, whole)
    for name in jobs.SILVER:
        a, b = (jobs.read(spark, s, "silver", name) for s in (first, whole))
        cols = [c for c in a.columns if not c.startswith("_")]
        assert rows(a, *cols) == rows(b, *cols), name
    keys = {r[0] for r in gone.select("transaction_id").collect()}
    assert not keys & {r[0] for r in jobs.read(spark, first, "silver", "sales").select("transaction_id").collect()}
    # M-16: history of the customers, repeated without a change
    jobs.snapshot_job(spark, first, dt.datetime(2024, 1, 1))
    history = rows(jobs.snapshot_job(spark, first, dt.datetime(2024, 1, 2)), "customer_id", "valid_to")
    assert len(history) == jobs.read(spark, first, "silver", "customers").count() and all(r[1] is None for r in history)

    # the quality job raises, after its report is stored
    jobs.gold_job(spark, first, bed.events_settings)
    with pytest.raises(quality.DataQualityError, match="freshness_sales"):
        jobs.dq_job(spark, first, "2030-01-01T00:00:00")
    reports = os.path.join(first.root, jobs.REPORTS)
    assert rows(spark.read.parquet(reports), "overall_status") == [("FAILED",)]


# ------------------------------------------------------------------ quality (Q-02)
def test_freshness_gate(spark):
    now = dt.datetime(2024, 1, 2, 12)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    assert quality.assert_fresh(df, "ts", now, 48) is df
    with pytest.raises(quality.DataQualityError, match=r"age_hours\[ts\] = 36.0"):
        quality.assert_fresh(df, "ts", now, 24)
    with pytest.raises(quality.DataQualityError, match="None"):
        quality.assert_fresh(df.limit(0), "ts", now)
