"""Schema registry of streams (R-06) and the change feed of stored tables (R-09)."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aurum.operators import diff
from aurum.sources import sinks, tables
from aurum.streaming import registry, streams
from helpers import rows


def schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def drop(folder, name, recs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write("".join(json.dumps(r) + "\n" for r in recs))


def test_a_feed_gains_a_column_without_another_schema(spark, scratch):
    land = os.path.join(scratch, "landing")
    feed = streams.Feed("web", "events", schema(spark, "id string, n int"), land, scratch)
    feeds = {("web", "events"): feed}
    drop(land, "1.json", [{"id": "a", "n": 1}])
    streams.ingest_feed(spark, feeds, "web", "events")
    drop(land, "2.json", [{"id": "b", "n": 2, "extra": "x", "more": {"k": 1}}])
    streams.ingest_feed(spark, feeds, "web", "events")
    streams.ingest_feed(spark, feeds, "web", "events")
    got = streams.read_feed(spark, feed)
    assert rows(got, "id", "n", "extra", "more.k") == [("a", 1, None, None), ("b", 2, "x", 1)]
    version, now, _ = feed.registry.latest(spark)
    assert now.names == ["id", "n", "extra", "more"] and version >= 2
    assert "_source_name" in got.columns


def test_versions_widen_and_never_narrow(spark, scratch):
    r = registry.SchemaRegistry(os.path.join(scratch, "s"))
    r.register(spark, schema(spark, "a int, b float, c struct<x:int>"))
    r.register(spark, schema(spark, "a bigint, c struct<x:int,y:string>"))
    r.register(spark, schema(spark, "a int"))
    assert r.latest(spark)[:2] == (2, StructType.fromJson(json.loads(schema(spark, "a bigint, b float, c struct<x:int,y:string>").json())))
    assert r.versions(spark) == ["v00000001.json", "v00000002.json"]
    with pytest.raises(registry.SchemaConflict):
        r.register(spark, schema(spark, "a string"))


def test_only_files_since_the_last_look_are_inferred(spark, scratch):
    land = os.path.join(scratch, "landing")
    r = registry.SchemaRegistry(os.path.join(scratch, "s"))
    assert r.evolve(spark, land, schema(spark, "id string")).names == ["id"]  # nothing landed yet
    drop(land, "1.json", [{"id": "a", "old": 1}])
    old = time.time() - 3600
    os.utime(os.path.join(land, "1.json"), (old, old))
    r.evolve(spark, land, schema(spark, "id string"))
    drop(land, "2.json", [{"id": 5, "new": 1.5}])
    assert r.evolve(spark, land, schema(spark, "id string")).names[-1] == "new"


def test_unchanged_partitions_are_not_read(spark, scratch):
    a, b = (os.path.join(scratch, x) for x in "ab")
    df = spark.range(100).select("id", (F.col("id") % 10).cast("int").alias("p"), F.lit("x").alias("v"))
    for path in (a, b):
        sinks.merge_into_path(spark, df, path, "id", partition_by="p")
    assert diff.changed_partitions(tables.table_meta(spark, a), tables.table_meta(spark, b)) == []
    change = spark.createDataFrame([(3, 3, "y"), (500, 4, "new")], "id long, p int, v string")
    sinks.merge_into_path(spark, change, b, "id", partition_by="p")
    sinks.merge_into_path(spark, spark.createDataFrame([], "id long, p int, v string"), b, "id", partition_by="p", scope=spark.createDataFrame([(17,)], "id long"))
    assert sorted(diff.changed_partitions(tables.table_meta(spark, a), tables.table_meta(spark, b))) == ["3", "4", "7"]
    got = diff.table_changes(spark, a, b, "id")
    assert rows(got, "id", "v", "_change_type") == [(17, "x", "delete"), (3, "x", "update_preimage"), (3, "y", "update_postimage"), (500, "new", "insert")]
    assert {r[0] for r in got.select("_commit_version").distinct().collect()} == {3}
    assert got.where("_commit_timestamp IS NULL OR _commit_timestamp < TIMESTAMP '2024-01-01'").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [p#") == 2


def test_fingerprints_add_up_and_ignore_added_columns(spark, scratch):
    a, b = (os.path.join(scratch, x) for x in "ab")
    one, two = (spark.range(x, x + 20).select("id", F.lit(1).alias("p")) for x in (0, 20))
    sinks.merge_into_path(spark, one.unionByName(two), a, "id", partition_by="p")
    for df in (one, two):
        sinks.merge_into_path(spark, df, b, "id", partition_by="p", insert_only=True)
    assert diff.changed_partitions(*(tables.table_meta(spark, x) for x in (a, b))) == []
    sinks.merge_into_path(spark, spark.createDataFrame([(99, 2, "n")], "id long, p int, extra string"), b, "id", partition_by="p")
    assert diff.changed_partitions(*(tables.table_meta(spark, x) for x in (a, b))) == ["2"]
    assert rows(diff.table_changes(spark, a, b, "id"), "id", "extra", "_change_type") == [(99, "n", "insert")]
