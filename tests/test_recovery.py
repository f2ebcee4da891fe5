"""Stopped writes, tables without rows, pruned merges, appends, catalog merges, incremental jobs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from aurum.config import SALES_AS_OF, TEST_SALT, Settings
from aurum.plans import increments, jobs, silver
from aurum.plans.bed import Bed
from aurum.sources import readers, sinks, tables
from aurum.streaming import streams
from helpers import SF_SMOKE, rows

D = dt.date
KPV = "k string, p string, v int"


class Stopped(Exception):
    pass


class Stop:
    """Lets ``n`` file moves pass and stops before the next one."""

    def __init__(self, monkeypatch, n):
        self.left, self.real = n, tables.rename
        monkeypatch.setattr(tables, "rename", self)

    def __call__(self, spark, src, dest):
        if self.left == 0:
            raise Stopped(f"{src} -> {dest}")
        self.left -= 1
        self.real(spark, src, dest)


def beside(path):
    return sorted(f for f in os.listdir(os.path.dirname(path)) if not f.startswith("."))


# ------------------------------------------------------------------ S-05 / S-07: a stop at any move
def _merge(spark, path, data, **how):
    return sinks.merge_into_path(spark, spark.createDataFrame(data, KPV), path, "k", **how)


@pytest.mark.parametrize("how", [{}, {"partition_by": "p"}, {"partition_by": "p", "insert_only": True}])
def test_a_stop_at_any_move_leaves_the_table_before_or_after(spark, scratch, monkeypatch, how):
    first, second, third = [("a", "x", 1), ("b", "y", 2)], [("a", "z", 10), ("c", "x", 3), ("e", None, 5)], [("d", "y", 4)]
    old = rows(spark.createDataFrame(first, KPV))
    a = ("a", "x", 1) if how.get("insert_only") else ("a", "z", 10)
    new = rows(spark.createDataFrame([a, ("b", "y", 2), *second[1:]], KPV))
    states = set()
    for n in range(30):
        path = os.path.join(scratch, f"t{n}")
        _merge(spark, path, first, **how)
        with monkeypatch.context() as m:
            Stop(m, n)
            try:
                _merge(spark, path, second, **how)
                done = True
            except Stopped:
                done = False
        got = rows(readers.read_table_path(spark, path), "k", "p", "v")  # a reader finishes what was committed
        assert got in (old, new), n
        states.add(got == new)
        if not done:  # the next merge sees all rows
            _merge(spark, path, third, **how)
            assert rows(tables.load(spark, path), "k", "p", "v") == sorted([*got, third[0]], key=repr)
        tables.drop_leftovers(spark, path, older_than_hours=0)
        assert [f for f in beside(path) if f.startswith(f"t{n}_")] == []
        if done:
            break
    assert done and states == {True, False}


def test_a_stop_in_a_full_refresh(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "gold")
    sinks.replace_path(spark, spark.createDataFrame([("a", "x", 1)], KPV), path, ["p"])
    for n in range(10):
        with monkeypatch.context() as m:
            Stop(m, n)
            try:
                sinks.replace_path(spark, spark.createDataFrame([("b", "y", n)], KPV), path, ["p"])
                break
            except Stopped:
                pass
        assert tables.load(spark, path).count() == 1
    assert rows(tables.load(spark, path), "k", "v") == [("b", n)]


def test_a_second_write_does_not_pass_a_committed_one(spark, scratch):
    path = os.path.join(scratch, "t")
    _merge(spark, path, [("a", "x", 1)])
    tables.write_text(spark, f"{path}__commit.json", '{"kind": "whole", "staged": "%s__staged_gone", "old": "%s__staged_gone_old", "drop": [], "folders": []}' % (path, path))
    staged = tables.staged_folder(path)
    spark.createDataFrame([("z", "x", 9)], KPV).write.parquet(staged)
    with pytest.raises(tables.ConcurrentWriteError):
        tables.commit(spark, path, staged, "whole")
    assert rows(tables.load(spark, path), "k") == [("a",)]


# ------------------------------------------------------------------ S-07 / X-06: tables without rows
def test_tables_without_rows_keep_their_schema(spark, scratch):
    path = os.path.join(scratch, "t")
    assert _merge(spark, path, [], partition_by="p").collect() == []
    assert tables.load(spark, path).schema.simpleString() == "struct<k:string,p:string,v:int>"
    _merge(spark, path, [("a", "x", 1)], partition_by="p")
    scope = spark.createDataFrame([("a",)], "k string")
    out = _merge(spark, path, [], partition_by="p", scope=scope)
    assert out.collect() == [] and out.columns == ["k", "p", "v"] and tables.folders(spark, path) == []
    _merge(spark, path, [("b", None, 2)], partition_by="p")
    assert rows(tables.load(spark, path)) == [("b", None, 2)]


def test_a_stream_whose_first_batch_has_no_valid_row(spark, scratch):
    src, tgt = os.path.join(scratch, "in"), os.path.join(scratch, "silver")
    spark.createDataFrame([("a", "x", None)], KPV).write.json(src)
    kind = spark.createDataFrame([], KPV).schema

    def run():
        streams.upsert_stream(spark.readStream.schema(kind).json(src), tgt, "k", os.path.join(scratch, "ck"), lambda b: b.where("v IS NOT NULL"), partition_by="p")

    run()
    assert tables.load(spark, tgt).collect() == []
    spark.createDataFrame([("b", "y", 2)], KPV).write.mode("append").json(src)
    run()
    assert rows(tables.load(spark, tgt)) == [("b", "y", 2)]


# ------------------------------------------------------------------ S-07 / J-05: pruned merges
def test_a_small_merge_reads_few_partitions(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    df = spark.range(2000).select("id", (F.col("id") / 20).cast("int").alias("p"), F.lit(0).alias("v"))
    sinks.merge_into_path(spark, df, path, "id", partition_by="p")
    assert len(tables.folders(spark, path)) == 100
    source = spark.createDataFrame([(i, 5 + (i > 500), 1) for i in range(100, 105)] + [(i, 7, 1) for i in range(1000, 1005)], "id long, p int, v int")
    possible, few = tables.possible_partitions(spark, path, source, "id", False)
    assert possible == sorted(possible) == ["p=5", "p=50"] and len(few) == 10
    looked = tables.in_partitions(tables.load(spark, path), "p", [tables.value_of(n) for n in possible])
    plan = looked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p#" in plan and "IN (5,50)" in plan  # other folders are not listed
    assert {r[0].split("/p=")[1].split("/")[0] for r in looked.select(F.input_file_name()).distinct().collect()} == {"5", "50"}
    stamps = {n: os.stat(os.path.join(path, n)).st_ino for n in tables.folders(spark, path)}
    sinks.merge_into_path(spark, source, path, "id", partition_by="p")
    after = {n: os.stat(os.path.join(path, n)).st_ino for n in tables.folders(spark, path)}
    assert {n for n in after if after[n] != stamps[n]} == {"p=5", "p=7", "p=50"}
    got = tables.load(spark, path)
    assert got.count() == 2000 and got.where("v = 1").count() == 10 and got.where("v = 1 AND p = 7").count() == 5
    # the ranges follow the rows
    assert "p=7" in tables.possible_partitions(spark, path, source.where("id > 999"), "id", False)[0]


@pytest.mark.parametrize("kind,make", [("string", lambda i: f"k{i:04}é"), ("date", lambda i: D(2020, 1, 1) + dt.timedelta(days=i)), ("decimal(9,2)", lambda i: i / 4), ("double", float)])
def test_ranges_of_other_key_types_lose_no_match(spark, scratch, kind, make):
    from decimal import Decimal
    value = (lambda i: Decimal(make(i))) if kind.startswith("decimal") else make
    path = os.path.join(scratch, "t")
    ddl = f"k {kind}, p int, v int"
    sinks.merge_into_path(spark, spark.createDataFrame([(value(i), i // 10, 0) for i in range(60)], ddl), path, "k", partition_by="p")
    sinks.merge_into_path(spark, spark.createDataFrame([(value(i), 9, 1) for i in (3, 27, 59, 70)], ddl), path, "k", partition_by="p")
    assert tables.load(spark, path).count() == 61 and tables.load(spark, path).where("v = 1").count() == 4


def test_many_source_keys_are_compared_by_ranges(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.range(6000).select("id", (F.col("id") / 500).cast("int").alias("p"), F.lit(0).alias("v"))
    sinks.merge_into_path(spark, df, path, "id", partition_by="p")
    source = spark.range(2000, 3500).select("id", F.lit(99).alias("p"), F.lit(1).alias("v"))
    possible, few = tables.possible_partitions(spark, path, source, "id", False)
    assert few is None and sorted(possible) == ["p=4", "p=5", "p=6"]
    sinks.merge_into_path(spark, source, path, "id", partition_by="p")
    assert tables.load(spark, path).count() == 6000 and tables.load(spark, path).where("p = 99").count() == 1500


# ------------------------------------------------------------------ S-08 / J-07
def test_insert_only_appends_files(spark, scratch):
    path = os.path.join(scratch, "t")
    first = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), (None, "x", 0)], KPV)
    sinks.merge_into_path(spark, first, path, "k", partition_by="p", insert_only=True)

    def files():
        return {f for d, _, names in os.walk(path) for f in names if f.startswith("part-")}

    before = files()
    src = spark.createDataFrame([("a", "z", 9), ("c", "x", 3, )], KPV).withColumn("w", F.lit("new"))
    for _ in range(2):
        sinks.merge_into_path(spark, src, path, "k", partition_by="p", insert_only=True)
        assert before < files()
    assert rows(tables.load(spark, path), "k", "p", "v", "w") == [("a", "x", 1, None), ("b", "y", 2, None), ("c", "x", 3, "new"), (None, "x", 0, None)]
    plan = sinks.upsert(first, src, "k", insert_only=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "LeftAnti" in plan


# ------------------------------------------------------------------ S-09
def test_merge_by_name_keeps_documentation_and_shuffles_the_source_only(spark, monkeypatch):
    name = "silver_merge.documented"
    for n in (name, f"{name}__next", f"{name}__old"):
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    sinks.merge_into_table(spark, spark.range(100).selectExpr("id", "id * 2 AS v"), name, "id", buckets=4)
    spark.sql(f"COMMENT ON TABLE {name} IS 'it''s documented'")
    spark.sql(f"ALTER TABLE {name} ALTER COLUMN v COMMENT 'twice'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = 'silver')")
    sinks.merge_into_table(spark, spark.createDataFrame([(5, 0), (500, 1)], "id long, v long"), name, "id")
    assert spark.table(name).count() == 101 and rows(spark.table(name).where("id = 5")) == [(5, 0)]
    assert spark.catalog.getTable(name).description == "it's documented"
    assert {c.name: c.description for c in spark.catalog.listColumns(name)} == {"id": None, "v": "twice"}
    assert sinks._properties(spark, name)["quality"] == "silver" and sinks.COMPLETE not in sinks._properties(spark, name)
    assert sinks._buckets(spark, name) == (4, ["id"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sinks.upsert(spark.table(name), spark.range(50).selectExpr("id", "id AS v"), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= 1
    assert not spark.catalog.tableExists(f"{name}__next") and not spark.catalog.tableExists(f"{name}__old")


def test_a_stop_between_the_renames_of_a_merge_by_name(spark):
    name = "silver_merge.stopped"
    for n in (name, f"{name}__next", f"{name}__old"):
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    sinks.merge_into_table(spark, spark.createDataFrame([(1, "a")], "id int, v string"), name, "id")
    # as a stop after the first rename leaves it
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.saveAsTable(f"{name}__next")
    spark.sql(f"ALTER TABLE {name}__next SET TBLPROPERTIES ('{sinks.COMPLETE}' = 'true')")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    sinks.merge_into_table(spark, spark.createDataFrame([(3, "c")], "id int, v string"), name, "id")
    assert rows(spark.table(name)) == [(1, "a"), (2, "b"), (3, "c")]
    # as a stop while the next version was written leaves it
    spark.createDataFrame([(9, "z")], "id int, v string").write.saveAsTable(f"{name}__next")
    sinks.merge_into_table(spark, spark.createDataFrame([(4, "d")], "id int, v string"), name, "id")
    assert rows(spark.table(name), "id") == [(1,), (2,), (3,), (4,)]


# ------------------------------------------------------------------ S-14
def test_compaction_in_place(spark, scratch):
    path = os.path.join(scratch, "t")
    for i in range(4):
        sinks.merge_into_path(spark, spark.range(i * 10, i * 10 + 10).selectExpr("id", "CAST(id % 2 AS int) AS p"), path, "id", partition_by="p", insert_only=True)
    before, n = rows(tables.load(spark, path)), sinks.file_count(tables.load(spark, path))
    assert sinks.compact(spark, path, zorder_by=["id"], in_place=True) == path
    assert rows(tables.load(spark, path)) == before and sinks.file_count(tables.load(spark, path)) < n
    assert beside(path) == ["t"]
    assert sorted(tables.possible_partitions(spark, path, spark.createDataFrame([(4,)], "id long"), "id", False)[0]) == ["p=0", "p=1"]


# ------------------------------------------------------------------ bronze batches
def test_equal_rows_of_two_batches_stay_and_a_retried_batch_adds_none(spark, scratch):
    path = os.path.join(scratch, "b")
    kind = "id string, d date"
    one = spark.createDataFrame([("a", D(2024, 1, 1)), ("a", D(2024, 1, 1)), ("n", None)], kind)
    for _ in range(2):
        sinks.append_batch(spark, one, path, ["d"], "2024-01-01")
    assert tables.load(spark, path).count() == 3
    sinks.append_batch(spark, one, path, ["d"], "2024-01-02")
    assert rows(tables.load(spark, path), "id") == [("a",)] * 4 + [("n",)] * 2
    # without an id a batch is named by its rows, in any order
    assert sinks.content_id(one) == sinks.content_id(one.repartition(3)) != sinks.content_id(one.limit(2))
    assert sinks.append_batch(spark, one, os.path.join(scratch, "c"), ["d"]) and not sinks.append_batch(spark, one.orderBy("id"), os.path.join(scratch, "c"), ["d"])


def test_a_stopped_append_is_finished_once(spark, scratch, monkeypatch):
    one = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 2)), ("c", None)], "id string, d date")
    for n in range(12):
        path = os.path.join(scratch, f"b{n}")
        sinks.append_batch(spark, one, path, ["d"], "first")
        with monkeypatch.context() as m:
            Stop(m, n)
            try:
                sinks.append_batch(spark, one, path, ["d"], "second")
                done = True
            except Stopped:
                done = False
        sinks.append_batch(spark, one, path, ["d"], "second")
        assert rows(tables.load(spark, path), "id") == [("a",)] * 2 + [("b",)] * 2 + [("c",)] * 2, n
        if done:
            break
    assert done


# ------------------------------------------------------------------ S-10: sensors and stock
def readings(spark, data):
    kind = ("device_id string, sensor_type string, reading_value double, reading_unit string, battery_level int, firmware_version string, "
            "reading_timestamp timestamp_ntz, surrogate_key string, _loaded_at timestamp_ntz")
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(f"d{i % 7}", s, v, u, 50, "1", t0 + dt.timedelta(hours=h), f"{i}-{h}-{s}", t0 + dt.timedelta(days=load))
                                  for i, s, v, u, h, load in data], kind)


def test_sensor_increments_equal_a_rebuild_with_repeats_and_moved_units(spark, settings):
    import random
    rng = random.Random(5)
    base = [(i, rng.choice("ab"), rng.gauss(10, 3), rng.choice(["C", "F"]), rng.randrange(24 * 6), 1) for i in range(300)]
    base += [(1000 + i, "const", 0.1, "V", i * 20, 1) for i in range(9)] + [(2000, "one", 3.0, None, 5, 1), (2001, "null", None, "x", 5, 1)]
    later = [(i, s, v * 40, u, h, 3) for i, s, v, u, h, _ in base[:5]]  # sent again, changed
    later += [(i, s, v, "F" if u == "C" else "C", h, 3) for i, s, v, u, h, _ in base[5:12]]  # the unit moved
    later += [base[20][:5] + (3,), base[20][:5] + (3,)]  # repeated within the batch
    later += [(5000 + i, "new", float(i), "C", 24 * 9 + i, 3) for i in range(4)] + [(6000, "const", 0.1, "V", 200, 3)]
    late = [(i, s, 1e6, u, h, 0) for i, s, v, u, h, _ in base[30:33]]  # an older version arrives late
    first, batch = readings(spark, base), readings(spark, later + late)
    stored_rows = increments.latest_readings(first)
    moments = increments.day_moments(stored_rows)
    stored = silver.iot_readings_validated(stored_rows, settings, stats=increments.merged_stats(moments))
    change = increments.sensor_changes(stored, moments, batch)
    again = increments.rescored(increments.only(stored, change.days), batch, change.stats, settings)
    got = increments.only(stored, change.days, "left_anti").unionByName(again)
    want = silver.iot_readings_validated(increments.latest_readings(first.unionByName(batch)), settings)
    assert rows(got, *want.columns) == rows(want)
    assert got.count() == got.select("surrogate_key").distinct().count()
    assert got.where("sensor_type = 'const' AND (z_score <> 0 OR is_outlier)").count() == 0


def test_stock_goes_on_from_the_stored_balance(spark):
    kind = "movement_id string, product_sku string, warehouse_id string, movement_type string, quantity int, movement_date timestamp_ntz, _loaded_at timestamp_ntz"
    t0 = dt.datetime(2024, 1, 1)

    def moves(data):
        return spark.createDataFrame([(m, s, w, t, q, None if d is None else t0 + dt.timedelta(days=d), t0 + dt.timedelta(days=load)) for m, s, w, t, q, d, load in data], kind)

    base = [(f"m{i}", f"s{i % 3}", None if i % 5 == 0 else "w", ["INBOUND", "OUTBOUND", "ADJUSTMENT", "TRANSFER"][i % 4], (-1) ** i * (i % 7 + 1), None if i == 17 else i % 11, 1) for i in range(60)]
    batch = [("m3", "s0", "w", "INBOUND", 9, 2, 5), ("m4", "s9", "w", "OUTBOUND", 1, 4, 5), ("m17", "s2", "w", "INBOUND", 3, 8, 5),
             ("new1", "s1", "w", "INBOUND", 100, 5, 5), ("new2", "s1", "w", "INBOUND", 7, None, 5), ("m8", "s2", "w", "INBOUND", 50, 1, 0), (None, "s7", "w", "INBOUND", 1, 1, 5)]
    first, then = moves(base), moves(batch)
    movements = silver.latest_movements(first)
    stored = silver.running_stock(silver.daily_flows(movements))
    now, starts = increments.movement_changes(movements, then)
    got = increments.stock_kept(stored, starts).unionByName(increments.stock_rows(stored, movements, now, starts))
    want = silver.inventory_snapshots(first.unionByName(then))
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("few", [-1, 1 << 40])
def test_stock_rows_shuffle_a_pair_once_and_no_keys(spark, monkeypatch, few):
    kind = "movement_id string, product_sku string, warehouse_id string, movement_type string, quantity int, movement_date timestamp_ntz, _loaded_at timestamp_ntz"
    t0 = dt.datetime(2024, 1, 1)

    def moves(span, load):
        return spark.createDataFrame([(f"m{i}" if i % 13 else None, None if i % 4 == 0 else f"s{i % 3}", None if i % 5 == 0 else "w", ["INBOUND", "OUTBOUND", "TRANSFER"][i % 3],
                                       i % 7 + load, None if i % 17 == 0 else t0 + dt.timedelta(days=i * load % 19), t0 + dt.timedelta(days=load)) for i in span], kind)

    first, then = moves(range(80), 1), moves(range(50, 100, 3), 2)
    monkeypatch.setattr(increments, "FEW", few)
    tables_ = {}

    def store(name):
        return lambda df: tables_.setdefault(name, sinks.cut(df, name))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        movements = sinks.cut(silver.latest_movements(first), "movements")
        flows = silver.daily_flows(movements)
        plan = silver.running_stock(flows)._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("sha2(") < plan.index("Exchange hashpartitioning("), plan  # before: keys were shuffled
        stored = sinks.cut(silver.running_stock(flows), "stock")
        now, starts = increments.movement_changes(movements, then, store=store("now"))
        starts = sinks.cut(starts, "starts")
        new = increments.stock_rows(stored, movements, now, starts, store=store("flows"))
        sinks.discard(movements, now)  # nothing reads them any more
        plan = new._jdf.queryExecution().executedPlan().toString()
        # flows, stored balances, and the starts for each of the two; before: flows three times, with their keys
        assert plan.count("Exchange hashpartitioning(") == plan.count("Exchange hashpartitioning(__pair") <= 4, plan
        assert plan.rindex("sha2(") < plan.index("Exchange hashpartitioning("), plan
        want = silver.inventory_snapshots(first.unionByName(then))
        assert rows(increments.stock_kept(stored, starts).unionByName(new), *want.columns) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jobs_with_changed_readings_and_movements_equal_a_rebuild(spark, scratch):
    bed = Bed(spark, SF_SMOKE)
    raw = {n: bed.raw(n) for n in jobs.BRONZE}
    day = F.to_date("_ingested_at")
    feeds = {n: df.where(day.isin([r[0] for r in df.select(day.alias("d")).distinct().orderBy("d").limit(5).collect()])) for n, df in raw.items()}
    one, whole = (Settings(salt=TEST_SALT, as_of=SALES_AS_OF, root=os.path.join(scratch, x)) for x in ("one", "whole"))
    jobs.bronze_job(spark, one, feeds, "first")
    jobs.silver_job(spark, one)
    later = F.col("_ingested_at") + F.expr("INTERVAL 10000 DAYS")
    iot, moves = feeds["iot"], feeds["inventory"]
    again = iot.orderBy("device_id", "reading_timestamp").limit(4)
    batch = {"iot": again.withColumn("reading_value", F.col("reading_value") * 50).unionByName(again.limit(2).withColumn("reading_timestamp", F.col("reading_timestamp") + F.expr("INTERVAL 40 DAYS")))
             .withColumn("_ingested_at", later),
             "inventory": moves.orderBy(F.desc("movement_date"), "movement_id").limit(5).withColumn("quantity", F.col("quantity") + 3).withColumn("_ingested_at", later),
             "customers": feeds["customers"]}
    jobs.bronze_job(spark, one, batch, "second")
    jobs.bronze_job(spark, one, batch, "second")  # a retry
    days = {n: os.stat(os.path.join(one.root, "silver", *jobs.SILVER["inventory"], n)).st_ino
            for n in tables.folders(spark, os.path.join(one.root, "silver", *jobs.SILVER["inventory"]))}
    jobs.silver_job(spark, one)
    after = {n: os.stat(os.path.join(one.root, "silver", *jobs.SILVER["inventory"], n)).st_ino for n in days}
    assert any(days[n] == after[n] for n in days)  # days before the first touched one stay as they are
    for name in feeds:
        jobs.bronze_job(spark, whole, {name: jobs.read(spark, one, "bronze", name)}, "all")
    jobs.silver_job(spark, whole)
    for name in jobs.SILVER:
        a, b = (jobs.read(spark, s, "silver", name) for s in (one, whole))
        cols = [c for c in a.columns if not c.startswith("_")]
        assert rows(a, *cols) == rows(b, *cols), name


# ------------------------------------------------------------------ S-11 / M-16
def test_closed_history_files_are_not_touched(spark, scratch):
    s = Settings(salt=TEST_SALT, as_of=SALES_AS_OF, root=scratch)
    path = os.path.join(scratch, "silver", *jobs.SILVER["customers"])
    kind = "customer_id string, " + ", ".join(f"{c} string" for c in jobs.SNAPSHOT_COLUMNS)

    def run(at, data):
        sinks.replace_path(spark, spark.createDataFrame([(k, *[v] * len(jobs.SNAPSHOT_COLUMNS)) for k, v in data], kind), path)
        return jobs.snapshot_job(spark, s, at)

    def closed():
        top = os.path.join(scratch, "silver", *jobs.SNAPSHOT, "is_current=false")
        return {f: os.stat(os.path.join(top, f)).st_mtime_ns for f in os.listdir(top) if f.startswith("part-")} if os.path.isdir(top) else {}

    run(dt.datetime(2024, 1, 1), [("a", "1"), ("b", "1"), ("c", "1")])
    assert closed() == {}
    run(dt.datetime(2024, 1, 2), [("a", "2"), ("b", "1")])
    first = closed()
    assert first
    history = run(dt.datetime(2024, 1, 3), [("a", "3"), ("b", "1"), ("c", "9")])
    assert first.items() < closed().items()
    got = rows(history, "customer_id", "loyalty_tier", F.dayofmonth("valid_from"), F.dayofmonth("valid_to"), "is_current")
    assert got == [("a", "1", 1, 2, False), ("a", "2", 2, 3, False), ("a", "3", 3, None, True), ("b", "1", 1, None, True), ("c", "1", 1, 2, False), ("c", "9", 3, None, True)]
    before = rows(history, "customer_id", "valid_to")
    assert rows(run(dt.datetime(2024, 1, 4), [("a", "3"), ("b", "1"), ("c", "9")]), "customer_id", "valid_to") == before


def test_sessions_are_counted_without_copies_of_rows(spark):
    plan = Bed(spark, SF_SMOKE).sessions._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_the_pick_carries_no_derived_columns(spark):
    from aurum.plans import gold
    plan = gold.daily_demand(Bed(spark, SF_SMOKE).sales)._jdf.queryExecution().optimizedPlan().toString()
    pick = next(line for line in plan.splitlines() if "max(struct" in line.lower() or "max(named_struct" in line.lower() or "max(" in line)
    assert "sha2" not in pick and "current_user" not in pick
