"""Table operators on hand-made edge rows (FIXTURES §4) and properties
(SURVEY §5.2): dedup, upsert, SCD2, snapshot diff, quality checks."""

import datetime as dt
import glob
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from aurum.operators import diff, quality, scd, upsert
from aurum.operators.dedup import dedup_latest, duplicate_keys
from helpers import rows

T = dt.datetime


# ------------------------------------------------------------------ dedup (W-01)
def test_dedup_tie_null_key_single_and_empty(spark):
    df = spark.createDataFrame([
        ("a", T(2020, 1, 1), 1), ("a", T(2020, 1, 2), 2), ("a", T(2020, 1, 2), 3),  # tie on order col
        (None, T(2020, 1, 1), 4), (None, T(2020, 1, 3), 5),  # NULL key: one group
        ("b", T(2020, 1, 1), 6),  # single row
    ], "k string, ts timestamp_ntz, v int")
    out = rows(dedup_latest(df, "k", "ts"))
    assert out == sorted([("a", T(2020, 1, 2), 3), (None, T(2020, 1, 3), 5), ("b", T(2020, 1, 1), 6)], key=repr)
    assert dedup_latest(df.limit(0), "k", "ts").count() == 0
    assert rows(dedup_latest(df, "k", "ts", drop_null_keys=True), "k") == [("a",), ("b",)]


def test_dedup_strategies_agree_on_hot_key(spark):
    # one key holds a third of all rows
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        (F.col("id") % 50).cast("int").alias("ord"), F.col("id").alias("v"))
    a = rows(dedup_latest(df, "k", "ord", strategy="aggregate"))
    w = rows(dedup_latest(df, "k", "ord", strategy="window"))
    assert a == w
    keys = dedup_latest(df, "k", "ord").groupBy("k").count().filter("count > 1").count()
    assert keys == 0  # property: output keys unique
    assert dedup_latest(df, "k", "ord").count() == df.select("k").distinct().count()


def test_dedup_plan_is_partial_aggregate_without_python(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = dedup_latest(df, "k", "ts")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    wplan = dedup_latest(df, "k", "ts", strategy="window")._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in wplan


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, d int")
    assert rows(duplicate_keys(df, ["k", "d"])) == [("a", 1, 2)]


# ------------------------------------------------------------------ upsert (S-07…S-10)
@pytest.fixture()
def tgt(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "id int, name string, amt int")


def test_upsert_full_partial_insert_only(spark, tgt):
    src = spark.createDataFrame([(2, "B", 21), (3, "c", 30), (None, "m", 1)], "id int, name string, amt int")
    full = rows(upsert.upsert(tgt, src, "id"))
    assert full == rows(spark.createDataFrame(
        [(1, "a", 10), (2, "B", 21), (3, "c", 30), (None, "n", 0), (None, "m", 1)], tgt.schema))
    part = rows(upsert.upsert(tgt, src, "id", update_columns=["amt"]))
    assert (2, "b", 21) in part and (3, "c", 30) in part
    ins = rows(upsert.upsert(tgt, src, "id", insert_only=True))
    assert (2, "b", 20) in ins and (3, "c", 30) in ins and (2, "B", 21) not in ins


def test_upsert_new_column_and_empty_source(spark, tgt):
    src = spark.createDataFrame([(1, "A", 11, "x")], "id int, name string, amt int, tag string")
    out = upsert.upsert(tgt, src, "id")
    assert "tag" in out.columns and rows(out.filter("id = 1"), "tag") == [("x",)]
    assert rows(upsert.upsert(tgt, src.limit(0), "id"), *tgt.columns) == rows(tgt)


def test_upsert_idempotent_and_duplicate_keys_raise(spark, tgt):
    src = spark.createDataFrame([(2, "B", 21), (3, "c", 30)], "id int, name string, amt int")
    once = upsert.upsert(tgt, src, "id")
    assert rows(upsert.upsert(once, src, "id")) == rows(once)
    dup = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "id int, name string, amt int")
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.assert_unique_keys(dup, "id")


def test_incremental_batch_and_schema_sync(spark):
    tgt = spark.createDataFrame([(1, T(2020, 1, 1))], "id int, _loaded_at timestamp_ntz")
    src = spark.createDataFrame([(1, T(2020, 1, 1)), (2, T(2020, 1, 2))], tgt.schema)
    assert rows(upsert.incremental_batch(src, tgt), "id") == [(2,)]
    assert upsert.incremental_batch(src, None).count() == 2
    df = spark.createDataFrame([(1, "x")], "a int, new string")
    assert upsert.sync_schema(df, ["a", "old"], "sync_all_columns").columns == ["a", "old"]
    assert upsert.sync_schema(df, ["a", "old"]).columns == ["a", "old", "new"]


# ------------------------------------------------------------------ SCD2 (S-11, R-10)
def test_scd2_history_noop_same_ts_and_reappearing(spark):
    ch = spark.createDataFrame([
        ("c1", T(2020, 1, 1), "gold"), ("c1", T(2020, 1, 2), "gold"),  # no-op change dropped
        ("c1", T(2020, 1, 3), "silver"), ("c1", T(2020, 1, 3), "bronze"),  # same ts: one wins
        ("c1", T(2020, 1, 5), "gold"),  # value re-appears: new version
    ], "id string, ts timestamp_ntz, tier string")
    h = scd.scd2_history(ch, "id", "ts", ["tier"]).orderBy("valid_from").collect()
    assert [r["valid_from"] for r in h] == [T(2020, 1, 1), T(2020, 1, 3), T(2020, 1, 5)]
    assert [r["valid_to"] for r in h] == [T(2020, 1, 3), T(2020, 1, 5), None]
    assert h[-1]["is_current"] and not h[0]["is_current"]
    # intervals never overlap
    for a, b in zip(h, h[1:]):
        assert a["valid_to"] == b["valid_from"]
    hist = scd.scd2_history(ch, "id", "ts", ["tier"])
    assert rows(scd.as_of(hist, T(2020, 1, 4)), "tier") in ([("silver",)], [("bronze",)])


def test_scd2_merge_changes_and_hard_delete(spark):
    ch = spark.createDataFrame([("a", T(2020, 1, 1), "x"), ("b", T(2020, 1, 1), "y")],
                               "id string, ts timestamp_ntz, tier string")
    h = scd.scd2_history(ch, "id", "ts", ["tier"])
    snap = spark.createDataFrame([("a", "x2"), ("c", "z")], "id string, tier string")
    m = scd.scd2_merge(h, snap, "id", ["tier"], T(2020, 2, 1))
    cur = rows(m.filter("is_current"), "id", "tier")
    assert cur == [("a", "x2"), ("c", "z")]  # b hard-deleted → closed
    closed = rows(m.filter("not is_current"), "id", "valid_to")
    assert closed == [("a", T(2020, 2, 1)), ("b", T(2020, 2, 1))]
    keep = scd.scd2_merge(h, snap, "id", ["tier"], T(2020, 2, 1), invalidate_hard_deletes=False)
    assert ("b", "y") in rows(keep.filter("is_current"), "id", "tier")


# ------------------------------------------------------------------ snapshot diff (R-09)
def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id int, v string")
    out = rows(diff.snapshot_diff(old, new, "id"), "id", "v", "_change_type")
    assert out == sorted([(2, "b", "update_preimage"), (2, "B", "update_postimage"), (3, "c", "delete"),
                          (4, "d", "insert")], key=repr)


# ------------------------------------------------------------------ quality (Q-01…Q-10)
def test_null_ratio_empty_and_threshold(spark):
    empty = spark.createDataFrame([], "a int")
    assert rows(quality.null_ratio(empty), "null_pct", "passed") == [(0.0, True)]
    df = spark.createDataFrame([(None,)] * 5 + [(1,)] * 95, "a int")
    assert rows(quality.null_ratio(df, threshold_pct=5.0), "passed") == [(True,)]  # exactly 5 % passes
    df2 = spark.createDataFrame([(None,)] * 6 + [(1,)] * 94, "a int")
    with pytest.raises(quality.DataQualityError):
        quality.assert_null_ratio(df2, ["a"])


def test_freshness_statuses(spark):
    now = T(2024, 1, 3, 0, 0)
    for hours, status in [(23, "pass"), (25, "warn"), (49, "fail")]:
        df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "ts timestamp_ntz")
        assert quality.freshness(df, "ts", now).collect()[0]["status"] == status
    assert quality.freshness(spark.createDataFrame([], "ts timestamp_ntz"), "ts", now).collect()[0]["status"] == "fail"


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x")], "a int, extra string")
    with pytest.raises(quality.DataQualityError):
        quality.assert_schema(df, ["a", "missing"])
    d = quality.schema_drift(df, ["a"])
    assert d.extra == ["extra"] and not d.missing
    quality.assert_schema(df, ["a"])  # extra columns only warn


def test_report_and_trend_roundtrip(spark):
    checks = spark.createDataFrame([("c1", True, "ok"), ("c2", False, "bad")], "name string, passed boolean, detail string")
    rep = quality.report(checks, "2024-01-05T10:00:00+00:00", "dev")
    assert rep.collect()[0]["overall_status"] == "FAILED"
    with pytest.raises(quality.DataQualityError):
        quality.raise_on_failure(checks)
    tr = rows(quality.dq_trend(rep.select("value")), "check_name", "failure_count", "total_runs", "failure_rate_pct")
    assert tr == [("c1", 0, 1, 0.0), ("c2", 1, 1, 100.0)]


def test_not_null_and_unique_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(quality.not_null_violations(df, "k", "m", "k"), "model") == [("m",)]
    assert rows(quality.unique_violations(df, "k", "m"), "value", "copies") == [("a", 2)]


def test_retention(spark):
    df = spark.createDataFrame([(T(2024, 1, 1),), (T(2024, 1, 9),)], "ts timestamp_ntz")
    assert rows(quality.retention(df, "ts", T(2024, 1, 10), 168), "ts") == [(T(2024, 1, 9),)]


# ---------------------------------------------------------------- E-04 FIFO valuation
def _fifo(spark, data):
    from aurum.operators.fifo import fifo_value
    df = spark.createDataFrame(data, "item string, day int, in_qty bigint, in_cost bigint, out_qty bigint")
    v = fifo_value(df, ["item"], "day", "in_qty", "in_cost", "out_qty", value_col="value")
    return {(r.item, r.day): (r._received - r._issued, r.value) for r in v.collect()}


def test_fifo_layers_partial_backlog_and_rounding(spark):
    got = _fifo(spark, [
        ("A", 1, 10, 1000, 0),   # layer 10 @ 100
        ("A", 2, 5, 750, 12),    # layer 5 @ 150; issue 12 → 3 @ 150 left
        ("A", 3, 0, 0, 4),       # issue past stock: nothing left, backlog 1
        ("A", 4, 3, 10, 0),      # layer 3 @ 3.33; backlog takes 1 (3 after HALF_UP)
        ("A", 5, 0, 0, 1),       # 2 of the 3 consumed: round(6.67) = 7
        ("B", 1, 0, 0, 5),       # issues only
        ("C", 1, 4, 0, 0),       # free goods
    ])
    assert got == {("A", 1): (10, 1000), ("A", 2): (3, 450), ("A", 3): (-1, 0), ("A", 4): (2, 7),
                   ("A", 5): (1, 3), ("B", 1): (-5, 0), ("C", 1): (4, 0)}


def test_fifo_matches_layer_by_layer_brute_force(spark):
    import random
    rnd = random.Random(7)
    data = []
    for item in "PQRS":
        for day in range(1, 40):
            q = rnd.choice([0, 0, rnd.randint(1, 30)])
            data.append((item, day, q, q * rnd.randint(1, 999) + rnd.randint(0, 5) if q else 0,
                         rnd.choice([0, rnd.randint(1, 25)])))
    got = _fifo(spark, data)
    for item in "PQRS":
        layers, received, received_cost, issued = [], 0, 0, 0
        for _, day, q, k, out in sorted(r for r in data if r[0] == item):
            if q:
                layers.append((q, k))
            received, received_cost, issued = received + q, received_cost + k, issued + out
            left, consumed = min(issued, received), 0
            for lq, lk in layers:  # walk the layers oldest first
                take = min(left, lq)
                consumed += lk if take == lq else (2 * lk * take + lq) // (2 * lq)
                left -= take
                if left == 0:
                    break
            assert got[(item, day)] == (received - issued, received_cost - consumed), (item, day)


def test_keyed_keeps_the_grouping_of_its_rows(spark):
    """Rows grouped by the key aren't shuffled again; NULL equals NULL, keys may repeat."""
    df = spark.createDataFrame([(k, v) for v, k in enumerate(["a", "a", "b", None, None, "c"])], "k string, v int")
    for values in (["a", "a", "z"], ["b", None], [None], []):
        keys = spark.createDataFrame([(x,) for x in values], "k string")
        for among in (True, False):
            got = sorted(r["v"] for r in upsert.keyed(df, keys, among).collect())
            assert got == [v for v, k in enumerate(["a", "a", "b", None, None, "c"]) if (k in values) == among]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = dedup_latest(df, "k", "v")
        out = upsert.keyed(latest, spark.createDataFrame([("a",)], "k string"), among=False)
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(") <= 2, plan  # of the rows, and of the keys; before: 3


# ------------------------------------------------------------------ F-29 at size
def _sales_tables(spark, folder):
    """Small driver tables: a line that comes twice, one without amount, one of an order without date."""
    from aurum.schemas import DRIVER_TABLES

    day = dt.datetime(1997, 3, 9)
    tables = {
        "region": [(0, "AMERICA"), (1, "EUROPE"), (2, "ASIA")],
        "nation": [(i, f"N{i}", i) for i in range(3)],
        "supplier": [(i, f"S{i}", i, 1.0) for i in range(3)],
        "orders": [(1, 7, "O", 1.0, day, "5-LOW"), (2, 8, "O", 1.0, day + dt.timedelta(1), "1-URGENT"), (3, 9, "O", 1.0, None, "5-LOW")],
        "lineitem": [(1, 3, s, s, 10.0, 1000.0 * (s + 1), 0.0, 0.0, "N", "O", day) for s in range(3)]
        + [(1, 3, 1, 1, 10.0, 9000.0, 0.0, 0.0, "N", "O", day + dt.timedelta(3)), (2, 53, 2, 6, 10.0, 500.0, 0.0, 0.0, "N", "O", day),
           (2, 3, 2, 1, 10.0, 800.0, 0.0, 0.0, "N", "O", day), (3, 3, 1, 1, 10.0, 800.0, 0.0, 0.0, "N", "O", day)],
    }
    for name, rows_ in tables.items():
        spark.createDataFrame(rows_, DRIVER_TABLES[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_fx_sales_are_staged_once_and_hashed_after_the_rates(spark, scratch, monkeypatch):
    from aurum.operators import joins
    from aurum.plans.catalog import QUERIES

    d = _sales_tables(spark, scratch)
    expected = sorted([("1-0", D("2.00"), D("2.00")), ("1-1", D("18.00"), D("20.52")), ("1-2", D("6.00"), D("0.01")), ("2-1", D("1.60"), D("0.00"))])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["sales_clean_fx"](spark, d)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in df.select("transaction_id", "amount_local", "amount_usd").collect()) == expected
        # the rows are shuffled for the latest version only; before: for orders, supplier, the rates and a second time for their input
        assert plan.count("Exchange hashpartitioning(") == 1 and "lineitem" not in plan, plan
        monkeypatch.setattr(joins, "SMALL", -1)  # rates too large to be broadcast
        df = QUERIES["sales_clean_fx"](spark, d)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in df.select("transaction_id", "amount_local", "amount_usd").collect()) == expected
        assert plan.rindex("sha2(") < plan.index("Exchange hashpartitioning(currency"), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cut_leaves_no_shuffle_files(spark):
    """What was shuffled for a stored table is gone when it is written."""
    from aurum.sources.sinks import CLEANUP, cut

    own = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {f for d in own for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("s"))
    before = files()
    kept = df.collect()
    assert len(kept) == 10 and files() - before  # as Spark leaves them
    before = files()
    assert sorted(cut(df, "trial").collect()) == sorted(kept)
    assert spark.conf.get(CLEANUP) == "false" and not files() - before
