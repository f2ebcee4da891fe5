"""Scalar expressions on the FIXTURES §4 edge rows."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from aurum.functions import columns as C
from aurum.functions import privacy as P


def one(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0]["r"]


def test_salted_hash_null_and_normalisation(spark):
    df = spark.createDataFrame([(None,), ("",), ("User1@Example.COM ",), ("user1@example.com",)], "e string")
    out = [r["h"] for r in df.select(P.salted_hash("e", "s").alias("h")).collect()]
    assert out[0] is None  # NULL in → NULL out (no shared hash for all NULLs)
    assert out[1] == hashlib.sha256(b"s|").hexdigest()
    assert out[2] == out[3] == hashlib.sha256(b"s|user1@example.com").hexdigest()


def test_mask_email_edge_rows(spark):
    df = spark.createDataFrame([("jdoe@example.com",), ("a@b.com",), ("nomail.example.com",), (None,),
                                ("jo@mail.example.co.uk",)], "e string")
    out = [r["m"] for r in df.select(P.mask_email("e").alias("m")).collect()]
    assert out == ["jd***@e***.com", "*******", "******************", None, "jo***@m***.uk"]


def test_mask_phone_edge_rows(spark):
    df = spark.createDataFrame([("+1234567890",), ("12345",), ("+1 234 567 890",), ("+44123456789012",)], "p string")
    out = [r["m"] for r in df.select(P.mask_phone("p").alias("m")).collect()]
    assert out[0] == "+12******90"
    assert out[1] == "*****"  # too short: fully starred, never passed through
    assert out[2] == "*" * len("+1 234 567 890")
    assert out[3].startswith("+44") and out[3].endswith("12") and "*" in out[3]


def test_policy_unknown_strategy_raises(spark):
    import pytest
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError):
        P.apply_policy(df, {"a": "scramble"})


def test_age_buckets(spark):
    as_of = dt.date(2001, 8, 15)
    dobs = [None, dt.date(1983, 8, 15), dt.date(1983, 8, 16), dt.date(1977, 2, 15), dt.date(1936, 9, 1),
            dt.date(2005, 1, 1), dt.date(1936, 8, 15)]
    df = spark.createDataFrame([(d,) for d in dobs], "d date")
    out = [r["b"] for r in df.select(C.age_bucket("d", as_of).alias("b")).collect()]
    # NULL; exactly 18; 17.99; 24.5 (floored, not 65_plus: D6); 64.9; future; exactly 65
    assert out == ["unknown", "18_24", "under_18", "18_24", "55_64", "under_18", "65_plus"]


def test_rfm_boundaries(spark):
    rows = [(None, None, None), (1000.01, 11, 29), (1000.0, 11, 29), (500.01, 6, 59), (100.0, 1, 29),
            (100.0, 1, 30), (100.0, 1, 90), (100.0, 1, 91)]
    df = spark.createDataFrame(rows, "m double, f long, r int")
    seg = [r[0] for r in df.select(C.rfm_segment("m", "f", "r")).collect()]
    assert seg == ["never_purchased", "champion", "loyal", "loyal", "new_active", "at_risk", "at_risk", "lapsed"]
    churn = [r[0] for r in df.select(C.churn_risk_score("m", "r")).collect()]
    assert churn == [0, 20, 20, 40, 20, 20, 70, 90]
    rec = spark.createDataFrame([(14,), (15,), (31,), (61,)], "r int").select(
        C.churn_risk_score(F.lit(1.0), "r")).collect()
    assert [r[0] for r in rec] == [5, 20, 40, 70]


def test_stock_rules(spark):
    df = spark.createDataFrame([(0, 5.0), (70, 10.0), (300, 10.0), (900, 10.0), (10, None), (10, 0.0)],
                               "s long, d double")
    risk = [r[0] for r in df.select(C.stockout_risk("s", "d")).collect()]
    assert risk == ["stocked_out", "low", "healthy", "overstocked", "overstocked", "overstocked"]
    doh = [r[0] for r in df.select(C.days_on_hand("s", "d")).collect()]
    assert doh[1] == 7.0 and doh[4] == 999.0 and doh[5] == 999.0
    abc = spark.createDataFrame([(10.0,), (10.5,), (50.0,), (50.5,), (None,)], "d double").select(C.abc_class("d"))
    assert [r[0] for r in abc.collect()] == ["C", "B", "B", "A", "C"]


def test_bot_rules(spark):
    df = spark.createDataFrame([(0, 51, "x"), (0, 50, "x"), (1, 11, "x"), (1, 10, "x"), (5, 2, None)],
                               "d long, n long, b string")
    assert [r[0] for r in df.select(C.is_bot("d", "n", "b")).collect()] == [True, False, True, False, True]


def test_surrogate_key_null_marker(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(C.surrogate_key("x", "y")).collect()[0][0] == hashlib.sha256(b"a|_null_").hexdigest()


def test_epoch_micros_is_time_zone_free(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10 12:00:00.250001' t")
    assert df.select(C.epoch_micros("t")).collect()[0][0] == 1710072000250001


def test_pct_round2_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 0)], "n long, d long")
    assert [r[0] for r in df.select(C.pct_round2("n", "d")).collect()] == [12.5, 33.33, 66.67, None]
