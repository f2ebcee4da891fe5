"""The data-quality job (Q-04…Q-07, Q-10) and per-day DQ runs for the trend
report (A-15, S-16).  Every check is one aggregate over its table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.functions.columns import ratio
from aurum.operators import quality


def _one_row_counts(**frames: DataFrame) -> DataFrame:
    """Row counts of several frames as one row (``<name>`` columns): each
    frame is reduced by its own aggregate, then the one-row results are
    folded with a global conditional aggregate (no join)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("k"), "n") for k, df in frames.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.sum(F.when(F.col("k") == k, F.col("n"))).cast("bigint").alias(k) for k in frames])


def layer_reconciliation(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Q-04: each layer non-empty; silver ≤ bronze with the dedup reduction %."""
    c = _one_row_counts(bronze=bronze, silver=silver, gold=gold)
    red = ratio((F.col("bronze") - F.col("silver")) * 100, "bronze")
    rows = F.array(
        F.struct(F.lit("row_count_bronze").alias("check_name"), F.col("bronze").cast("double").alias("metric"),
                 (F.col("bronze") > 0).alias("passed")),
        F.struct(F.lit("row_count_silver").alias("check_name"), F.col("silver").cast("double").alias("metric"),
                 (F.col("silver") > 0).alias("passed")),
        F.struct(F.lit("row_count_gold").alias("check_name"), F.col("gold").cast("double").alias("metric"),
                 (F.col("gold") > 0).alias("passed")),
        F.struct(F.lit("dedup_reduction_pct").alias("check_name"), red.alias("metric"),
                 F.coalesce(red >= 0, F.lit(False)).alias("passed")),
    )
    return c.select(F.explode(rows).alias("r")).select("r.*")


def customer_completeness(c360: DataFrame) -> DataFrame:
    """Q-05: share of customers that bought at least once (> 0 passes)."""
    a = c360.agg(F.count(F.lit(1)).alias("customers"),
                 F.count_if(F.col("customer_segment") != "never_purchased").alias("active"))
    pct = F.coalesce(ratio(F.col("active") * 100, "customers"), F.lit(0.0))
    return a.select("customers", "active", pct.alias("active_pct"), (pct > 0).alias("passed"))


def revenue_integrity(gold_daily: DataFrame, silver_sales: DataFrame) -> DataFrame:
    """Q-06: gold revenue non-null and positive, and equal to silver's."""
    g = gold_daily.agg(F.sum("total_revenue_usd").cast("decimal(38,2)").alias("v")).select(F.lit("gold").alias("k"), "v")
    s = silver_sales.agg(F.sum("amount_usd").cast("decimal(38,2)").alias("v")).select(F.lit("silver").alias("k"), "v")
    a = g.unionByName(s).agg(F.max(F.when(F.col("k") == "gold", F.col("v"))).alias("gold_revenue_usd"),
                             F.max(F.when(F.col("k") == "silver", F.col("v"))).alias("silver_revenue_usd"))
    ok = (F.col("gold_revenue_usd").isNotNull() & (F.col("gold_revenue_usd") > 0)
          & (F.col("gold_revenue_usd") == F.col("silver_revenue_usd")))
    return a.withColumn("passed", F.coalesce(ok, F.lit(False)))


def outlier_rate(validated: DataFrame, max_pct: float = 10.0) -> DataFrame:
    """Q-07: share of readings flagged as outliers must stay below max_pct."""
    a = validated.agg(F.count(F.lit(1)).alias("readings"), F.count_if("is_outlier").alias("outliers"))
    pct = F.coalesce(ratio(F.col("outliers") * 100, "readings"), F.lit(0.0))
    return a.select("readings", "outliers", pct.alias("outlier_pct"), (pct < max_pct).alias("passed"))


def _check(name, passed, detail):
    return F.struct(F.lit(name).alias("name") if isinstance(name, str) else name.alias("name"),
                    passed.alias("passed"), detail.alias("detail"))


def _null_ratio_check(table: str, total, null_counts, threshold_pct: float):
    """Q-01 folded to one check row: passes when every column's NULL % is
    within the threshold; the detail shows the worst column's %."""
    pcts = [F.coalesce(ratio(n * 100, total), F.lit(0.0)) for n in null_counts]
    worst = pcts[0] if len(pcts) == 1 else F.greatest(*pcts)
    ok = pcts[0] <= F.lit(float(threshold_pct))
    for p in pcts[1:]:
        ok = ok & (p <= F.lit(float(threshold_pct)))
    return _check(f"null_ratio_{table}", ok, F.concat(F.lit("max_null_pct="), F.format_number(worst, 2)))


def sales_layer_checks(stg_sales: DataFrame, silver_sales: DataFrame, gold_daily: DataFrame, as_of_ts,
                       warn_hours: int, error_hours: int, null_threshold_pct: float) -> DataFrame:
    """Q-04, Q-02, Q-01 and Q-06 on the sales layers in one aggregate: the
    three layers are stacked (``unionByName``) and folded by one global
    conditional aggregate, and every check row is built from that one row in
    a single projection — so each layer is computed once (separate per-check
    aggregates are pruned to different columns and cannot share a scan)."""
    cols = silver_sales.columns
    u = (stg_sales.select(F.lit("bronze").alias("_k"))
         .unionByName(silver_sales.select(F.lit("silver").alias("_k"), *cols), allowMissingColumns=True)
         .unionByName(gold_daily.select(F.lit("gold").alias("_k"), F.col("total_revenue_usd").alias("_gold_rev")),
                      allowMissingColumns=True))
    sil = F.col("_k") == "silver"
    a = u.agg(
        F.count_if(F.col("_k") == "bronze").alias("bronze"), F.count_if(sil).alias("silver"),
        F.count_if(F.col("_k") == "gold").alias("gold"),
        F.max(F.when(sil, F.col("transaction_date"))).alias("max_ts"),
        F.sum(F.when(sil, F.col("amount_usd"))).cast("decimal(38,2)").alias("silver_revenue_usd"),
        F.sum("_gold_rev").cast("decimal(38,2)").alias("gold_revenue_usd"),
        *[F.sum(F.when(sil, F.col(c).isNull().cast("bigint"))).alias(f"_n{i}") for i, c in enumerate(cols)])
    b, s, g = F.col("bronze"), F.col("silver"), F.col("gold")
    red = ratio((b - s) * 100, b)
    now = F.lit(as_of_ts).cast("timestamp_ntz")
    age = (F.unix_timestamp(now) - F.unix_timestamp("max_ts")).cast("double") / F.lit(3600.0)
    fresh_fail = F.col("max_ts").isNull() | (age > error_hours)
    grev, srev = F.col("gold_revenue_usd"), F.col("silver_revenue_usd")
    rev_ok = F.coalesce(grev.isNotNull() & (grev > 0) & (grev == srev), F.lit(False))
    rows = F.array(
        _check("row_count_bronze", b > 0, F.format_number(b.cast("double"), 1)),
        _check("row_count_silver", s > 0, F.format_number(s.cast("double"), 1)),
        _check("row_count_gold", g > 0, F.format_number(g.cast("double"), 1)),
        _check("dedup_reduction_pct", F.coalesce(red >= 0, F.lit(False)), F.format_number(red, 1)),
        _check("freshness_sales", ~fresh_fail, F.concat(F.lit("age_hours="), F.format_number(age, 1))),
        _null_ratio_check("sales", s, [F.coalesce(F.col(f"_n{i}"), F.lit(0)) for i in range(len(cols))],
                          null_threshold_pct),
        _check("revenue_integrity", rev_ok, grev.cast("string")),
    )
    return a.select(F.explode(rows).alias("c")).select("c.*")


def table_null_check(df: DataFrame, table: str, threshold_pct: float) -> DataFrame:
    """Q-01 over all columns of a table, as one check row."""
    a = df.agg(F.count(F.lit(1)).alias("total"), *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    nulls = [F.coalesce(F.col(f"_n{i}"), F.lit(0)) for i in range(len(df.columns))]
    return a.select(_null_ratio_check(table, F.col("total"), nulls, threshold_pct).alias("c")).select("c.*")


def checks(bed) -> DataFrame:
    """Q-10: every check of the DQ job as rows ``(name, passed, detail)``."""
    st = bed.sales_settings
    sales = sales_layer_checks(bed.stg("sales"), bed.sales.drop("_loaded_by", "_runtime_version"),
                               bed.daily_sales, _eod(st.as_of), st.freshness_warning_hours,
                               st.freshness_error_hours, st.null_threshold_pct)
    nulls = table_null_check(bed.customers, "customers", st.null_threshold_pct)
    comp = customer_completeness(bed.customer_360).select(
        F.lit("customer_completeness").alias("name"), "passed", F.format_number("active_pct", 1).alias("detail"))
    out = outlier_rate(bed.iot).select(F.lit("iot_outlier_rate").alias("name"), "passed",
                                      F.format_number("outlier_pct", 1).alias("detail"))
    return sales.unionByName(nulls).unionByName(comp).unionByName(out)


def _eod(as_of):
    from aurum.plans.reports import end_of_day
    return end_of_day(as_of)


def daily_runs(web_events: DataFrame, validated: DataFrame, null_threshold_pct: float = 5.0,
               outlier_max_pct: float = 10.0) -> DataFrame:
    """One DQ run per event day (as a nightly job would produce): browser
    NULL ratio, outlier rate and non-empty checks, folded into a JSON report
    row ``(run_timestamp, value)`` — the input of the trend report."""
    w = web_events.groupBy(F.to_date("event_timestamp").alias("d")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("browser").isNull().cast("bigint")).alias("null_browser"))
    o = validated.groupBy(F.col("reading_date").alias("d")).agg(
        F.count(F.lit(1)).alias("readings"), F.count_if("is_outlier").alias("outliers"))
    j = w.join(o, "d", "full")
    nb = F.coalesce(ratio(F.col("null_browser") * 100, "events"), F.lit(0.0))
    orate = F.coalesce(ratio(F.col("outliers") * 100, "readings"), F.lit(0.0))
    chk = F.array(
        F.struct(F.lit("null_ratio_browser").alias("name"), (nb <= null_threshold_pct).alias("passed"),
                 F.format_number(nb, 2).alias("detail")),
        F.struct(F.lit("iot_outlier_rate").alias("name"), (orate < outlier_max_pct).alias("passed"),
                 F.format_number(orate, 2).alias("detail")),
        F.struct(F.lit("row_count_web_events").alias("name"), (F.coalesce("events", F.lit(0)) > 0).alias("passed"),
                 F.coalesce("events", F.lit(0)).cast("string").alias("detail")),
    )
    ts = F.concat(F.col("d").cast("string"), F.lit("T23:59:59+00:00"))
    status = F.when(F.forall(chk, lambda c: c["passed"]), "PASSED").otherwise("FAILED")
    rep = F.struct(ts.alias("run_timestamp"), F.lit("dev").alias("environment"), chk.alias("checks"),
                   status.alias("overall_status"))
    return j.select(F.to_timestamp_ntz(F.concat(F.col("d").cast("string"), F.lit(" 23:59:59"))).alias("run_ts"),
                    status.alias("overall_status"), F.to_json(rep).alias("value"))
