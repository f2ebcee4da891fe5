"""Data-quality checks (Q-01…Q-10, A-15, S-16, S-19).

Each check is an aggregate that returns *rows* (a report or the violating
rows), so it can be stored (``store_failures``) or asserted.  Assertions
collect only one small report row per check or column — never data rows.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.functions.columns import ratio
from aurum.schemas import DQ_REPORT


@dataclass(frozen=True)
class Finding:
    """One measured breach: which check, on what, what it measured and allows."""

    check: str
    subject: str
    measured: object
    allowed: object = None

    def __str__(self) -> str:
        bound = "" if self.allowed is None else f" (allowed: {self.allowed})"
        return f"{self.check}[{self.subject}] = {self.measured}{bound}"


class DataQualityError(Exception):
    """Raised by the asserting checks; ``violations`` holds their findings."""

    @property
    def violations(self) -> list[Finding]:
        return list(self.args)

    def __str__(self) -> str:
        return "; ".join(map(str, self.args))


# ----------------------------------------------------------------- Q-01
def null_ratio(df: DataFrame, columns=None, threshold_pct: float = 5.0, table: str | None = None) -> DataFrame:
    """Per column: NULL count, total, NULL % and pass flag — one aggregate
    pass over all columns (the reference ran 1 + N jobs).  Empty input → 0 %."""
    columns = list(columns or df.columns)
    sums = [F.sum(F.col(c).isNull().cast("bigint")).alias(f"n{i}") for i, c in enumerate(columns)]
    agg = df.agg(F.count(F.lit(1)).alias("total"), *sums)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("null_count"))
        for i, c in enumerate(columns)])).alias("s")
    out = agg.select("total", stack).select("s.column_name", "s.null_count", "total")
    pct = F.coalesce(ratio(F.col("null_count") * 100, "total"), F.lit(0.0))
    out = out.withColumn("null_pct", pct).withColumn("passed", F.col("null_pct") <= F.lit(float(threshold_pct)))
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


def assert_null_ratio(df: DataFrame, columns, threshold_pct: float = 5.0) -> DataFrame:
    bad = null_ratio(df, columns, threshold_pct).filter(~F.col("passed")).collect()
    if bad:
        raise DataQualityError(*[Finding("null_pct", r["column_name"], r["null_pct"], threshold_pct) for r in bad])
    return df


# ----------------------------------------------------------------- Q-02
def freshness(df: DataFrame, ts_col: str, as_of_ts, warn_hours: int = 24, error_hours: int = 48,
              table: str | None = None) -> DataFrame:
    """One row: newest timestamp, its age in hours at ``as_of_ts`` and a
    status ``pass`` / ``warn`` / ``fail`` (empty → fail, D35)."""
    now = F.lit(as_of_ts).cast("timestamp_ntz")
    m = df.agg(F.max(ts_col).alias("max_ts"))
    age = (F.unix_timestamp(now) - F.unix_timestamp("max_ts")).cast("double") / F.lit(3600.0)
    out = m.select("max_ts", age.alias("age_hours")).withColumn(
        "status", F.when(F.col("max_ts").isNull(), "fail")
        .when(F.col("age_hours") > error_hours, "fail")
        .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


def assert_fresh(df: DataFrame, ts_col: str, as_of_ts, max_hours: int = 24) -> DataFrame:
    r = freshness(df, ts_col, as_of_ts, max_hours, max_hours).collect()[0]
    if r["status"] != "pass":
        raise DataQualityError(Finding("age_hours", ts_col, r["age_hours"], max_hours))
    return df


# ----------------------------------------------------------------- Q-03
@dataclass
class SchemaDrift:
    missing: list = field(default_factory=list)
    extra: list = field(default_factory=list)
    type_changed: list = field(default_factory=list)


def schema_drift(df: DataFrame, expected) -> SchemaDrift:
    """Compare against a StructType (names + types) or a name list.  Metadata
    only: no job runs."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(expected, T.StructType):
        exp = {f.name: f.dataType for f in expected.fields}
    else:
        exp = {c: None for c in expected}
    d = SchemaDrift(
        missing=sorted(set(exp) - set(actual)),
        extra=sorted(set(actual) - set(exp)),
        type_changed=sorted(c for c, t in exp.items() if t is not None and c in actual and actual[c] != t),
    )
    return d


def assert_schema(df: DataFrame, expected) -> DataFrame:
    d = schema_drift(df, expected)
    breaches = [Finding("column", c, "absent") for c in d.missing] + [
        Finding("type", c, df.schema[c].dataType.simpleString(), expected[c].dataType.simpleString()) for c in d.type_changed]
    if breaches:
        raise DataQualityError(*breaches)
    if d.extra:
        warnings.warn(str(Finding("columns", "not in the schema", d.extra)), stacklevel=2)
    return df


# ----------------------------------------------------------------- Q-08 / Q-09
def not_null_violations(df: DataFrame, column: str, model: str, key: str) -> DataFrame:
    """Rows failing a ``not_null`` test (``store_failures`` form)."""
    return df.filter(F.col(column).isNull()).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.col(key).cast("string").alias("row_key"))


def unique_violations(df: DataFrame, column: str, model: str) -> DataFrame:
    """Values failing a ``unique`` test, with their copy counts."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("copies")) \
        .filter("copies > 1").select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                                     F.col(column).cast("string").alias("value"), "copies")


# ----------------------------------------------------------------- Q-10
def not_null_violations_many(df: DataFrame, columns, model: str, key: str) -> DataFrame:
    """``not_null`` tests on several columns of one model in one pass: a row
    with k NULL tested columns yields k violation rows (same rows as one
    ``not_null_violations`` per column)."""
    columns = list(columns)
    any_null = F.col(columns[0]).isNull()
    for c in columns[1:]:
        any_null = any_null | F.col(c).isNull()
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.filter(any_null).select(F.lit(model).alias("model"), F.explode(names).alias("column_name"),
                                      F.col(key).cast("string").alias("row_key"))


def unique_violations_many(df: DataFrame, columns, model: str) -> DataFrame:
    """``unique`` tests on several columns of one model with one scan and one
    aggregate keyed by (column, value); partial aggregation runs before the
    shuffle, so a frequent value costs one row per map task."""
    columns = list(columns)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                for c in columns])).alias("p")
    return (df.select(pairs).select("p.*").filter(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
            .select(F.lit(model).alias("model"), "column_name", "value", "copies"))


def report(checks: DataFrame, run_timestamp: str, environment: str) -> DataFrame:
    """Q-10 / S-18: fold check rows ``(name, passed, detail)`` into one report
    row with an ``overall_status`` and a JSON form (``value``)."""
    agg = checks.agg(
        F.sort_array(F.collect_list(F.struct("name", "passed", "detail"))).alias("checks"),
        F.min(F.col("passed").cast("int")).alias("_all"))
    r = agg.select(
        F.lit(run_timestamp).alias("run_timestamp"), F.lit(environment).alias("environment"), "checks",
        F.when(F.coalesce(F.col("_all"), F.lit(1)) == 1, "PASSED").otherwise("FAILED").alias("overall_status"))
    return r.withColumn("value", F.to_json(F.struct("run_timestamp", "environment", "checks", "overall_status")))


def raise_on_failure(checks: DataFrame) -> None:
    """Raise ``DataQualityError`` listing failed checks (bounded: one row per
    check)."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise DataQualityError(*[Finding("check", r["name"], r["detail"]) for r in failed])


# ----------------------------------------------------------------- A-15
def dq_trend(reports: DataFrame, since=None) -> DataFrame:
    """Per (run day, check): failures, runs and failure % (1 decimal) from
    JSON report rows in column ``value``."""
    parsed = reports.select(F.from_json("value", DQ_REPORT).alias("p"))
    ex = parsed.select(F.to_date(F.col("p.run_timestamp")).alias("run_date"),
                       F.explode("p.checks").alias("c"))
    if since is not None:
        ex = ex.filter(F.col("run_date") >= F.lit(since).cast("date"))
    g = ex.groupBy("run_date", F.col("c.name").alias("check_name")).agg(
        F.sum(F.when(F.col("c.passed"), 0).otherwise(1)).cast("bigint").alias("failure_count"),
        F.count(F.lit(1)).alias("total_runs"))
    pct = F.round(F.col("failure_count").cast("decimal(38,0)") * 100 / F.col("total_runs").cast("decimal(38,0)"), 1)
    return g.withColumn("failure_rate_pct", pct.cast("double"))


# ----------------------------------------------------------------- S-16
def retention(df: DataFrame, ts_col: str, as_of_ts, hours: int) -> DataFrame:
    """Keep rows no older than ``hours`` at ``as_of_ts`` (vacuum re-aimed)."""
    cutoff = F.lit(as_of_ts).cast("timestamp_ntz") - F.make_interval(hours=F.lit(hours))
    return df.filter(F.col(ts_col).cast("timestamp_ntz") >= cutoff)
