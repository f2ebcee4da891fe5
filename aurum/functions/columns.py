"""Scalar column expressions.  Every function returns a Column
built from Spark built-ins, so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference ---------------------------
# e-mail validity pattern of the customers model
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
# surrogate-key separator and NULL marker
KEY_SEPARATOR = "|"
KEY_NULL_MARKER = "_null_"
# movement types counted as stock in / out / transfer
INBOUND_TYPES = ("INBOUND", "ADJUSTMENT+")
OUTBOUND_TYPES = ("OUTBOUND", "ADJUSTMENT-")
TRANSFER_TYPES = ("TRANSFER",)
# age buckets: (lower bound inclusive, label); below 18 → under_18
AGE_BUCKETS = ((18, "18_24"), (25, "25_34"), (35, "35_44"), (45, "45_54"), (55, "55_64"), (65, "65_plus"))
# --------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """F-01: sha2 over ``'|'``-joined string casts, NULL spelled ``_null_``."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit(KEY_NULL_MARKER)) for c in cols]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def audit_columns(ingested_at="_ingested_at") -> dict[str, Column]:
    """P-06: audit columns, stamped once at ingest (D10), never at view time."""
    return {
        "_loaded_at": col_(ingested_at),
        "_loaded_by": F.expr("current_user()"),
        "_runtime_version": F.expr("version()"),
    }


def standardize_name(c) -> Column:
    """F-07: ``initcap(trim(x))``."""
    return F.initcap(F.trim(col_(c)))


def is_valid_email(c) -> Column:
    """P-15: format check used before hashing a customer e-mail."""
    return col_(c).rlike(EMAIL_PATTERN)


def normalize_email(c) -> Column:
    """D38: case and padding are normalised before hashing on both sides."""
    return F.lower(F.trim(col_(c)))


def age_years(dob, as_of) -> Column:
    """Completed years; ``floor`` fixes the fractional-age gap (D6)."""
    return F.floor(F.months_between(F.lit(as_of), col_(dob)) / F.lit(12))


def age_bucket(dob, as_of) -> Column:
    """F-10: eight buckets; NULL dob → ``unknown``; future dob → ``under_18``."""
    age = age_years(dob, as_of)
    expr = F.when(col_(dob).isNull(), "unknown").when(age < AGE_BUCKETS[0][0], "under_18")
    for (lo, label), (hi, _) in zip(AGE_BUCKETS, AGE_BUCKETS[1:]):
        expr = expr.when(age < hi, label)
    return expr.otherwise(AGE_BUCKETS[-1][1])


def url_query(c) -> Column:
    """F-11: query part of a URL (``parse_url(u, 'QUERY')``)."""
    return F.call_function("try_parse_url", col_(c), F.lit("QUERY"))


def url_param(c, key: str) -> Column:
    """F-11 / E-01: value of one query parameter, NULL when absent or unparsable."""
    return F.call_function("try_parse_url", col_(c), F.lit("QUERY"), F.lit(key))


def elapsed_seconds(start, end) -> Column:
    """F-13: whole seconds between two timestamps (floor-epoch difference)."""
    return F.unix_timestamp(col_(end)) - F.unix_timestamp(col_(start))


def epoch_micros(c) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ, independent of the
    session time zone (whole seconds + the micro part of the seconds field)."""
    return (F.unix_timestamp(col_(c)) * F.lit(1_000_000)
            + (F.date_part(F.lit("SECOND"), col_(c)) * F.lit(1_000_000)).cast("bigint") % F.lit(1_000_000))


def days_between(start, end) -> Column:
    """F-13: calendar days (two-argument ``datediff`` on dates)."""
    return F.datediff(F.to_date(col_(end)), F.to_date(col_(start)))


def ratio(num, den) -> Column:
    """Null-safe ``num / den`` in DOUBLE (one division, so engines agree)."""
    return col_(num).cast("double") / F.nullif(col_(den), F.lit(0)).cast("double")


def pct_round2(num, den) -> Column:
    """``ROUND(num * 100.0 / NULLIF(den, 0), 2)`` computed exactly (decimal
    HALF_UP), returned as DOUBLE."""
    q = col_(num).cast("decimal(38,0)") * F.lit(100) / F.nullif(col_(den), F.lit(0)).cast("decimal(38,0)")
    return F.round(q, 2).cast("double")


def micro_avg(c) -> Column:
    """Average of a DOUBLE column in exact integer micro-units (values are
    rounded to 1e-6 first), so the result does not depend on summation order.
    Use inside ``agg``."""
    micro = F.round(col_(c) * F.lit(1e6)).cast("bigint")
    return F.sum(micro).cast("double") / F.count(micro).cast("double") / F.lit(1e6)


# The thresholds and labels of the ladders below are the declared
# business rules; results have to agree with them.
def rfm_segment(monetary, frequency, recency) -> Column:
    """F-18: seven ordered cases; band 30–90 inclusive is ``at_risk`` (D37)."""
    m, f, r = col_(monetary), col_(frequency), col_(recency)
    return (
        F.when(m.isNull(), "never_purchased")
        .when((m > 1000) & (f > 10) & (r < 30), "champion")
        .when((m > 500) & (f > 5) & (r < 60), "loyal")
        .when(r < 30, "new_active")
        .when(r.between(30, 90), "at_risk")
        .when(r > 90, "lapsed")
        .otherwise("needs_attention")
    )


def churn_risk_score(monetary, recency) -> Column:
    """F-19: 0/90/70/40/20/5 by recency."""
    m, r = col_(monetary), col_(recency)
    return (
        F.when(m.isNull(), 0).when(r > 90, 90).when(r > 60, 70)
        .when(r > 30, 40).when(r > 14, 20).otherwise(5)
    )


def avg_order_value(monetary, frequency) -> Column:
    """F-20: monetary / frequency, 0 without orders (DOUBLE)."""
    return F.when(col_(frequency) > 0, ratio(monetary, frequency)).otherwise(F.lit(0.0))


def days_on_hand(stock, demand) -> Column:
    """F-21: stock / demand, 999 without demand."""
    return F.when(col_(demand) > 0, col_(stock).cast("double") / col_(demand)).otherwise(F.lit(999.0))


def stockout_risk(stock, demand) -> Column:
    """F-22: stocked_out / critical < 7 / low < 30 / healthy < 90 / overstocked."""
    s, d = col_(stock), col_(demand)
    doh = s.cast("double") / d
    return (
        F.when(s == 0, "stocked_out")
        .when((d > 0) & (doh < 7), "critical")
        .when((d > 0) & (doh < 30), "low")
        .when((d > 0) & (doh < 90), "healthy")
        .otherwise("overstocked")
    )


def abc_class(demand) -> Column:
    """F-23: demand > 50 → A, > 10 → B, else C (NULL/0 → C)."""
    d = col_(demand)
    return F.when(d.isNull() | (d == 0), "C").when(d > 50, "A").when(d > 10, "B").otherwise("C")


def ltv_tier(spend) -> Column:
    """F-25: platinum > 10000, gold > 5000, silver > 1000, else bronze."""
    s = col_(spend)
    return (F.when(s > 10000, "platinum").when(s > 5000, "gold")
            .when(s > 1000, "silver").otherwise("bronze"))


def is_bot(duration_s, events, first_browser, burst: int = 50, rate: float = 10.0) -> Column:
    """F-24: zero-length burst, sustained rate, or missing browser (D3: the
    session's first browser value)."""
    d, n = col_(duration_s), col_(events)
    return (
        ((d == 0) & (n > burst))
        | ((d > 0) & (n.cast("double") > F.lit(float(rate)) * d.cast("double")))
        | col_(first_browser).isNull()
    )
