"""PII masking (F-02…F-06).  All strategies are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.functions.columns import col_, normalize_email

# --- fixed values ----------------------------------------------------------
# phone: keep the country/area prefix and the last two digits (SDK form)
PHONE_PATTERN = r"(\+?\d{2,3})\d{6,}(\d{2})"
PHONE_REPLACEMENT = "$1******$2"
# e-mail: two leading characters of the local part, first letter of the
# domain and its last label survive: jdoe@example.com → jd***@e***.com
EMAIL_MASK_PATTERN = r"^([^@]{2})[^@]*@([^@])[^@]*(\.[^.@]+)$"
EMAIL_MASK_REPLACEMENT = "$1***@$2***$3"
# ---------------------------------------------------------------------------

STRATEGIES = ("hash", "mask_email", "mask_phone", "null", "drop", "keep")


def salted_hash(c, salt: str, normalize: bool = True) -> Column:
    """F-02: ``sha2(salt | value)``; NULL stays NULL (D9: otherwise every NULL
    becomes the same hash and one giant join key)."""
    v = normalize_email(c) if normalize else col_(c).cast("string")
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(
        F.sha2(F.concat_ws("|", F.lit(salt), v), 256))


def _star(c) -> Column:
    return F.repeat(F.lit("*"), F.length(col_(c)))


def mask_email(c) -> Column:
    """F-03: documented form; a value the pattern cannot split is fully
    starred, never passed through (D8)."""
    v = col_(c)
    return F.when(v.rlike(EMAIL_MASK_PATTERN),
                  F.regexp_replace(v, EMAIL_MASK_PATTERN, EMAIL_MASK_REPLACEMENT)).otherwise(_star(v))


def mask_phone(c) -> Column:
    """F-04: ``+12******90``; too short to match → fully starred (D7)."""
    v = col_(c)
    return F.when(v.rlike(PHONE_PATTERN),
                  F.regexp_replace(v, PHONE_PATTERN, PHONE_REPLACEMENT)).otherwise(_star(v))


def apply_policy(df: DataFrame, policy: dict[str, str], salt: str | None = None) -> DataFrame:
    """F-06: apply ``{column: strategy}``; unknown strategies raise (D43)."""
    bad = {c: s for c, s in policy.items() if s not in STRATEGIES}
    if bad:
        raise ValueError(f"unknown masking strategy: {bad}")
    missing = [c for c in policy if c not in df.columns]
    if missing:
        raise ValueError(f"masking policy names absent columns: {missing}")
    if "hash" in policy.values() and not salt:
        raise ValueError("hash strategy needs a salt")
    out = {}
    for c, s in policy.items():
        if s == "hash":
            out[c] = salted_hash(c, salt)
        elif s == "mask_email":
            out[c] = mask_email(c)
        elif s == "mask_phone":
            out[c] = mask_phone(c)
        elif s == "null":
            out[c] = F.lit(None).cast(df.schema[c].dataType)
    drops = [c for c, s in policy.items() if s == "drop"]
    return df.withColumns(out).drop(*drops)


def drop_pii(df: DataFrame, columns) -> DataFrame:
    """P-11: remove PII columns outright (gold)."""
    return df.drop(*columns)
