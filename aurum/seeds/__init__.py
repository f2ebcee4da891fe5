"""Seed (reference) tables shipped with the library.

``countries.csv`` is the reference's country → region seed, verbatim.  The
codes are also listed here in file order (fixed values) because the web-event
adapter picks a country by position.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from aurum import schemas

SEED_DIR = os.path.dirname(__file__)

# --- fixed values: country codes of the seed, in file order ----------------
COUNTRY_CODES = ("SN", "CI", "ML", "BF", "FR", "US", "GB", "DE", "CA", "NG")
# ---------------------------------------------------------------------------


def seed_path(name: str) -> str:
    return os.path.join(SEED_DIR, f"{name}.csv")


def _rows(name: str):
    import csv
    with open(seed_path(name), newline="", encoding="utf-8") as fh:
        return [tuple(r) for r in csv.reader(fh)][1:]


def countries(spark: SparkSession) -> DataFrame:
    """R-11: the 10-row countries seed.  Built from the packaged file on the
    driver (bounded: ten rows) so executors need no access to that file."""
    return spark.createDataFrame(_rows("countries"), schemas.COUNTRIES)
