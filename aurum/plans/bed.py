"""Medallion layers over the driver tables: one object builds every layer
lazily (plans only — nothing runs until an action).

``Bed(spark, sf_dir)`` gives the raw feeds, bronze staging, silver and gold
frames with the fixed evaluation settings of FIXTURES.md §3.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from aurum.config import EVENTS_AS_OF, SALES_AS_OF, TEST_SALT, Settings
from aurum.plans import gold, silver, staging
from aurum.sources import adapters


class Bed:
    def __init__(self, spark: SparkSession, sf_dir: str, salt: str = TEST_SALT):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[tuple[str, str], DataFrame] = {}
        self.sales_settings = Settings(salt=salt, as_of=SALES_AS_OF)
        self.events_settings = Settings(salt=salt, as_of=EVENTS_AS_OF)

    # raw feeds and bronze staging -------------------------------------
    # One frame object per (kind, name) within a Bed: a query that uses a
    # layer several times builds (and analyses) it once, and identical
    # subplans are reused by the planner instead of recomputed.
    def _memo(self, kind: str, name: str, make) -> DataFrame:
        key = (kind, name)
        if key not in self._frames:
            self._frames[key] = make()
        return self._frames[key]

    def raw(self, name: str) -> DataFrame:
        return self._memo("raw", name, lambda: adapters.feed(self.spark, self.sf_dir, name))

    def table(self, name: str) -> DataFrame:
        return self._memo("table", name, lambda: adapters.read_table(self.spark, self.sf_dir, name))

    def stg(self, name: str) -> DataFrame:
        return self._memo("stg", name, lambda: staging.STAGING[name](self.raw(name)))

    # silver --------------------------------------------------------------
    @cached_property
    def sales(self) -> DataFrame:
        return silver.sales_transactions_cleaned(self.stg("sales"), self.sales_settings)

    @cached_property
    def customers(self) -> DataFrame:
        return silver.customers_cleaned(self.stg("customers"), self.sales_settings)

    @cached_property
    def inventory(self) -> DataFrame:
        return silver.inventory_snapshots(self.stg("inventory"))

    @cached_property
    def sessions(self) -> DataFrame:
        return silver.web_sessions_enriched(self.stg("web_events"), self.events_settings)

    @cached_property
    def iot(self) -> DataFrame:
        return silver.iot_readings_validated(self.stg("iot"), self.events_settings)

    # gold ----------------------------------------------------------------
    @cached_property
    def daily_sales(self) -> DataFrame:
        return gold.daily_sales_summary(self.sales)

    @cached_property
    def customer_360(self) -> DataFrame:
        return gold.customer_360(self.customers, self.sales, self.sales_settings)

    @cached_property
    def inventory_health(self) -> DataFrame:
        return gold.inventory_health(self.inventory, self.sales, self.sales_settings)

    @cached_property
    def funnel(self) -> DataFrame:
        return gold.web_conversion_funnel(self.sessions, self.stg("web_events"))

    @cached_property
    def iot_dashboard(self) -> DataFrame:
        return gold.iot_anomaly_dashboard(self.iot, self.events_settings)
