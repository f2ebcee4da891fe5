"""Incremental silver (S-10): what one batch changes, equal to a full rebuild.

Each function takes the stored table, what is stored beside it and the batch,
and gives the rows that the batch changes; ``plans.jobs`` writes them, the
registered ``*_incremental`` queries return the whole table after the batch.

* sales, sessions — touched keys are recomputed from all their bronze rows.
* sensor readings — the statistics are merged from moments per (day, sensor
  type, unit): only the days of the batch are counted again, and only the days
  that hold a group whose statistics moved are scored again.
* stock — the latest version of each movement is stored; the running sum of a
  touched pair goes on from the balance stored before its first touched day.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.config import Settings
from aurum.operators.dedup import dedup_latest
from aurum.operators.joins import small
from aurum.operators.upsert import keyed
from aurum.plans import silver


def only(df: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is among ``keys`` (NULL equal to NULL); ``left_anti``: is not."""
    return keyed(df, keys, how == "left_semi")


# ------------------------------------------------------------------ M-06, M-09
def sales_changes(bronze: DataFrame, batch: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The batch's transactions, and their rows from all their copies."""
    own = batch.select("transaction_id").distinct()
    return own, silver.sales_transactions_cleaned(only(bronze, own), settings)


def session_changes(bronze: DataFrame, batch: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The batch's sessions, and their rows (bots flagged) from all their events."""
    own = batch.select("session_id").distinct()
    return own, silver.web_sessions_enriched(only(bronze, own), settings, keep_bots=True)


# ------------------------------------------------------------------ M-10 / A-04
READING = ["device_id", "sensor_type", "reading_value", "reading_unit", "battery_level", "firmware_version", "reading_timestamp",
           "surrogate_key", "_loaded_at"]
GROUP = ["sensor_type", "reading_unit"]


def latest_readings(readings: DataFrame) -> DataFrame:
    """One row per surrogate key, the latest: a reading that is sent again replaces itself."""
    return dedup_latest(readings.select(*READING), "surrogate_key", "_loaded_at")


def stored_readings(stored: DataFrame) -> DataFrame:
    """The readings that a stored table was scored from."""
    return stored.withColumnRenamed("reading_value_raw", "reading_value").select(*READING)


def day_moments(readings: DataFrame) -> DataFrame:
    """(n, mean, m2) and the range of the values per (day, sensor type, unit): mergeable."""
    v = F.col("reading_value")
    return readings.groupBy(F.to_date("reading_timestamp").alias("reading_date"), *GROUP).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("least"), F.max(v).alias("most"))


def merged_stats(moments: DataFrame) -> DataFrame:
    """Mean and sample deviation per (sensor type, unit) from the moments of its
    days; a group of one value has a deviation of exactly 0."""
    n, mean = F.col("n"), F.col("mean")
    total = moments.groupBy(*GROUP).agg(F.sum("n").alias("_n"), F.min("least").alias("_least"), F.max("most").alias("_most"),
                                        F.sum(F.when(n > 0, n * mean)).alias("_sum"))
    constant = F.col("_least") == F.col("_most")
    total = total.withColumn("mean_value", F.when(constant, F.col("_least")).when(F.col("_n") > 0, F.try_divide("_sum", "_n")))
    own = total.select(*[F.col(c).alias(f"__{c}") for c in GROUP], "mean_value")
    spread = (moments.join(own, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in GROUP]).groupBy(*[F.col(f"__{c}") for c in GROUP])
              .agg(F.sum(F.when(n > 0, F.col("m2") + n * (mean - F.col("mean_value")) * (mean - F.col("mean_value")))).alias("_m2")))
    j = total.join(spread, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in GROUP])
    sd = F.when(F.col("_n") > 1, F.when(constant, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(F.col("_m2"), F.col("_n") - 1))))
    return j.select(*GROUP, "mean_value", sd.alias("stddev_value"), F.col("_n").alias("n"))


class SensorChanges(NamedTuple):
    moments: DataFrame  # of all days, after the batch
    stats: DataFrame
    days: DataFrame  # reading_date: days to write again


def sensor_changes(stored: DataFrame, moments: DataFrame, batch: DataFrame) -> SensorChanges:
    """``stored`` is read for the days of the batch only."""
    days = batch.select(F.to_date("reading_timestamp").alias("reading_date")).distinct()
    again = latest_readings(stored_readings(only(stored, days)).unionByName(batch.select(*READING)))
    after = only(moments, days, "left_anti").unionByName(day_moments(again))
    before, stats = merged_stats(moments), merged_stats(after)
    named = before.select(*[F.col(c).alias(f"__{c}") for c in before.columns])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in before.columns]
    moved = only(after, stats.join(named, same, "left_anti").select(*GROUP)).select("reading_date")
    return SensorChanges(after, stats, days.unionByName(moved).distinct())


def rescored(stored_rows: DataFrame, batch: DataFrame, stats: DataFrame, settings: Settings) -> DataFrame:
    """The rows of some days (all batch rows are in them), scored by ``stats``."""
    rows = latest_readings(stored_readings(stored_rows).unionByName(batch.select(*READING)))
    return silver.iot_readings_validated(rows, settings, stats=stats)


# ------------------------------------------------------------------ M-08 / W-03
PAIR = ["product_sku", "warehouse_id"]
#: Bytes of first touched days up to which they are sent to all executors.
FEW = 1 << 20
#: Stands for a missing day, which sorts before all others.
NO_DAY = "DATE '0001-01-01'"


def _day(column: str):
    return F.coalesce(F.to_date(column), F.expr(NO_DAY))


class StockChanges(NamedTuple):
    movements: DataFrame  # the batch's movements, latest versions
    starts: DataFrame  # pair, start: first touched day
    rows: DataFrame  # the pairs' snapshots from that day on


def movement_changes(movements: DataFrame, batch: DataFrame,
                     store: Callable[[DataFrame], DataFrame] = lambda now: now) -> tuple[DataFrame, DataFrame]:
    """Latest versions of the batch's movements, and the first day of each pair
    that one of them names or named.  ``store`` may write the versions, of which
    the days are made, and read them back."""
    old = only(movements, batch.select("movement_id").distinct())
    now = store(silver.latest_movements(old.unionByName(batch.select(*old.columns))))
    starts = old.unionByName(now).groupBy(*PAIR).agg(F.min(_day("movement_date")).alias("start"))
    return now, starts


def _paired(df: DataFrame) -> DataFrame:
    """``df`` with its pair as one column, in which NULL equals NULL: joined by plain equality,
    rows are dealt by the column that they are grouped and ordered by, and shuffled once."""
    return df.withColumn("__pair", F.struct(*PAIR)).drop(*PAIR)


def _unpaired(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col("__pair")[c] for c in PAIR})


def _from_start(paired: DataFrame, day: str, starts: DataFrame, before: bool = False) -> DataFrame:
    j = paired.join(_paired(starts).select("__pair", "start"), "__pair")
    return j.where(_day(day) < F.col("start") if before else _day(day) >= F.col("start")).drop("start")


def stock_rows(stored: DataFrame, movements: DataFrame, now: DataFrame, starts: DataFrame,
               store: Callable[[DataFrame], DataFrame] = lambda flows: flows) -> DataFrame:
    """Snapshots of the touched pairs from their first touched day on.

    ``movements`` (without the batch) and ``stored`` may be cut to what matters:
    movements since the first start, snapshots of the pairs.  ``store`` may write
    the daily flows and read them back; ``movements`` and ``now`` aren't read after that."""
    after = only(movements, now.select("movement_id"), "left_anti").unionByName(now.select(*movements.columns))
    if small(starts, FEW):  # movements of other pairs, and of earlier days, aren't shuffled
        after = _unpaired(_from_start(_paired(after), "movement_date", F.broadcast(starts)))
    # one row a day before the rows of a pair meet in one task
    flows = _from_start(_paired(store(silver.daily_flows(after))), "movement_date", starts)
    carry = _from_start(_paired(stored), "snapshot_date", starts, before=True).groupBy("__pair").agg(
        F.max_by("quantity_on_hand", _day("snapshot_date")).alias("_carried"))
    return silver.running_stock(_unpaired(flows.join(carry, "__pair", "left")), F.coalesce("_carried", F.lit(0)), ["__pair"])


def stock_kept(stored: DataFrame, starts: DataFrame) -> DataFrame:
    """Stored snapshots that the batch leaves as they are."""
    own = _paired(starts).select(F.col("__pair").alias("__own"), "start")
    hit = (F.col("__pair") == F.col("__own")) & (_day("snapshot_date") >= F.col("start"))
    return _unpaired(_paired(stored).join(own, hit, "left_anti")).select(*stored.columns)
