"""Slowly changing dimension type 2 (S-11, W-09) and as-of reads (R-10).

Batch form builds the whole history from a change stream; incremental form
merges one new snapshot into an existing history (close + open rows,
optional invalidation of hard deletes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aurum.functions.columns import surrogate_key
from aurum.operators.dedup import dedup_latest


def _h(cols):
    return surrogate_key(*cols)


def scd2_history(changes: DataFrame, key: str, updated_at: str, tracked) -> DataFrame:
    """History rows ``(key, tracked…, valid_from, valid_to, is_current)``.

    * two versions with the same ``updated_at`` collapse to one (the larger
      change hash wins, so the pick is total);
    * a version equal to the previous one (no-op change) is dropped;
    * ``valid_to`` is the next kept version's ``valid_from``.

    No window ever spans a key's whole history (a key may hold a third of
    all changes): "previous version" and "next kept version" are found inside
    (key, day) windows, and across days through a one-row-per-(key, day)
    series carried by a window over days; those daily rows join back 1:1.
    """
    tracked = list(tracked)
    v = changes.select(key, updated_at, *tracked).withColumn("_change_hash", _h(tracked))
    v = dedup_latest(v, [key, updated_at], "_change_hash", tiebreak=[])  # partial aggregate
    v = v.withColumn("_day", F.to_date(updated_at))
    in_day = Window.partitionBy(key, "_day").orderBy(updated_at)
    by_day = Window.partitionBy(key).orderBy("_day")
    # previous version's hash: same day, else the last version of an earlier day
    last_of_day = v.groupBy(key, "_day").agg(F.max(F.struct(updated_at, "_change_hash")).alias("_m"))
    prev_day = last_of_day.select(key, "_day", F.lag("_m._change_hash").over(by_day).alias("_prev_day"))
    v = v.withColumn("_prev_in", F.lag("_change_hash").over(in_day)).join(prev_day, [key, "_day"], "left")
    prev = F.coalesce("_prev_in", "_prev_day")
    kept = v.filter(prev.isNull() | (prev != F.col("_change_hash")))
    # next kept version: same day, else the first kept version of a later day
    first_of_day = kept.groupBy(key, "_day").agg(F.min(updated_at).alias("_first"))
    next_day = first_of_day.select(key, "_day", F.lead("_first").over(by_day).alias("_next_day"))
    kept = kept.withColumn("_next_in", F.lead(updated_at).over(in_day)).join(next_day, [key, "_day"], "left")
    return kept.select(
        key, *tracked, "_change_hash",
        F.col(updated_at).alias("valid_from"),
        F.coalesce("_next_in", "_next_day").alias("valid_to"),
    ).withColumn("is_current", F.col("valid_to").isNull())


def scd2_merge(history: DataFrame, snapshot: DataFrame, key: str, tracked, snapshot_ts,
               invalidate_hard_deletes: bool = True) -> DataFrame:
    """Merge one full snapshot taken at ``snapshot_ts`` into a history."""
    tracked = list(tracked)
    closed = history.filter(F.col("valid_to").isNotNull())
    step = scd2_step(history.filter(F.col("valid_to").isNull()), snapshot, key, tracked, snapshot_ts, invalidate_hard_deletes)
    return (closed.select(key, *tracked, "_change_hash", "valid_from", "valid_to")
            .withColumn("is_current", F.col("valid_to").isNull()).unionByName(step))


def scd2_step(current: DataFrame, snapshot: DataFrame, key: str, tracked, snapshot_ts,
              invalidate_hard_deletes: bool = True) -> DataFrame:
    """What becomes of the open rows: those that stay open or are opened by the
    snapshot (``is_current``), and those that it closes.  Closed rows of earlier
    runs are not needed.  One full outer join; a row emits at most two."""
    tracked = list(tracked)
    kinds = current.schema["valid_from"].dataType, current.schema["valid_to"].dataType
    ts = F.lit(snapshot_ts)
    snap = snapshot.select(key, *tracked).withColumn("_change_hash", _h(tracked))
    j = current.alias("c").join(snap.alias("s"), key, "full")
    c_h, s_h = F.col("c._change_hash"), F.col("s._change_hash")

    def row(side, start, end):
        return F.struct(*[F.col(f"{side}.{t}").alias(t) for t in tracked], F.col(f"{side}._change_hash").alias("_change_hash"),
                        start.cast(kinds[0]).alias("valid_from"), end.cast(kinds[1]).alias("valid_to"))

    none, begun = F.lit(None), F.col("c.valid_from")
    changed = c_h.isNotNull() & s_h.isNotNull() & (c_h != s_h)
    gone = c_h.isNotNull() & s_h.isNull()
    closes = changed | gone if invalidate_hard_deletes else changed
    rows = F.array(F.when(closes, row("c", begun, ts)).when(c_h.isNotNull(), row("c", begun, none)),
                   F.when(changed | c_h.isNull(), row("s", ts, none)))
    return (j.select(key, F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("_r")).select(key, "_r.*")
            .withColumn("is_current", F.col("valid_to").isNull()))


def as_of(history: DataFrame, t, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """R-10: the version valid at ``t``: ``from <= t < to`` (open end = current)."""
    tt = F.lit(t).cast(history.schema[valid_from].dataType)
    return history.filter((F.col(valid_from) <= tt) & (F.col(valid_to).isNull() | (F.col(valid_to) > tt)))
