"""Keyed upsert (S-07…S-10, J-05, J-07) without a table format.

``upsert`` is a pure DataFrame operator returning the merged table content;
``sources.sinks`` persists it.  By default keys match as in SQL ``MERGE``
(``=``: a NULL key never matches, so NULL-key source rows are inserted and
NULL-key target rows kept); ``null_safe=True`` lets NULL equal NULL, for
tables whose key may hold NULLs (D41).

Shape: one full outer join on the key gives kept, matched and new rows in one
shuffle of each side.  The source is unique per key (checked), so a hot key
cannot multiply rows; NULL-key rows of a ``=`` merge bypass the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def all_not_null(keys) -> F.Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def duplicate_source_keys(source: DataFrame, keys, null_safe: bool = False) -> DataFrame:
    """Keys that occur more than once (a MERGE would be ambiguous).  NULL keys
    count only where they match each other."""
    keys = _keys(keys)
    rows = source if null_safe else source.filter(all_not_null(keys))
    return rows.groupBy(*keys).count().filter("count > 1")


def assert_unique_keys(source: DataFrame, keys, null_safe: bool = False) -> None:
    """Raise when the source holds a key twice.  One aggregate; only a
    bounded sample (5 keys) ever reaches the driver."""
    sample = duplicate_source_keys(source, keys, null_safe).limit(5).collect()
    if sample:
        raise DuplicateKeyError(f"source has duplicate merge keys, e.g. {[r.asDict() for r in sample]}")


def new_rows(target: DataFrame, source: DataFrame, keys, null_safe: bool = False) -> DataFrame:
    """J-07: the source rows whose key the target lacks (NULL keys match only
    where ``null_safe``).  The target's keys are first reduced to those of the
    source, so that a small source is broadcast and only matches are shuffled."""
    keys = _keys(keys)

    def match(prefix):
        return [F.col(f"{prefix}{k}").eqNullSafe(F.col(k)) if null_safe else F.col(f"{prefix}{k}") == F.col(k) for k in keys]

    wanted = source.select(*[F.col(k).alias(f"__s_{k}") for k in keys])
    there = target.select(*keys).join(wanted, match("__s_"), "left_semi").distinct().select(*[F.col(k).alias(f"__t_{k}") for k in keys])
    return source.join(there, match("__t_"), "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys, update_columns=None, insert_only: bool = False,
           null_safe: bool = False) -> DataFrame:
    """Merged content of ``target`` after ``MERGE source ON keys``.

    * default: matched rows take every column of the source row (the
      reference never updated without an explicit list, D23), unmatched
      source rows are inserted;
    * ``update_columns``: matched rows take only those columns from source;
    * ``insert_only``: matched rows are left alone, new keys are inserted.

    New source columns are added (NULL for old rows); a column that the source
    lacks keeps its value in matched rows.
    """
    keys = _keys(keys)
    if insert_only:  # no matched row changes: the target as it is, and the new rows
        return target.unionByName(new_rows(target, source, keys, null_safe), allowMissingColumns=True)
    if update_columns is not None:
        update_columns = list(update_columns)
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    loose = []
    if not null_safe:  # rows that can't match need no shuffle, and would meet in one task
        ok = all_not_null(keys)
        loose = [target.filter(~ok), source.filter(~ok)]
        target, source = target.filter(ok), source.filter(ok)
    t = target.withColumn("__in_target", F.lit(True)).alias("t")
    s = source.withColumn("__in_source", F.lit(True)).alias("s")
    match = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) if null_safe else F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    old, new = F.col("__in_target"), F.col("__in_source")

    def merged(c):
        if c not in source.columns:
            return F.col(f"t.{c}")
        if c not in target.columns:
            if update_columns is None or c in update_columns:
                return F.col(f"s.{c}").alias(c)
            return F.when(old.isNull(), F.col(f"s.{c}")).alias(c)
        taken = new.isNotNull()
        if update_columns is not None and c not in update_columns:
            taken = taken & old.isNull()
        return F.when(taken, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    out = t.join(s, match, "full").select(*[merged(c) for c in columns])
    for rows in loose:
        out = out.unionByName(rows, allowMissingColumns=True)
    return out.select(*columns)


def keyed(df: DataFrame, keys: DataFrame, among: bool = True) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys`` (NULL equal to NULL), or is not.

    One key column is joined by plain equality, and NULL is looked up by itself:
    a null-safe join is dealt by other expressions than the key, so rows that are
    (or will be) grouped by the key would be shuffled once more."""
    if len(keys.columns) > 1:
        own = keys.select(*[F.col(c).alias(f"__{c}") for c in keys.columns])
        return df.join(own, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys.columns], "left_semi" if among else "left_anti")
    c = keys.columns[0]
    hit = keys.where(F.col(c).isNotNull()).distinct().select(F.col(c).alias("__key"), F.lit(True).alias("__hit"))
    null = keys.where(F.col(c).isNull()).agg((F.count(F.lit(1)) > 0).alias("__null"))  # one row
    there = F.when(F.col(c).isNull(), F.col("__null")).otherwise(F.col("__hit").isNotNull())
    out = df.join(hit, F.col(c) == F.col("__key"), "left").crossJoin(F.broadcast(null))
    return out.where(there if among else ~there).select(*df.columns)


def replace_scope(target: DataFrame, source: DataFrame, scope: DataFrame) -> DataFrame:
    """``target`` without the rows whose key is in ``scope`` (its columns, NULL
    equal to NULL), and all rows of ``source``: a keyed rebuild, in which keys
    that no longer qualify disappear."""
    return keyed(target, scope, among=False).unionByName(source, allowMissingColumns=True)


def high_water_mark(target: DataFrame, column: str = "_loaded_at"):
    """S-10: ``max(column)`` of the target — one scalar, one aggregate job."""
    return target.agg(F.max(column).alias("hwm")).collect()[0]["hwm"]


def incremental_batch(source: DataFrame, target: DataFrame | None, column: str = "_loaded_at",
                      inclusive: bool = False) -> DataFrame:
    """S-10: rows newer than the target's high-water mark; the whole source on
    a first run (or an empty target).  The mark is a literal in the filter, so
    it is pushed into the source scan (parquet row-group skipping).
    ``inclusive`` also takes rows at the mark, for jobs whose merge may see a
    row again: rows that arrive late with the mark's own time are not missed."""
    if target is None:
        return source
    hwm = high_water_mark(target, column)
    if hwm is None:
        return source
    mark = F.lit(hwm).cast(source.schema[column].dataType)
    return source.filter(F.col(column) >= mark if inclusive else F.col(column) > mark)


def sync_schema(df: DataFrame, target_columns, mode: str = "append_new_columns") -> DataFrame:
    """S-12: ``append_new_columns`` keeps target order then new columns;
    ``sync_all_columns`` also drops columns the target no longer has."""
    tcols = list(target_columns)
    if mode == "sync_all_columns":
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in tcols])
    if mode == "append_new_columns":
        extra = [c for c in df.columns if c not in tcols]
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in tcols], *extra)
    raise ValueError(f"unknown schema sync mode {mode!r}")
