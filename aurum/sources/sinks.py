"""Writers and table maintenance (S-01…S-07, S-09, S-12…S-17, S-19, S-20).

No table format is installed, so a keyed merge into a path is a Spark job: the
source is written once to the cluster's shared checkpoint folder (its size is
then known to the planner, so a small batch is broadcast and the table's keys
stay where they are), the rows of the touched partitions are merged
(``operators.upsert``) into a staged folder, and the folder is moved in by a
commit that any later reader or writer can finish (``sources.tables``).  An
insert-only merge appends files and rewrites none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.config import Settings, shared_dir
from aurum.operators.upsert import assert_unique_keys, new_rows, replace_scope, sync_schema, upsert
from aurum.sources import tables
from aurum.sources.tables import folders, load


# ------------------------------------------------------------------ S-17
def layer_table(settings: Settings, layer: str | None, domain: str, table: str) -> str:
    """Routing: bronze/silver/gold → that layer's namespace, else default.
    Three-part names are flattened to one namespace level (``silver_sales``)."""
    ns = {"bronze": settings.bronze_schema, "silver": settings.silver_schema,
          "gold": settings.gold_schema}.get(layer or "", "default")
    return f"{ns}_{domain}.{table}" if layer else f"{ns}.{table}"


def layer_path(settings: Settings, layer: str, domain: str, table: str) -> str:
    if not settings.root:
        raise ValueError("Settings.root is not set")
    return f"{settings.root.rstrip('/')}/{layer}/{domain}/{table}"


# ------------------------------------------------------------------ S-03
def with_date_partition(df: DataFrame, ts_col: str, name: str | None = None) -> tuple[DataFrame, str]:
    """``partition_by=["date(ts)"]`` re-aimed: derive a date column (D20)."""
    name = name or f"{ts_col}_date"
    return df.withColumn(name, F.to_date(ts_col)), name


# ------------------------------------------------------------------ S-01 / S-04 / S-05
def clustered_for_write(df: DataFrame, partition_by) -> DataFrame:
    """Rows of one table partition go to few tasks, so each writes few files.
    ``rebalance`` (not ``repartition``): AQE splits a partition value holding
    a large share of the rows over several tasks and merges small ones."""
    return df.hint("rebalance", *partition_by)


def write_path(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None, fmt: str = "parquet",
               files_per_partition: int | None = None) -> None:
    """Path write.  With ``partition_by`` the frame is first clustered by the
    partition columns so each task writes few files (an optimized write)."""
    if partition_by:
        df = df.repartition(files_per_partition, *partition_by) if files_per_partition else \
            clustered_for_write(df, partition_by)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


# ------------------------------------------------------------------ S-02 / S-20
def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_table(spark: SparkSession, df: DataFrame, name: str, mode: str = "overwrite", partition_by=None,
                comment: str | None = None, properties: dict | None = None,
                column_comments: dict | None = None) -> None:
    """Catalog table write with the model's documentation persisted (table
    comment, column comments, properties)."""
    ns = name.split(".")[0] if "." in name else None
    if ns:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {ns}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_sql_str(comment)}")
    for col, text in (column_comments or {}).items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{col}` COMMENT {_sql_str(text)}")
    for k, v in (properties or {}).items():
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_sql_str(k)} = {_sql_str(str(v))})")


def register_external(spark: SparkSession, name: str, location: str, fmt: str = "parquet") -> None:
    """S-06: an external table over a path; partition folders are registered too."""
    ns = name.split(".")[0] if "." in name else None
    if ns:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {ns}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION {_sql_str(location)}")
    if spark.catalog.listColumns(name) and any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


# ------------------------------------------------------------------ S-05
def replace_path(spark: SparkSession, df: DataFrame, path: str, partition_by=None, fmt: str = "parquet", key: str | None = None,
                 side: dict[str, DataFrame] | None = None) -> None:
    """S-05, full refresh: the new content is staged beside the table and takes
    its place as a whole, whatever the session's partition overwrite mode; no
    partition of the old table survives, and a table without rows keeps its
    schema.  ``key`` names the column whose ranges later merges prune by, ``side``
    frames to store with the table (:func:`read_side`)."""
    tables.recover(spark, path)
    staged = tables.staged_folder(path)
    _write_staged(df, staged, partition_by, fmt, key)
    for name, frame in (side or {}).items():
        frame.write.parquet(f"{staged}/{name}")
    tables.stage_meta(spark, staged, df.schema, list(partition_by or []), key, fmt, _version_only(spark, path))
    tables.commit(spark, path, staged, "whole")


def _version_only(spark: SparkSession, path: str) -> dict:
    """What a full refresh takes over from the table's ``_table.json``."""
    return {"version": (tables.table_meta(spark, path) or {}).get("version", 0)}


def _write_staged(df: DataFrame, staged: str, partition_by, fmt: str, key: str | None) -> None:
    if partition_by:
        df = clustered_for_write(df, partition_by)
    w = df.write.mode("errorifexists").format(fmt)
    if key and fmt == "parquet":  # lets a scan for a few keys skip row groups
        w = w.option(f"parquet.bloom.filter.enabled#{key}", "true")
    (w.partitionBy(*partition_by) if partition_by else w).save(staged)


#: Spark's setting that deletes the shuffle files of a query when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from
    lost executors, of a size that the planner knows.  :func:`discard` deletes it.
    What was shuffled for it leaves the disks as soon as it is written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/aurum-{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame | None) -> None:
    """Delete what :func:`cut` has written, when nothing reads it any more."""
    for df in frames:
        files = df.inputFiles() if df is not None else []
        if files:
            folder = files[0].rpartition("/")[0]
            if folder.rpartition("/")[2].startswith("aurum-"):
                tables.delete(df.sparkSession, folder)


def replace_partitions(spark: SparkSession, df: DataFrame, path: str, partition_by: str, values, key: str | None = None,
                       append=(), side: dict[str, DataFrame] | None = None) -> None:
    """The partitions of ``values`` (text or None) take the rows of ``df``, which has
    no others; those in ``append`` only get them added.  ``side``: frames that are
    stored in folders within the table and change with it (see :func:`read_side`)."""
    meta, staged = tables.table_meta(spark, path), tables.staged_folder(path)
    _write_staged(df, staged, [partition_by], "parquet", key)
    for name, frame in (side or {}).items():
        frame.write.parquet(f"{staged}/{name}")
    there, new = set(folders(spark, path)), set(folders(spark, staged))
    added = {tables.partition_folder(spark, partition_by, v) for v in append}
    drop = {tables.partition_folder(spark, partition_by, v) for v in values} & there - new - added
    tables.stage_meta(spark, staged, df.schema, [partition_by], key, "parquet", meta, drop, sorted(added & there & new))
    tables.commit(spark, path, staged, "partitions", drop, added, sorted(side or {}))


def read_side(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A frame that is stored within a table."""
    tables.recover(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/{name}")


def append_batch(spark: SparkSession, df: DataFrame, path: str, partition_by=None, batch_id: str | None = None, fmt: str = "parquet") -> bool:
    """S-04: append one batch exactly once.  The batch's id is stored with its
    files by the same commit, so a batch that is appended again adds nothing, while
    equal rows of two batches both stay.  Without an id the batch is named by its
    content (number of rows, and sums of row hashes that don't depend on
    their order)."""
    tables.recover(spark, path)
    batch_id = batch_id or content_id(df)
    if tables.path_exists(spark, f"{path.rstrip('/')}/_batch_{batch_id}"):
        return False
    staged = tables.staged_folder(path)
    _write_staged(df, staged, partition_by, fmt, None)
    tables.write_text(spark, f"{staged}/_batch_{batch_id}", "")
    tables.commit(spark, path, staged, "append" if tables.path_exists(spark, path) else "whole")
    return True


def content_id(df: DataFrame) -> str:
    """A name of the rows of a frame, whatever their order."""
    h = [F.xxhash64(*df.columns), F.xxhash64(F.lit("second"), *df.columns)]
    r = df.agg(F.count("*").alias("n"), *[F.sum(x.cast("decimal(20,0)")).alias(f"s{i}") for i, x in enumerate(h)],
               *[F.bit_xor(x).alias(f"x{i}") for i, x in enumerate(h)]).first()
    return uuid.uuid5(uuid.NAMESPACE_OID, "|".join(str(x) for x in r)).hex


# ------------------------------------------------------------------ S-07 / S-08 / S-10 / S-12
def merge_into_path(spark: SparkSession, source: DataFrame, path: str, keys, update_columns=None,
                    insert_only: bool = False, partition_by: str | None = None, fmt: str = "parquet",
                    null_safe: bool = False, scope: DataFrame | None = None, partition_of_key: bool = False,
                    on_schema_change: str = "append_new_columns") -> DataFrame:
    """Keyed upsert of ``source`` into the table at ``path``; returns the table.

    * duplicate source keys raise (a MERGE would be ambiguous);
    * partitioned tables rewrite only partitions that gain, lose or change
      rows (the old partition of a key that moved, and the NULL partition,
      included) and remove those left empty; only partitions whose range of the
      first key column can hold a key of the source are searched for old rows;
    * ``insert_only``: new keys are appended as new files, none is rewritten;
    * ``scope``: the keys that this batch has recomputed.  Their old rows go,
      whether or not the source still has a row for them;
    * ``partition_of_key``: declares that the partition is a function of the
      key, so only the source's own partitions are read;
    * ``on_schema_change``: new columns are kept (``append_new_columns``), left
      out (``ignore``), an error (``fail``), or the table takes the source's
      columns (``sync_all_columns``, rewrites the table);
    * a source without rows gives a table without rows, with its schema;
    * running the same merge twice yields the same table (idempotent).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    source = cut(source, "merge")  # computed once: checked, matched and merged below
    scope = None if scope is None else cut(scope.distinct(), "scope")
    try:
        assert_unique_keys(source, keys, null_safe)
        if not tables.exists(spark, path):
            replace_path(spark, source, path, [partition_by] if partition_by else None, fmt, keys[0])
        elif not source.isEmpty() or scope is not None and not scope.isEmpty():  # else: a retried or idle run rewrites nothing
            _merge(spark, source, path, keys, update_columns, insert_only, partition_by, fmt, null_safe, scope, partition_of_key, on_schema_change)
    finally:
        discard(source, scope)
    return load(spark, path, fmt)


def _merge(spark, source, path, keys, update_columns, insert_only, partition_by, fmt, null_safe, scope, partition_of_key, on_schema_change) -> None:
    target, meta = load(spark, path, fmt), tables.table_meta(spark, path)
    changed = _with_schema_change(source, target, on_schema_change)
    whole = on_schema_change == "sync_all_columns" and set(target.columns) != set(changed.columns)
    if partition_by and meta is None:
        # partition values come back type-inferred from directory names: align them
        target = target.withColumn(partition_by, F.col(partition_by).cast(changed.schema[partition_by].dataType))
    parts = [partition_by] if partition_by else []

    def merged(rows: DataFrame) -> DataFrame:
        out = replace_scope(rows, changed, scope) if scope is not None else upsert(
            rows, changed, keys, update_columns, insert_only, null_safe)
        return out.select(*changed.columns) if whole else out

    own = scope if scope is not None else changed.select(*keys)
    safe = null_safe or scope is not None
    old = target  # the rows that can hold a key of the batch
    if partition_by:
        possible, few = tables.possible_partitions(spark, path, own, own.columns[0], safe)
        if possible is not None:
            old = tables.in_partitions(target, partition_by, [tables.value_of(n) for n in possible])
        if few is not None and not safe:
            old = old.where(F.col(own.columns[0]).isin(few)) if few else old.limit(0)
    if insert_only and scope is None and not whole:
        rows = new_rows(old, changed, keys, null_safe)
        extra = [c for c in rows.columns if c not in target.columns]
        rows = rows.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) if c in rows.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                             for c in target.columns], *extra)
        staged = tables.staged_folder(path)
        _write_staged(rows, staged, parts, fmt, keys[0])
        there = set(folders(spark, path))
        tables.stage_meta(spark, staged, rows.schema, parts, keys[0], fmt, meta, grown=[n for n in folders(spark, staged) if n in there])
        tables.commit(spark, path, staged, "append")
        return
    if not partition_by or whole:
        replace_path(spark, merged(target), path, parts, fmt, keys[0])
        return
    # partitions touched: where source rows land, and where matched target rows live now
    touched = changed.select(partition_by)
    if scope is not None or not partition_of_key:
        named = own.distinct().select(*[F.col(c).alias(f"__own_{c}") for c in own.columns])
        match = [F.col(c[6:]).eqNullSafe(F.col(c)) if safe else F.col(c[6:]) == F.col(c) for c in named.columns]
        touched = touched.unionByName(old.select(*own.columns, *[c for c in parts if c not in own.columns]).join(named, match, "left_semi").select(partition_by))
    values = [r[0] for r in touched.select(F.col(partition_by).cast("string")).distinct().collect()]  # one a partition
    out = merged(tables.in_partitions(target, partition_by, values))
    staged = tables.staged_folder(path)
    _write_staged(out, staged, parts, fmt, keys[0])
    there, new = set(folders(spark, path)), set(folders(spark, staged))
    drop = {tables.partition_folder(spark, partition_by, v) for v in values} & there - new
    tables.stage_meta(spark, staged, out.schema, parts, keys[0], fmt, meta, drop)
    tables.commit(spark, path, staged, "partitions", drop)


def _with_schema_change(source: DataFrame, target: DataFrame, mode: str) -> DataFrame:
    """S-12."""
    extra = [c for c in source.columns if c not in target.columns]
    if mode == "fail" and extra:
        raise ValueError(f"new columns {extra}; the table has {target.columns}")
    if mode == "ignore":
        return source.drop(*extra)
    if mode == "append_new_columns":
        kept = [c for c in target.columns if c in source.columns]
        return sync_schema(source, kept, mode)
    if mode in ("fail", "sync_all_columns"):
        return source
    raise ValueError(f"unknown schema change mode {mode!r}")


#: Table property of a complete next version (see ``merge_into_table``).
COMPLETE = "aurum.complete"
#: Table properties that Spark keeps itself.
OWN_PROPERTIES = ("transient_lastDdlTime", "bucketing_version", "numFiles", "totalSize", "numRows", "rawDataSize", COMPLETE)


def merge_into_table(spark: SparkSession, source: DataFrame, name: str, keys, update_columns=None,
                     insert_only: bool = False, null_safe: bool = False, buckets: int | None = None) -> DataFrame:
    """S-09: keyed upsert into a catalog table; returns the table.

    ``buckets``: a table that this call creates is bucketed by its keys, so that
    later merges by them shuffle the source only.  The merged rows are written
    to ``<name>__next``, which gets the table's partitions, buckets, comments and
    properties and is then marked complete; the switch is two renames, and a
    merge that finds them half done (:func:`recover_table`) finishes them."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    recover_table(spark, name)
    source = cut(source, "merge")
    try:
        assert_unique_keys(source, keys, null_safe)
        if not spark.catalog.tableExists(name):
            if "." in name:
                spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rpartition('.')[0]}")
            w = source.write.mode("errorifexists").format("parquet")
            (w.bucketBy(buckets, *keys) if buckets else w).saveAsTable(name)
            return spark.table(name)
        target, made = spark.table(name), _next_name(name)
        merged = upsert(target, source, keys, update_columns, insert_only, null_safe)
        parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        n, by = _buckets(spark, name)
        w = merged.write.mode("errorifexists").format("parquet")
        w = w.partitionBy(*parts) if parts else w
        (w.bucketBy(n, *by) if n else w).saveAsTable(made)
        _copy_documentation(spark, name, made)
        spark.sql(f"ALTER TABLE {made} SET TBLPROPERTIES ('{COMPLETE}' = 'true')")
        recover_table(spark, name)
    finally:
        discard(source)
    return spark.table(name)


def _next_name(name: str) -> str:
    return f"{name}__next"


def recover_table(spark: SparkSession, name: str) -> bool:
    """Switch to a complete next version; an incomplete one (a write that was
    stopped) is dropped.  Can be repeated from any point."""
    made, old = _next_name(name), f"{name}__old"
    if not spark.catalog.tableExists(made):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        return False
    if COMPLETE not in _properties(spark, made):
        spark.sql(f"DROP TABLE {made}")
        return False
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {made} RENAME TO {name}")
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{COMPLETE}')")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return True


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _buckets(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number of buckets of a table (0: none) and the columns they are of."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return int(told.get("Num Buckets", 0)), [c.name for c in spark.catalog.listColumns(name) if c.isBucket]


def _copy_documentation(spark: SparkSession, name: str, to: str) -> None:
    """Comments and properties of a table (S-02, S-20)."""
    about = spark.catalog.getTable(name).description
    if about:
        spark.sql(f"COMMENT ON TABLE {to} IS {_sql_str(about)}")
    for c in spark.catalog.listColumns(name):
        if c.description:
            spark.sql(f"ALTER TABLE {to} ALTER COLUMN `{c.name}` COMMENT {_sql_str(c.description)}")
    for k, v in _properties(spark, name).items():
        if k not in OWN_PROPERTIES and not k.startswith("spark.sql."):
            spark.sql(f"ALTER TABLE {to} SET TBLPROPERTIES ({_sql_str(k)} = {_sql_str(v)})")


# ------------------------------------------------------------------ S-16
def drop_expired(spark: SparkSession, path: str, partition_by: str, oldest) -> list[str]:
    """Remove the date partitions older than ``oldest`` from a stored table;
    returns the folders removed.  The NULL partition stays."""
    gone = []
    tables.recover(spark, path)
    for name in folders(spark, path):
        column, _, value = name.partition("=")
        if column == partition_by and value[:1].isdigit() and value < str(oldest):
            tables.delete(spark, f"{path.rstrip('/')}/{name}")
            gone.append(name)
    return sorted(gone)


# ------------------------------------------------------------------ S-14 / S-15 / A-17
def file_count(df: DataFrame) -> int:
    """A-17: distinct input files of a scan."""
    return df.select(F.input_file_name().alias("f")).distinct().count()


def morton_key(df: DataFrame, cols, buckets: int = 256, sample: int = 20_000) -> DataFrame:
    """S-15: Z-order key over columns of any orderable type.

    One pass draws a bounded sample of all columns; its quantiles are the range
    bounds (``buckets`` values per column).  A value's bucket is its number of
    bounds below (NULL first); the buckets' bits are interleaved with shifts
    into ``_zorder``.  Bits per column shrink so that all fit into 63."""
    cols = list(cols)
    bits = min(max(1, (buckets - 1).bit_length()), 63 // len(cols))
    if not bits:
        raise ValueError("at most 63 columns can be interleaved")
    picked = df.select(*cols, F.rand(17).alias("__r")).orderBy("__r").limit(sample)
    picked = picked.agg(*[F.sort_array(F.collect_list(c)).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    out, names = df, []
    for i, c in enumerate(cols):
        values = picked[f"v{i}"]
        step = max(1, len(values) >> bits)
        bounds = sorted(set(values[step::step]))[:(1 << bits) - 1]
        kind = df.schema[c].dataType
        rank = F.size(F.filter(F.array(*[F.lit(x).cast(kind) for x in bounds]), lambda x: x <= F.col(c))) if bounds else F.lit(0)  # noqa: B023
        out = out.withColumn(f"__z{i}", F.when(F.col(c).isNull(), 0).otherwise(rank).cast("long"))
        names.append(f"__z{i}")
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, name in enumerate(names):
            b = F.shiftright(F.col(name), bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(b, bit * len(names) + i))
    return out.withColumn("_zorder", key).drop(*names)


def compact(spark: SparkSession, path: str, target_file_mb: int = 128, zorder_by=None, fmt: str = "parquet",
            out_path: str | None = None, in_place: bool = False) -> str:
    """S-14: rewrite a table into files of about ``target_file_mb``, sorted
    by the clustering columns (or their Z-order key) so min/max statistics
    prune well; a partitioned table keeps its partitions.  ``in_place`` swaps the
    new files in (recoverably, ``sources.tables``); otherwise they are left in
    ``out_path`` (or ``path + '_compacted'``)."""
    df, meta = load(spark, path, fmt), tables.table_meta(spark, path)
    p, fs = tables._path(spark, path)
    n = max(1, int(fs.getContentSummary(p).getLength() / (target_file_mb * 1024 * 1024)) + 1)
    parts, at = [], path
    while True:  # the partition columns are those of the folder names
        names = folders(spark, at)
        if not names:
            break
        parts.append(names[0].partition("=")[0])
        at = f"{at.rstrip('/')}/{names[0]}"
    order = list(zorder_by or [])
    if len(order) > 1:
        df, order = morton_key(df, order), ["_zorder"]
    if parts or order:  # range partitions split a large table partition and join small ones
        df = df.repartitionByRange(n, *parts, *order).sortWithinPartitions(*parts, *order)
    else:
        df = df.repartition(n)
    df = df.drop("_zorder")
    dest = tables.staged_folder(path) if in_place else out_path or path.rstrip("/") + "_compacted"
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    (w.partitionBy(*parts) if parts else w).save(dest)
    if not in_place:
        return dest
    tables.stage_meta(spark, dest, df.schema, parts, (meta or {}).get("key"), fmt, _version_only(spark, path))
    tables.commit(spark, path, dest, "whole")
    return path


# ------------------------------------------------------------------ S-19
def store_failures(violations: DataFrame, root: str, test_name: str) -> str:
    """Persist a test's violating rows under ``test_failures/<test>``."""
    dest = f"{root.rstrip('/')}/test_failures/{test_name}"
    violations.write.mode("overwrite").parquet(dest)
    return dest


# ------------------------------------------------------------------ S-18
def append_report(report_row: DataFrame, path: str) -> None:
    """Append one DQ report row (``value`` JSON + run columns)."""
    report_row.write.mode("append").parquet(path)
