"""Structured Streaming jobs (X-01…X-07, S-13).

* ``ingest``: file stream → bronze append with audit columns, checkpointed,
  ``availableNow`` by default — a re-run on the same checkpoint adds nothing
  (exactly-once by the checkpoint's committed-offset log).
* ``upsert_stream``: incremental silver as a stream — each micro-batch is
  merged by key into a path table through ``foreachBatch``; the keyed merge
  is idempotent, so a retried batch cannot double-apply.
* ``dedup_stream``: bounded-state dedup with a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aurum.operators.dedup import stream_dedup
from aurum.sources.readers import read_stream
from aurum.streaming.registry import SchemaRegistry


def trigger_kwargs(trigger: str | None) -> dict:
    """X-04: ``availableNow`` / ``once`` / ``"<n> seconds"`` → ``trigger(...)``
    keyword arguments (the reference passed ``availableNow`` as a processing
    time, D21)."""
    if trigger in (None, "", "availableNow", "available_now"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def with_stream_audit(df: DataFrame, source_name: str) -> DataFrame:
    """X-03: audit columns on a stream (file path from the file metadata)."""
    return df.withColumns({"_ingested_at": F.current_timestamp(),
                           "_source_file": F.col("_metadata.file_path"),
                           "_source_name": F.lit(source_name)})


def ingest(spark: SparkSession, source_path: str, schema: StructType, target_path: str, checkpoint: str,
           source_format: str = "json", trigger: str | None = "availableNow", partition_by=None,
           source_name: str | None = None, max_files_per_trigger: int | None = None, fmt: str = "parquet"):
    """X-01…X-03 / S-13: one feed definition (format, path, checkpoint,
    target) for every job that ingests it (D42).  Blocks until done for
    ``availableNow`` / ``once``; returns the query."""
    s = read_stream(spark, source_path, schema, source_format, max_files_per_trigger)
    s = with_stream_audit(s, source_name or source_path)
    if partition_by:
        for name, ts_col in partition_by.items():
            s = s.withColumn(name, F.to_date(ts_col))
    w = (s.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(**trigger_kwargs(trigger)))
    if partition_by:
        w = w.partitionBy(*partition_by.keys())
    q = w.start(target_path)
    if trigger in (None, "", "availableNow", "available_now", "once"):
        q.awaitTermination()
    return q


class Feed:
    """X-03: one definition of a feed for every job that ingests it (D42): where
    it lands, its format and schema, and the table, checkpoint and partitions it
    is ingested into under ``root``."""

    def __init__(self, source: str, table: str, schema: StructType, landing: str, root: str, source_format: str = "json",
                 partition_by: dict | None = None, max_files_per_trigger: int | None = None):
        self.source, self.table, self.schema, self.landing = source, table, schema, landing
        self.source_format, self.partition_by, self.max_files = source_format, partition_by, max_files_per_trigger
        base = root.rstrip("/")
        self.target = f"{base}/bronze/{source}/{table}"
        self.registry = SchemaRegistry(f"{base}/checkpoint/schemas/{source}/{table}")
        self.checkpoint = f"{base}/checkpoint/bronze/{source}/{table}"


def ingest_feed(spark: SparkSession, feeds: dict[tuple[str, str], Feed], source: str, table: str,
                trigger: str | None = "availableNow"):
    """X-03: the job of (source, table, trigger) over the defined feeds.  The feed's
    schema is the newest of its registry (R-06): its declared columns, and those
    that its files have gained."""
    feed = feeds.get((source, table))
    if feed is None:
        raise KeyError(f"no feed ({source}, {table}); defined: {sorted(feeds)}")
    schema = feed.registry.evolve(spark, feed.landing, feed.schema, feed.source_format)
    return ingest(spark, feed.landing, schema, feed.target, feed.checkpoint, feed.source_format, trigger,
                  feed.partition_by, source, feed.max_files)


def read_feed(spark: SparkSession, feed: Feed) -> DataFrame:
    """The table of a feed, old files under the newest schema."""
    stored = spark.read.option("mergeSchema", "false").parquet(feed.target)
    last = feed.registry.latest(spark)
    if last is None:
        return stored
    names = {f.name for f in last[1].fields}
    return spark.read.schema(StructType(last[1].fields + [f for f in stored.schema.fields if f.name not in names])).parquet(feed.target)


def upsert_stream(stream: DataFrame, target_path: str, keys, checkpoint: str, transform=None,
                  trigger: str | None = "availableNow", partition_by: str | None = None, fmt: str = "parquet"):
    """X-06: micro-batches merged by key into ``target_path``.

    ``transform(batch_df) -> DataFrame`` maps a bronze batch to silver rows
    (it must leave one row per key; use ``dedup_latest``).  The merge replaces
    rows by key, so a batch that is applied again after a failure changes
    nothing; several streams, or a stream with a new checkpoint, may write one
    table.
    """
    from aurum.sources.sinks import merge_into_path

    keys = [keys] if isinstance(keys, str) else list(keys)

    def apply(batch: DataFrame, batch_id: int):
        merge_into_path(batch.sparkSession, transform(batch) if transform else batch, target_path, keys,
                        partition_by=partition_by, fmt=fmt)

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(**trigger_kwargs(trigger)).start())
    if trigger in (None, "", "availableNow", "available_now", "once"):
        q.awaitTermination()
    return q


def dedup_stream(stream: DataFrame, keys, event_time: str, delay: str = "1 hour") -> DataFrame:
    """X-07: drop duplicates whose copies arrive within the watermark delay."""
    return stream_dedup(stream, keys, event_time, delay)
