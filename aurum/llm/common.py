"""Small helpers shared by the operators: tables, shared storage, row maps."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.config import shared_dir

#: White space of the text contracts, in the syntax of Java and of Python.
SPACES = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so that a lost executor costs the running tasks only,
    and fixes what a later recomputation could number differently.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/aurum-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, without a copy: a batch may hold a whole
    partition, and Python objects are made of a slice only."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Spark's setting for the rows of an Arrow batch, its default, and the rows that whole texts go in.
BATCH_ROWS, DEFAULT_ROWS, TEXT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", 1024


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to the Python workers by ``TEXT_ROWS`` rows, where the session has
    Spark's default: that many long texts are a whole partition, which executor and
    worker would both hold at once.  Holds for the session; a value of the user's stays."""
    if spark.conf.get(BATCH_ROWS, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(BATCH_ROWS, str(TEXT_ROWS))


def give_back() -> None:
    """Return freed memory to the system, where the C library can: it keeps what many
    arrays of changing size leave behind, and the driver has little."""
    with contextlib.suppress(AttributeError, OSError, TypeError):
        ctypes.CDLL(None).malloc_trim(0)
    pa.default_memory_pool().release_unused()


def drop_tables(*frames: DataFrame) -> None:
    """Delete the files under frames made by :func:`materialize` that nothing reads any more."""
    for df in frames:
        jvm, files = df.sparkSession._jvm, df.inputFiles()
        if files:
            p = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            if p.getName().startswith("aurum-"):
                p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def text_blocks(df: DataFrame, text: str, block_bytes: int, least: int) -> int:
    """How many blocks of ``block_bytes`` of text the table makes (one scan of the column)."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(least, -(-size // block_bytes))


def bounded_sample(df: DataFrame, keys: list[str], n: int) -> list:
    """At most ``n`` rows, chosen by a hash of ``keys``: the same ones at every
    run.  Only rows under a hash bound that about 2 n rows meet are sorted, so
    that tasks don't each send n rows to the driver."""
    share = min(1.0, 2.0 * n / max(1, df.count()))
    h = F.pmod(F.xxhash64(*keys), F.lit(1 << 40))
    return df.where(h < int(share * (1 << 40))).orderBy(h, *keys).limit(n).collect()


#: A key of more than 1 in HOT of all rows is hot, so there are fewer than HOT of them.
HOT = 1000


def look_up(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table`` for their key, which isn't null.

    ``table`` has a row for every key of ``rows``, with the number of its rows in
    ``uses`` (dropped); their sum is ``total``.  Fewer than ``HOT`` keys have more
    than 1 in ``HOT`` of all rows: these are broadcast.  The others are joined by a
    shuffle in which no key is heavier than that."""
    hot = F.col("uses") * HOT > total
    few = F.broadcast(table.where(hot).drop("uses").withColumn("__found", F.lit(True)))
    tried = rows.join(few, key, "left")
    rest = tried.where("__found IS NULL").select(*rows.columns).join(table.where(~hot).drop("uses"), key)
    return tried.where("__found").drop("__found").unionByName(rest)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def text_of(col: str = "text"):
    """The text column with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def crc_bucket(col: str, n: int):
    """crc32 of an id as text, modulo ``n`` (null id: null)."""
    return F.pmod(F.crc32(F.col(col).cast("string")), F.lit(n))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Operators that run Python in tasks import their module there; where the
    package is installed on all machines this changes nothing.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    to = Path(tempfile.mkdtemp(prefix="aurum-src-")) / "aurum_src.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, f"{package.name}/{p.relative_to(package)}")
    sc.addPyFile(str(to))
    _shipped.add(sc.applicationId)
