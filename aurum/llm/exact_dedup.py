"""Exact deduplication by deterministic block naming (DataFrame functions only).

Texts are normalised (runs of white space become one space) and cut into
blocks of ``block_chars`` characters.  Blocks are sorted into integer names:
a 64-bit key of the content picks a bucket, and within a bucket the different
contents are numbered in sorted order, so the name ``(k, r)`` of a block is
free of collisions whatever the key function does.  Then adjacent names are
paired and the pairs named in the same way, level by level, until every
document has one name; two documents are equal exactly when their number of
blocks and their last names are.

What moves: each different block once (a map-side distinct removes repeats
before the shuffle, so a hot block or a third of all rows being copies costs
one row per map task), then only integers.  Buckets with two contents are
found by a count per bucket; with 64 bits they are practically absent, and
then all ranks are 0 and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import SPACES, is_empty, materialize, read_table, text_of

BLOCK_CHARS = 2048
NAME = "array<struct<k:bigint,r:int>>"


def normalised(text: str):
    return F.regexp_replace(text_of(text), SPACES, " ")


def _key(cols, key_bits: int):
    h = F.xxhash64(*cols)
    return h if key_bits >= 64 else F.pmod(h, F.lit(1 << key_bits))


def _clashes(items: DataFrame, content: list[str]) -> DataFrame | None:
    """Ranks of the contents in buckets that hold more than one, or None.

    ``items`` has the bucket ``k`` and the columns of ``content``."""
    different = items.select("k", *content).distinct()
    shared = materialize(different.groupBy("k").count().where("count > 1").select("k"), "clash")
    if is_empty(shared):
        return None
    rank = F.row_number().over(W.partitionBy("k").orderBy(*content)) - 1
    return materialize(different.join(shared, "k", "left_semi").withColumn("r", rank), "ranks")


def _ranked(items: DataFrame, content: list[str], ranks: DataFrame, keep: list[str]) -> DataFrame:
    """Names per document again, from exploded items and the ranks of the clashes."""
    return (items.join(ranks, ["k", *content], "left")
            .groupBy("rid", *keep)
            .agg(F.sort_array(F.collect_list(F.struct("pos", "k", F.coalesce("r", F.lit(0)).alias("r")))).alias("n"))
            .withColumn("names", F.transform("n", lambda x: F.struct(x["k"].alias("k"), x["r"].alias("r"))).cast(NAME))
            .drop("n"))


def name_documents(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   block_chars: int = BLOCK_CHARS, key_bits: int = 64) -> DataFrame:
    """One row per row of ``df``: rid, id, text_sha256, n_blocks, k, r.

    Rows have equal (n_blocks, k, r) exactly when their normalised texts are
    equal.  Null texts count as empty (one empty block).  ``rid`` numbers the
    rows; other columns of ``df`` are not read.  ``key_bits`` under 64 only
    serves tests that force clashes.
    """
    norm = (df.select(F.col(doc_id).alias("id"), normalised(text).alias("t"))
            .select(F.monotonically_increasing_id().alias("rid"), "id", "t"))
    # (?s).{1,n} walks the text once; an empty text is one empty block
    cut = F.regexp_extract_all("t", F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
    cut = F.when(F.length("t") == 0, F.array(F.lit(""))).otherwise(cut)
    blocks = norm.select("rid", "id", F.sha2("t", 256).alias("text_sha256"), cut.alias("blocks"))
    items = blocks.select(F.explode("blocks").alias("b")).select(_key(["b"], key_bits).alias("k"), "b")
    ranks = _clashes(items, ["b"])
    if ranks is None:
        docs = blocks.withColumn("names", F.transform(
            "blocks", lambda b: F.struct(_key([b], key_bits).alias("k"), F.lit(0).alias("r"))).cast(NAME))
    else:
        exploded = blocks.select("rid", "id", "text_sha256", F.posexplode("blocks").alias("pos", "b"))
        docs = _ranked(exploded.withColumn("k", _key(["b"], key_bits)), ["b"], ranks, ["id", "text_sha256"])
    docs = materialize(docs.select("rid", "id", "text_sha256", F.size("names").alias("n_blocks"), "names"), "blocks")

    done, left, most = docs.where("n_blocks = 1"), docs.where("n_blocks > 1"), docs.agg(F.max("n_blocks")).first()[0] or 0
    keep = ["id", "text_sha256", "n_blocks"]
    while most > 1:  # as many levels as the longest document has halvings
        pairs = F.transform(F.sequence(F.lit(0), ((F.size("names") + 1) / 2).cast("int") - 1), lambda i: F.struct(
            F.element_at("names", 2 * i + 1).alias("a"), F.get("names", 2 * i + 1).alias("b")))
        items = left.select("rid", *keep, F.posexplode(pairs).alias("pos", "p")).select(
            "rid", *keep, "pos", F.col("p.a.k").alias("ak"), F.col("p.a.r").alias("ar"),
            F.coalesce("p.b.k", F.lit(0)).alias("bk"), F.coalesce("p.b.r", F.lit(-1)).alias("br"))  # -1: no right half
        content = ["ak", "ar", "bk", "br"]
        items = items.withColumn("k", _key(content, key_bits))
        ranks = _clashes(items, content)
        if ranks is None:
            nxt = left.withColumn("p", pairs).withColumn("names", F.transform("p", lambda p: F.struct(
                _key([p["a"]["k"], p["a"]["r"], F.coalesce(p["b"]["k"], F.lit(0)), F.coalesce(p["b"]["r"], F.lit(-1))],
                     key_bits).alias("k"), F.lit(0).alias("r"))).cast(NAME)).drop("p")
        else:
            nxt = _ranked(items, content, ranks, keep)
        nxt = materialize(nxt.select("rid", *keep, "names"), "level")
        done, left, most = done.unionByName(nxt.where("size(names) = 1")), nxt.where("size(names) > 1"), (most + 1) // 2
    return done.select("rid", "id", "text_sha256", "n_blocks",
                       F.col("names")[0]["k"].alias("k"), F.col("names")[0]["r"].alias("r"))


def exact_groups(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 block_chars: int = BLOCK_CHARS, key_bits: int = 64) -> DataFrame:
    """One row per row of ``df``: rid, id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays (a null id comes last;
    of rows with one id, the first read stays).  An empty table gives none.
    """
    docs = name_documents(df, text, doc_id, block_chars, key_bits)
    ident = ["n_blocks", "k", "r"]
    # only groups of several need the join; partial aggregates meet a hot group
    groups = materialize(docs.groupBy(*ident).agg(
        F.min(F.struct(F.col("id").isNull().alias("z"), "id", "rid")).alias("first"), F.count("*").alias("group_size"))
        .where("group_size > 1"), "groups")
    return (docs.join(groups, ident, "left")
            .select("rid", "id", F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("first.rid") == F.col("rid"), F.lit(True)).alias("kept"), "text_sha256"))


def deduplicate(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, with all its columns.

    The rows that stay are found by id; where rows repeat an id, one row per
    (id, normalised text) is left, of which the decision says whether it stays.
    """
    out = materialize(exact_groups(df, text, doc_id).select(F.col("id").alias("__id"), "kept", F.col("text_sha256").alias("__sha")), "kept")
    key = F.col("__id").eqNullSafe(F.col(doc_id))
    several = materialize(out.groupBy("__id").agg(F.count("*").alias("n")).where("n > 1").select("__id"), "repeats")
    stay = out.where("kept").select("__id", "__sha")
    if is_empty(several):
        return df.join(stay, key, "left_semi")
    single = df.join(several, key, "left_anti").join(stay, key, "left_semi")
    again = df.join(several, key, "left_semi").withColumn("__own", F.sha2(normalised(text), 256)).dropDuplicates([doc_id, "__own"])
    again = again.join(stay, key & (F.col("__own") == F.col("__sha")), "left_semi").drop("__own")
    return single.unionByName(again)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_groups(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP8_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""
