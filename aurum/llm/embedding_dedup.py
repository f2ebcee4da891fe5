"""Near-duplicate embeddings by random-hyperplane sign hashing.

Vectors with a label are hashed in several tables: the signs of ``bits``
random projections are a bucket.  Two vectors at the threshold agree in one
sign with probability p = 1 - arccos(threshold) / pi, so a table finds their
pair with p^bits; the number of tables makes the chance to miss it at most
``miss``.  ``bits`` follows the number of vectors per label, so buckets stay
small at every size.  Pairs in a bucket are verified by exact cosine in
double precision (matrix products of blocks), none below the threshold links.

Equal vectors are one node with a count before anything is compared, a bucket
is split into blocks of ``CHUNK`` rows that are compared pair by pair of
blocks, and a block returns sums of links and a spanning forest, never all its
pairs.  A pair counts in the first table that has it.  The components of the
forests' edges are found by distributed contraction.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table
from .components import components

THRESHOLD = 0.98
MISS = 1e-4
CHUNK = 512
#: Vectors that may share a bucket of one label by chance.
PER_BUCKET = 16
SEED = 20240601


def tables_for(vectors: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits, tables) for a number of vectors per label."""
    bits = min(30, max(8, math.ceil(math.log2(max(1, vectors) / PER_BUCKET + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-same))


@lru_cache(maxsize=8)
def _planes(dim: int, n: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, n))


def _unit(rows: list) -> np.ndarray:
    v = np.array(rows, float)
    v /= np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _sign(batches, bits: int, tables: int):
    weights = 1 << np.arange(bits, dtype=np.int64)
    for b in batches:
        vectors = b.column("v").to_pylist()
        sigs = np.zeros((len(vectors), tables), np.int64)
        by_dim: dict[int, list[int]] = {}
        for k, v in enumerate(vectors):
            by_dim.setdefault(len(v), []).append(k)
        for dim, at in by_dim.items():
            signs = _unit([vectors[k] for k in at]) @ _planes(dim, bits * tables) >= 0
            sigs[at] = signs.reshape(len(at), tables, bits) @ weights
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), b.column("label"), pa.array([len(v) for v in vectors], pa.int32()), b.column("v"),
             b.column("copies"), pa.array(sigs.tolist(), pa.list_(pa.int64()))],
            ["node", "label", "dim", "v", "copies", "sigs"])


def _block_links(rows: dict, threshold: float):
    """Links of one pair of blocks: (links per row, spanning forest as index pairs).

    rows: lists by column; part, i and j tell the two blocks apart."""
    unit, sigs = _unit(rows["v"]), np.array(rows["sigs"])
    node, copies = np.array(rows["node"]), np.array(rows["copies"])
    part, i, j, t = np.array(rows["part"]), rows["i"][0], rows["j"][0], rows["t"][0]
    left = np.flatnonzero(part == i)
    right = left if i == j else np.flatnonzero(part == j)
    if not len(left) or not len(right):
        return None
    x, y = np.nonzero(unit[left] @ unit[right].T >= threshold)
    x, y = left[x], right[y]
    ok = (node[x] < node[y]) if i == j else (node[x] != node[y])
    x, y = x[ok], y[ok]
    if not len(x):
        return None
    first = ~(sigs[x, :t] == sigs[y, :t]).any(axis=1) if t else np.ones(len(x), bool)
    n = np.bincount(x[first], copies[y[first]], len(node)) + np.bincount(y[first], copies[x[first]], len(node))
    label = np.arange(len(node))
    forest = []

    def root(k):
        while label[k] != k:
            label[k] = label[label[k]]
            k = label[k]
        return k

    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        a, b = root(a), root(b)
        if a != b:
            label[max(a, b)] = min(a, b)
            forest.append((a, b))
            if len(forest) == len(node) - 1:
                break
    return node, n, forest


KEY = ["label", "dim", "t", "sig", "i", "j"]
_LINKS = ["a", "b", "n"]


def _links(batches, threshold: float):
    """Rows sorted by KEY: per pair of blocks, (node, null, links) and (node, node, 0) for the forest."""
    held: dict[str, list] = {}
    key = None

    def close():
        done = _block_links(held, threshold) if held and len(held["node"]) > 1 else None
        if done is None:
            return None
        node, n, forest = done
        some = np.flatnonzero(n)
        a = [*node[some].tolist(), *(int(node[x]) for x, _ in forest)]
        b = [*[None] * len(some), *(int(node[y]) for _, y in forest)]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                           pa.array([*n[some].astype(int).tolist(), *[0] * len(forest)], pa.int64())], _LINKS)

    for b in batches:
        cols = {name: b.column(name).to_pylist() for name in b.schema.names}
        keys = list(zip(*(cols[k] for k in KEY), strict=True))
        at = 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            if keys[at] != key:
                out = close()
                if out is not None:
                    yield out
                key, held = keys[at], {name: [] for name in cols}
            for name, values in cols.items():
                held[name] += values[at:end]
            at = end
    out = close()
    if out is not None:
        yield out


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str | None = "label",
                    threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and not null (without a label
    column, all are compared) and their cosine is at least ``threshold``.
    Null, empty and zero vectors, vectors with null or non-finite components
    or of another length, and rows with a null id link with nothing.  Rows
    that repeat an id are one node.  Other columns are not read.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"),
                     (F.col(label) if label else F.lit(0)).alias("label"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~odd & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    nodes = materialize(rows.where("good").groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "vectors")

    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(most, threshold, miss)
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    signed = materialize(nodes.mapInArrow(
        lambda it: _sign(it, bits, tables),
        f"node long, label {kinds['label']}, dim int, v {kinds['v']}, copies long, sigs array<long>"), "signed")
    items = signed.select("*", F.posexplode("sigs").alias("t", "sig"))
    bucket = ["label", "dim", "t", "sig"]
    full = materialize(items.groupBy(*bucket).count().where("count > 1"), "buckets")
    items = items.join(full, bucket).withColumn("parts", F.ceil(F.col("count") / CHUNK).cast("int"))
    items = items.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    items = items.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        *bucket, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "v", "copies", "sigs")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = items.repartition(n, *KEY).sortWithinPartitions(*KEY).mapInArrow(
        lambda it: _links(it, threshold), "a long, b long, n long")
    found = materialize(found, "links")

    degree = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    comp = components(found.where("b IS NOT NULL").select("a", "b"))
    known = (nodes.select("label", "v", "node", "copies").join(degree, "node", "left").join(comp, "node", "left")
             .select("label", "v", F.col("node").alias("first"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("comp", "node").alias("comp")).where("n_links > 0"))
    known = materialize(known, "known")
    out = rows.where("good").join(known, ["label", "v"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("comp", "vec_id").alias("component_id"))
    rest = rows.where("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
n AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS r FROM v),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_inner_product(a.e, b.e) / (a.r * b.r) >= 0.98),
reach AS (SELECT vec_id AS s, vec_id AS t FROM embeddings UNION SELECT reach.s, p.b FROM reach JOIN p ON reach.t = p.a),
c AS (SELECT s, min(t) AS component_id FROM reach GROUP BY s),
d AS (SELECT a, count(*) AS k FROM p GROUP BY a)
SELECT e.vec_id, coalesce(d.k, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.s = e.vec_id LEFT JOIN d ON d.a = e.vec_id
"""
