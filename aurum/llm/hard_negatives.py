"""Hard-negative mining with exact integer scores.

Anchors are scored against all rows by tiles: blocks of anchors meet blocks of
rows, and a task multiplies two tiles by Strassen's recursion (seven products
of halves; odd sizes padded with zeros) in integers.  Sums and differences
are exact in 64 bits, also where they wrap around, as long as the scores
themselves fit; a leaf whose entries are small enough is multiplied in doubles,
in which its integers are exact, otherwise in 64-bit integers.

1. *Positives*.  A row meets the anchors of its label only: a label is cut
   into blocks of ``ROWS`` rows and ``ANCHORS`` anchors.  Every pair of blocks gives a
   bounded heap per anchor, its best ``positives`` rows.
2. *Negatives*.  All rows, in blocks whatever their label, meet all anchors with
   the windows of their positives.  Every pair of blocks gives a heap per
   window, its best ``negatives`` rows of another label.

Heaps are mergeable: the best of the union of two heaps are the best of their
rows.  They are merged by a ranking whose limit is applied before and after
the shuffle, so the merge holds no more rows of one heap than its size.

The queries are a stated set (the anchors), so all of them meet all rows, in
blocks; blocks are dealt by a hash of the row's number, so no label, id or
copied vector makes one of them larger.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import look_up, materialize, read_table

#: Rows and anchors of a tile (fewer if vectors are long: TILE_BYTES of 64-bit integers).
ROWS, ANCHORS, TILE_BYTES = 4096, 4096, 64 << 20
#: Rows of a tile and anchors that are multiplied at a time; sides at which the recursion ends.
STEP, LEAF = 1024, 32
#: A double holds all integers up to here.
EXACT = float(1 << 53)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, modulo 2^64."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        if not n or not k or not m:
            return np.zeros((n, m), np.int64)
        most = [max(abs(float(x.max())), abs(float(x.min()))) for x in (a, b)]
        if k * most[0] * most[1] < EXACT:
            return (a.astype(float) @ b.astype(float)).astype(np.int64)
        return a @ b
    a, b = _even(a), _even(b)
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * h), np.int64)
    out[:i, :h] = p1 + p4 - p5 + p7
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def _even(x: np.ndarray) -> np.ndarray:
    """With a row and a column of zeros where their number is odd."""
    if x.shape[0] % 2 == 0 and x.shape[1] % 2 == 0:
        return x
    out = np.zeros((x.shape[0] + x.shape[0] % 2, x.shape[1] + x.shape[1] % 2), np.int64)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones padded with zeros."""
    v = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(v.offsets.to_numpy())
    out = np.zeros((len(v), width), np.int64)
    if len(v):
        flat = v.flatten().to_numpy(zero_copy_only=False)
        out[np.repeat(np.arange(len(v)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def first_of_heaps(heap: np.ndarray, score: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """Positions of the best ``size`` entries of each heap: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, heap))
    h = heap[order]
    start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
    rank = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
    return order[rank < size]


def _best(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, size: int):
    """(row, column) of the best ``size`` allowed entries of each row."""
    least = np.int64(np.iinfo(np.int64).min)
    masked = np.where(allowed, scores, least)
    if scores.shape[1] > size:
        kth = np.partition(masked, scores.shape[1] - size, axis=1)[:, scores.shape[1] - size]
        allowed = allowed & (masked >= kth[:, None])
    row, col = np.nonzero(allowed)
    keep = first_of_heaps(row, scores[row, col], ids[col], size)
    return row[keep], col[keep]


def _tiles(table: pa.Table) -> tuple[dict, dict, int]:
    """The anchors and the rows of a group of two blocks, and their vectors' greatest length."""
    offsets = [np.diff(c.offsets.to_numpy()) for c in table.column("v").chunks]
    width = int(max((o.max() for o in offsets if len(o)), default=0))
    side = table.column("side").to_numpy()
    out = []
    for s in (0, 1):
        part = table.filter(pa.array(side == s))
        x = {c: part.column(c).to_numpy() for c in ("rid", "vec_id", "label")}
        out.append(x | {"v": _matrix(part.column("v"), width), "windows": part.column("windows")})
    return out[0], out[1], width


_POSITIVES = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])


def _positive_heaps(table: pa.Table, size: int) -> pa.Table:
    """The best rows of each anchor in a group of two blocks of one label; an anchor isn't its own positive."""
    a, r, _ = _tiles(table)
    found = []
    for i in range(0, len(a["rid"]), STEP):
        for j in range(0, len(r["rid"]), STEP):
            x, y = slice(i, i + STEP), slice(j, j + STEP)
            scores = strassen(a["v"][x], np.ascontiguousarray(r["v"][y].T))
            row, col = _best(scores, a["rid"][x, None] != r["rid"][None, y], r["vec_id"][y], size)
            found.append(np.stack([row + i, col + j, scores[row, col]]))
    row, col, score = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    keep = first_of_heaps(row, score, r["vec_id"][col], size)
    row, col, score = row[keep], col[keep], score[keep]
    return pa.Table.from_arrays([pa.array(x) for x in (a["rid"][row], a["vec_id"][row], r["vec_id"][col], score)], schema=_POSITIVES)


_NEGATIVES = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int64()), ("positive_id", pa.int64()),
                        ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _negative_heaps(table: pa.Table, size: int, low: int, high: int) -> pa.Table:
    """The best rows of another label in each window, in a group of two blocks."""
    a, r, _ = _tiles(table)
    places = a["windows"].combine_chunks() if isinstance(a["windows"], pa.ChunkedArray) else a["windows"]
    n = np.diff(places.offsets.to_numpy()) if len(places) else np.empty(0, np.int64)
    entry, owner = places.flatten(), np.repeat(np.arange(len(n)), n)  # a window and its anchor
    place, pid, top = (entry.field(x).to_numpy() for x in range(3))
    # bounds of the window in integers: low * top <= 100 * score <= high * top
    least, most = -((-low * top) // 100), (high * top) // 100
    found = []
    for i in range(0, len(n), STEP):
        own = np.flatnonzero((owner >= i) & (owner < i + STEP))
        for j in range(0, len(r["rid"]), STEP):
            x, y = slice(i, i + STEP), slice(j, j + STEP)
            scores = strassen(a["v"][x], np.ascontiguousarray(r["v"][y].T))
            other = a["label"][x, None] != r["label"][None, y]
            for k in np.unique(place[own]).tolist():  # one window of every anchor at a time
                w = own[place[own] == k]
                s = scores[owner[w] - i]
                row, col = _best(s, other[owner[w] - i] & (s >= least[w, None]) & (s <= most[w, None]), r["vec_id"][y], size)
                found.append(np.stack([w[row], col + j, s[row, col]]))
    w, col, score = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    keep = first_of_heaps(w, score, r["vec_id"][col], size)
    w, col, score = w[keep], col[keep], score[keep]
    row = owner[w]
    return pa.Table.from_arrays([pa.array(x) for x in (a["rid"][row], a["vec_id"][row], place[w], pid[w], top[w], r["vec_id"][col], score)],
                                schema=_NEGATIVES)


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} long" for f in schema)


def _dealt(rows: DataFrame, blocks: Column) -> Column:
    """A block number below ``blocks``, alike for all rows whatever they hold."""
    return F.pmod(F.xxhash64("rid"), blocks.cast("long"))


def _both(anchors: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Anchors (side 0) and rows (side 1) of every pair of blocks, by the pair."""
    cols = list(dict.fromkeys([*keys, "rid", "vec_id", "label", "v", "windows"]))
    none = F.lit(None).cast("array<struct<place:bigint,positive_id:bigint,positive_score:bigint>>")
    both = anchors.withColumn("side", F.lit(0)).select("side", *cols).unionByName(
        rows.withColumns({"side": F.lit(1), "windows": none}).select("side", *cols))
    return both.groupBy(*keys)


def _copies(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1))


def _ranked(found: DataFrame, keys: list[str], score: str, ident: str, name: str, size: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
    return found.withColumn(name, F.row_number().over(w)).where(F.col(name) <= size)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id (long), label, v (array of long); ``anchor``: which rows are
    anchors.  Per anchor its best ``positives`` other rows of its label; per
    positive its best ``negatives`` rows of another label whose score s fits
    low * p <= 100 * s <= high * p, p the positive's score; ties by smaller vec_id.

    Rows with a null id, label, vector or component take no part.  A shorter
    vector is padded with zeros.  Rows that repeat an id are rows of their own:
    each is an anchor, and one may be the other's positive.  Other columns are
    not read.  Scores must fit into 64 bits.  No anchor, or none with a positive
    and a negative in its window, gives an empty result.
    """
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL)")
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
                                   F.col("label").cast("long").alias("label"), "v", anchor.alias("anchor")), "rows")
    first = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("anchors"), F.max(F.size("v")).alias("width")).first()
    fits = max(1, TILE_BYTES // (8 * max(1, first["width"] or 0)))
    per, per_anchors = min(ROWS, fits), min(ANCHORS, fits)
    blocks, anchor_blocks = (F.lit(max(1, -(-x // y))) for x, y in ((first["n"], per), (first["anchors"], per_anchors)))
    none = F.lit(None).cast("array<struct<place:bigint,positive_id:bigint,positive_score:bigint>>")

    # one label: its rows in blocks, its anchors in blocks, all pairs of these
    sizes = rows.groupBy("label").agg(F.count("*").alias("uses"), F.ceil(F.count("*") / per).alias("blocks"),
                                      F.ceil(F.count(F.when(F.col("anchor"), 1)) / per_anchors).alias("anchor_blocks"))
    sized = look_up(rows, sizes, "label", first["n"]).where("anchor_blocks > 0")
    queries = sized.where("anchor").withColumns({"ab": _dealt(sized, F.col("anchor_blocks")), "windows": none}).withColumn("rb", _copies(F.col("blocks")))
    others = sized.withColumn("rb", _dealt(sized, F.col("blocks"))).withColumn("ab", _copies(F.col("anchor_blocks")))
    found = _both(queries, others, ["label", "ab", "rb"]).applyInArrow(lambda t: _positive_heaps(t, positives), _ddl(_POSITIVES))
    best = materialize(_ranked(found, ["anchor"], "positive_score", "positive_id", "place", positives), "positives")

    windows = best.groupBy(F.col("anchor").alias("rid")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "positive_id", "positive_score"))).alias("windows"))
    queries = rows.where("anchor").join(windows, "rid").withColumn("ab", _dealt(rows, anchor_blocks)).withColumn("rb", _copies(blocks))
    others = rows.withColumn("rb", _dealt(rows, blocks)).withColumn("ab", _copies(anchor_blocks))
    found = _both(queries, others, ["ab", "rb"]).applyInArrow(lambda t: _negative_heaps(t, negatives, low, high), _ddl(_NEGATIVES))
    return _ranked(found, ["anchor", "place"], "negative_score", "negative_id", "rank", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def integer_rows(embeddings: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", shift: int = 7) -> DataFrame:
    """vec_id, label, v of vectors as integers: floor(256 x) of every component.

    The label becomes (label + 1) % 10 where vec_id is divisible by ``shift``.
    Vectors with a null or non-finite component become null.  Components are
    clipped to 2^27 either way (no unit vector comes near), so that scores of up to 512
    components fit into 64 bits."""
    v = F.col(vector)
    finite = f"forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    whole = F.transform(v, lambda x: F.floor(F.least(F.lit(float(1 << 27)), F.greatest(F.lit(-float(1 << 27)), 256.0 * x.cast("double")))))
    moved = F.when(F.col(vec_id) % shift == 0, (F.col(label).cast("long") + 1) % 10).otherwise(F.col(label).cast("long"))
    return embeddings.select(F.col(vec_id).alias("vec_id"), moved.alias("label"), F.when(F.expr(finite), whole).alias("v"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors: the rows whose vec_id is divisible by 100."""
    rows = integer_rows(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return mine(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM r WHERE vec_id % 100 = 0),
scored AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, r.rid, r.vec_id, a.label = r.label AS same,
         list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM a JOIN r ON a.rid <> r.rid),
pos AS (
  SELECT arid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same QUALIFY place <= 5)
SELECT pos.anchor_id, positive_id, row_number() OVER (PARTITION BY pos.arid, place ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN scored ON scored.arid = pos.arid AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
