"""Similarity join on word shingles by multiple-global-order prefix filtering.

Texts are sets of ``width``-word shingles; two link when their Jaccard
similarity is at least ``percent`` / 100.  A set of n shingles that overlaps
another that much shares at least one of its first n - ceil(t n) + 1 shingles,
under *any* order of all shingles.  Several orders are used: all put rare
shingles first (by class of document frequency) and differ in the order within
a class; a candidate must share a prefix shingle under each of them, and the
candidates left are verified on their sets.

1. *Frequencies* (``_requests``, ``_answers``).  Document frequencies are exact
   and over all documents.  A task sends each shingle of a buffer of documents
   once to the block of the shingle, packed into binaries: shingles that occur
   once in the buffer with their document, the others with their count (so a
   shingle of a third of all documents costs one entry per buffer).  The block
   answers with frequency classes and only those single shingles that another
   document has as well; a shingle of one document can't link anything.
2. *Prefixes* (``_profiles``).  Per document: number of shingles, key of its
   set, shared shingles, prefix under each order.  Most documents have only
   unshared shingles in their prefix and are done here.
3. *Links*.  Documents with equal sets are one node.  In rounds, each prefix
   shingle's list picks a hub, members of other components are verified
   against it, and what links is contracted; lists within one component are
   left out from then on.  Pairs that sizes or sketches rule out are not made.  What is still undecided is compared list by list
   (``undecided_pairs``): members outside a list's largest component with all
   members, in blocks of ``CHUNK``, so that no task holds a whole list; a pair
   that shares many lists is made in the first of them.

Shingles are 64-bit hashes for counting a set and named by 40 bits and their
block for comparing; memory per task is bounded by the buffer and block sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, sliced, text_blocks
from .components import components
from .presplit import Memo

#: Shingles and documents that a task gathers before it sends them.
BUFFER_TOKENS, BUFFER_DOCS = 1 << 20, 1 << 13
#: Bytes of text for each block of shingles, and least number of blocks.
BLOCK_BYTES, BLOCKS = 12 << 20, 16
#: Members of a list that are compared with each other in one group.
CHUNK = 256
#: Lists that a member of an undecided list carries, to make a pair in one list only.
EARLIER = 8
HUB_ROUNDS = 2
LOW = np.uint64((1 << 40) - 1)

_WORD = Memo(xxhash.xxh3_64_intdigest, 200_000)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted different 64-bit hashes of a text's shingles (A-Z lower-cased,
    words are runs without ASCII white space; fewer words are one shingle)."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\0" + b" ".join(words))], np.uint64)
    h = np.fromiter(map(_WORD.__getitem__, words), np.uint64, len(words))
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = _mix(out + h[i:i + n], i + 1)
    return np.unique(out)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (fixed odd multipliers), different for each seed."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pack(low: np.ndarray) -> bytes:
    return np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


#: kind 0: shingles of (gid, block); 1: documents of the shared ones; 2: the documents of gid.
PACKED = ("block int, gid long, kind int, once binary, docs binary, often binary, counts binary, "
          "ids array<long>, sizes array<int>, keys binary")
_ARROW = pa.schema([("block", pa.int32()), ("gid", pa.int64()), ("kind", pa.int32()), ("once", pa.binary()), ("docs", pa.binary()),
                    ("often", pa.binary()), ("counts", pa.binary()), ("ids", pa.list_(pa.int64())),
                    ("sizes", pa.list_(pa.int32())), ("keys", pa.binary())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _requests(batches: Iterator[pa.RecordBatch], width: int, blocks: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    ids, sets, held = [], [], 0

    def send():
        nonlocal ids, sets, held, number
        gid = part << 24 | number
        number += 1
        tok = np.concatenate(sets)
        doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype("<u2")
        name = ((tok >> np.uint64(40)) % np.uint64(blocks)) << np.uint64(40) | tok & LOW
        order = np.argsort(name, kind="stable")
        name, doc = name[order], doc[order]
        first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]]) if len(name) else np.empty(0, np.int64)
        count = np.diff(np.append(first, len(name)))
        lone = np.repeat(count == 1, count)
        block = (name >> np.uint64(40)).astype(np.int64)
        at = np.searchsorted(block, np.arange(blocks + 1))
        uname, ublock = name[first], block[first]
        uat = np.searchsorted(ublock, np.arange(blocks + 1))
        rows = []
        for b in range(blocks):
            x, y = at[b], at[b + 1]
            if x < y:
                one, many = lone[x:y], count[uat[b]:uat[b + 1]] > 1
                rows.append({"block": b, "gid": gid, "kind": 0, "once": _pack(name[x:y][one] & LOW), "docs": doc[x:y][one].tobytes(),
                             "often": _pack(uname[uat[b]:uat[b + 1]][many] & LOW),
                             "counts": count[uat[b]:uat[b + 1]][many].astype("<u4").tobytes()})
        rows.append({"block": gid % blocks, "gid": gid, "kind": 1, "docs": doc[~lone].tobytes(),
                     "counts": count[count > 1].astype("<u4").tobytes()})
        rows.append({"block": gid % blocks, "gid": gid, "kind": 2, "ids": ids, "sizes": [len(s) for s in sets],
                     "keys": b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)})
        ids, sets, held = [], [], 0
        return _batch(rows)

    for b in sliced(batches):
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            s = shingle_hashes(t, width)
            ids.append(i)
            sets.append(s)
            held += len(s)
            if held >= BUFFER_TOKENS or len(sets) >= BUFFER_DOCS:
                yield send()
    if sets:
        yield send()


def _answers(table: pa.Table) -> pa.Table:
    """One block: the shared shingles of each gid with their frequency classes (in ``keys``: once, then often)."""
    out, asked, parts, weights = [], [], [], []
    for r in table.to_pylist():
        if r["kind"]:
            out.append(r)
            continue
        once, often = _unpack(r["once"]), _unpack(r["often"])
        asked.append((r, len(once)))
        parts += [once, often]
        weights += [np.ones(len(once)), np.frombuffer(r["counts"], "<u4").astype(float)]
    if asked:
        names, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        df = np.bincount(inverse, np.concatenate(weights), len(names))
        kind = np.minimum(255, 8 * np.log2(df)).astype(np.uint8)  # any function of the frequency is an order; 0: one document
        at = 0
        for (r, n), often in zip(asked, parts[1::2], strict=True):
            mine = kind[inverse[at:at + n + len(often)]]
            at += len(mine)
            shared = mine[:n] > 0
            if shared.any() or len(often):
                out.append({"block": r["block"], "gid": r["gid"], "kind": 0, "once": _pack(_unpack(r["once"])[shared]),
                            "docs": np.frombuffer(r["docs"], "<u2")[shared].tobytes(), "often": r["often"],
                            "counts": None, "keys": mine[:n][shared].tobytes() + mine[n:].tobytes()})
    return pa.Table.from_pylist(out, schema=_ARROW)


PROFILE = ("rid long, id long, n int, set_key binary, lone int, sketch array<long>, shared array<long>, "
           "prefixes array<array<long>>")
#: Bits of a sketch: bit b is the parity of the shared shingles that hash to b, so two
#: sets differ in at least as many shingles as their sketches differ in bits.
SKETCH = 256


def _profiles(table: pa.Table, percent: int, orders: int) -> pa.Table:
    """One gid: a row per document; prefixes is null where no prefix shingle is shared."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["block"]))
    name, doc, kind, often, often_kind = [], [], [], [], []
    docs = counts = b""
    head = {}
    for r in rows:
        if r["kind"] == 0:
            top = np.uint64(r["block"] << 40)
            once = _unpack(r["once"]) | top
            k = np.frombuffer(r["keys"], np.uint8)
            name.append(once)
            doc.append(np.frombuffer(r["docs"], "<u2"))
            kind.append(k[:len(once)])
            often.append(_unpack(r["often"]) | top)
            often_kind.append(k[len(once):])
        elif r["kind"] == 1:
            docs, counts = r["docs"], r["counts"]
        else:
            head = r
    n_docs = len(head["ids"])
    if often:
        times = np.frombuffer(counts, "<u4")
        name.append(np.repeat(np.concatenate(often), times))
        kind.append(np.repeat(np.concatenate(often_kind), times))
        doc.append(np.frombuffer(docs, "<u2"))
    name = np.concatenate(name) if name else np.empty(0, np.uint64)
    doc = np.concatenate(doc).astype(np.int64) if doc else np.empty(0, np.int64)
    kind = np.concatenate(kind) if kind else np.empty(0, np.uint8)
    order = np.lexsort((name, doc))
    name, doc, kind = name[order], doc[order], kind[order]
    at = np.searchsorted(doc, np.arange(n_docs + 1))
    sizes = np.array(head["sizes"], np.int64)
    # n - ceil(t n) + 1 shingles; the unshared ones come first in every order
    take = sizes - (percent * sizes + 99) // 100 + 1 - (sizes - np.diff(at))
    mixed = [_mix(name, 101 + k) for k in range(orders)]
    bit = doc * SKETCH + (_mix(name, 77) % np.uint64(SKETCH)).astype(np.int64)
    odd = (np.bincount(bit, minlength=n_docs * SKETCH) & 1).astype(np.uint8).reshape(n_docs, SKETCH)
    sketches = np.packbits(odd, axis=1).view("<i8")
    shared, prefixes = [], []
    for d in range(n_docs):
        x, y = at[d], at[d + 1]
        if take[d] <= 0 or x == y:
            shared.append(None)
            prefixes.append(None)
            continue
        shared.append(name[x:y].astype(np.int64))
        prefixes.append([name[x:y][np.lexsort((m[x:y], kind[x:y]))[:take[d]]].astype(np.int64) for m in mixed])
    keys = head["keys"]
    return pa.table({
        "rid": pa.array([head["gid"] << 16 | d for d in range(n_docs)], pa.int64()), "id": pa.array(head["ids"], pa.int64()),
        "n": pa.array(head["sizes"], pa.int32()), "set_key": pa.array([keys[16 * d:16 * d + 16] for d in range(n_docs)], pa.binary()),
        "lone": pa.array(sizes - np.diff(at), pa.int32()), "sketch": pa.array(sketches.tolist(), pa.list_(pa.int64())),
        "shared": pa.array(shared, pa.list_(pa.int64())), "prefixes": pa.array(prefixes, pa.list_(pa.list_(pa.int64())))})


def profiles(df: DataFrame, text: str, doc_id: str, width: int, percent: int, orders: int) -> DataFrame:
    src = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    blocks = text_blocks(src, "t", BLOCK_BYTES, BLOCKS)
    asked = src.mapInArrow(lambda it: _requests(it, width, blocks), PACKED)
    answered = asked.groupBy("block").applyInArrow(_answers, PACKED)
    return answered.groupBy("gid").applyInArrow(lambda t: _profiles(t, percent, orders), PROFILE)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """The pairs (a, b) that share a prefix shingle in every order and are similar enough."""
    left, right = (sets.select(*(F.col(c).alias(f"{c}_{s}") for c in sets.columns)) for s in "ab")
    both = pairs.join(left, pairs.a == F.col("rid_a")).join(right, pairs.b == F.col("rid_b"))
    for k in range(orders):
        both = both.where(F.arrays_overlap(F.col("prefixes_a")[k], F.col("prefixes_b")[k]))
    same = F.size(F.array_intersect("shared_a", "shared_b"))
    return both.withColumn("same", same).where(100 * F.col("same") >= percent * (F.col("n_a") + F.col("n_b") - F.col("same"))).select("a", "b")


def undecided_pairs(members: DataFrame, traits: list[str], close) -> DataFrame:
    """Pairs (a, b) of the lists' members (tok, rid, comp, g, traits) that are of
    different components and ``close``; a pair may come more than once.

    A list's members outside its largest component meet all members, in blocks of
    ``CHUNK``.  Lists are ordered by size, the largest first.  A member carries the
    first ``EARLIER`` lists it is in, and a pair that has one of these in common
    is made there and not in a later list; its first common list always makes it."""
    main = members.groupBy("tok", "comp").agg(F.count("*").alias("k")).groupBy("tok").agg(F.max(F.struct("k", "comp")).alias("main"))
    first = members.groupBy("rid").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("g")).alias("z"), "tok"))), 1, EARLIER)["tok"].alias("first"))
    place = F.array_position("first", F.col("tok"))
    rows = members.join(main, "tok").join(first, "rid").select(
        "tok", "rid", "comp", *traits, F.expr("comp = main.comp").alias("inside"),
        F.when(place == 0, F.col("first")).otherwise(F.slice("first", 1, F.greatest(place - 1, F.lit(0)).cast("int"))).alias("earlier"),
        F.ceil(F.col("g") / CHUNK).cast("int").alias("all_parts"), F.ceil((F.col("g") - F.col("main.k")) / CHUNK).cast("int").alias("parts"))

    def dealt(own: str, other: str):
        """The rows in one block of their own side, for each of the other side's."""
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("j")
        return "*", F.pmod(F.xxhash64("rid"), own).cast("int").alias("i"), every

    x = rows.where("NOT inside").select(*dealt("parts", "all_parts")).drop("all_parts", "parts", "inside")
    y = rows.select(*dealt("all_parts", "parts")).select(
        F.col("tok").alias("tok_2"), F.col("i").alias("j_2"), F.col("j").alias("i_2"), "inside", F.col("earlier").alias("earlier_2"),
        *(F.col(c).alias(f"{c}_2") for c in ("rid", "comp", *traits)))
    met = x.join(y, [F.col("tok") == F.col("tok_2"), F.col("i") == F.col("i_2"), F.col("j") == F.col("j_2"), F.col("comp") != F.col("comp_2"),
                     F.col("inside") | (F.col("rid") < F.col("rid_2")), close(F.col, lambda c: F.col(f"{c}_2")),
                     ~F.arrays_overlap("earlier", "earlier_2")])
    return met.select(F.least("rid", "rid_2").alias("a"), F.greatest("rid", "rid_2").alias("b"))


def jaccard_components(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, percent: int = 80,
                       orders: int = 3) -> DataFrame:
    """One row per row of ``df``: rid, id, n_shingles, component_id, kept.

    component_id is the smallest id among the rows reachable by links; kept
    marks one row per component (the one with that id; of rows that repeat it,
    one).  Null and empty texts have no shingles and link with nothing.  The
    id must fit a long; a null id comes last and is its own component's id
    only if no other is there.  Other columns of ``df`` are not read.
    """
    prof = materialize(profiles(df, text, doc_id, width, percent, orders), "profiles")

    def close(a, b):
        """Whether the sizes and the sketches leave the similarity possible (columns n, lone, s0, s1, ...)."""
        differ = sum((F.bit_count(a(f"s{k}").bitwiseXOR(b(f"s{k}"))) for k in range(SKETCH // 64)), a("lone") + b("lone"))
        return (100 * F.least(a("n"), b("n")) >= percent * F.greatest(a("n"), b("n"))) & (
            (100 + percent) * differ <= (100 - percent) * (a("n") + b("n")))

    traits = ["n", "lone", *(f"s{k}" for k in range(SKETCH // 64))]

    # equal sets are one node, the row with the smallest rid
    active = prof.where("prefixes IS NOT NULL")
    nodes = materialize(active.groupBy("set_key").agg(F.min("rid").alias("node")), "nodes")
    sets = materialize(active.join(nodes.select(F.col("node").alias("rid")), "rid", "left_semi")
                       .select("rid", "n", "lone", "sketch", "shared", "prefixes"), "sets")
    lists = materialize(sets.select(F.explode(F.col("prefixes")[0]).alias("tok"), "rid", "n", "lone",
                                    *(F.col("sketch")[k].alias(f"s{k}") for k in range(SKETCH // 64))), "lists")
    sets = sets.select("rid", "n", "shared", "prefixes")
    label = sets.select("rid", F.col("rid").alias("comp"))

    links = None
    for r in range(HUB_ROUNDS + 1):
        members = lists.join(label, "rid")
        hub = F.min(F.struct(F.xxhash64(F.lit(r), "rid").alias("h"), "rid", "comp", *traits)).alias("hub")
        mixed = members.groupBy("tok").agg(hub, F.count("*").alias("g"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        mixed = materialize(mixed.where("lo <> hi" if r == 0 else "lo <> hi AND g > 2").select("tok", "hub", "g"), "mixed")
        members = members.join(mixed, "tok")
        if r < HUB_ROUNDS:
            near = close(F.col, lambda c: F.col(f"hub.{c}"))
            pairs = members.where((F.col("comp") != F.col("hub.comp")) & near).select(
                F.col("rid").alias("a"), F.col("hub.rid").alias("b"))
        else:
            pairs = undecided_pairs(members, traits, close)
        found = materialize(_verified(pairs.distinct(), sets, percent, orders), "links")
        links = found if links is None else links.unionByName(found)
        comps = components(links)
        label = materialize(label.select("rid").join(comps.withColumnRenamed("node", "rid"), "rid", "left")
                            .select("rid", F.coalesce("comp", "rid").alias("comp")), "labels")

    # rows -> nodes -> components -> the smallest id of each
    comp = materialize(nodes.join(label.withColumnRenamed("rid", "node"), "node").select("set_key", "comp"), "comps")
    rows = prof.select("rid", "id", "n", "set_key").join(comp, "set_key", "left").select(
        "rid", "id", "n", F.when(F.col("n") > 0, F.col("comp")).alias("comp")).withColumn("comp", F.coalesce("comp", "rid"))
    rows = materialize(rows, "rows")
    several = materialize(rows.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "rid")).alias("first"),
                                                   F.count("*").alias("g")).where("g > 1").select("comp", "first"), "several")
    return rows.join(several, "comp", "left").select(
        "rid", "id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        F.coalesce(F.col("first.rid") == F.col("rid"), F.lit(True)).alias("kept"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_components(read_table(spark, sf_dir, "documents"), width=3, percent=90)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS s, doc_id AS t FROM documents UNION SELECT reach.s, l.b FROM reach JOIN l ON reach.t = l.a),
c AS (SELECT s, min(t) AS component_id FROM reach GROUP BY s)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d JOIN c ON c.s = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
