"""Language-model scoring by prediction by partial matching (PPM).

A text is its words (A-Z lower-cased, runs without ASCII white space), one
blank between them, and one end token.  The model predicts it byte by byte from
the bytes before, across word borders: the longest context is the last
``contexts.ORDER`` bytes; a symbol never seen there escapes to the next shorter
context, one order at a time, down to all symbols alike.  Symbols seen in a
longer context are excluded from the shorter one, and shorter contexts are
updated only where the longer one was new.  The escape of a context is
estimated over all contexts like it (order, place in a word, occurrences,
different symbols): how often, leaving one occurrence out, it would have been
new.  A text's code length is the sum over its bytes; its score is the log10
probability.  Contexts at a text's start reach into end tokens put before it.

All training texts count, and nothing is pruned or sampled:

1. a task gathers a buffer of texts and sends its different words, and its
   different grams (a context of the longest order and a symbol), once each
   with their training counts to blocks; the texts go on compressed;
2. a block of grams holds whole contexts; it adds up the counts and returns
   what several blocks share: arcs of at most two bytes and a symbol (256^3,
   whatever the input), arcs of hot contexts, and counts by escape state;
3. a block gives every requested gram its code length, a block of words every
   word its training count (for the unigram base);
4. a buffer adds them up for its texts.

Grams are dealt to blocks by their last three bytes.  A context that holds a
large share of all grams is hot and dealt by one byte more, up to the longest
order; fewer than ``HOT`` contexts of each order are hot, so what blocks share of
them is at most ``HOT`` x 256 arcs an order.  Which are hot is found on a sample of
texts: it decides where grams go, not what they cost.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contexts as C
from .common import materialize, read_table, sliced

#: Bytes and texts of a buffer (a task holds some 10 bytes for each byte; what is sent falls as buffers grow),
#: bytes and texts of it that are worked on at a time.
BUFFER_BYTES, BUFFER_TEXTS, PIECE_BYTES, PIECE_TEXTS = 16 << 20, 1 << 16, 1 << 20, 4096
#: Grams that are gathered before equal ones are merged.
MERGE = 2_000_000
#: Bytes of text for each block, and least number of blocks.
BLOCK_BYTES, BLOCKS = 16 << 20, 16
#: A context with at least 1 in HOT of the grams is hot; bytes of text, in the mean, that are looked at for it.
HOT, LOOK_BYTES = 1024, 32 << 20
#: A symbol that no word has: the end token.
END = b"\t"
FOLDS, HELD_OUT = 7, 2

ROWS = "block int, gid long, kind int, words binary, counts binary, ids array<long>, held array<boolean>, sizes array<int>"
_ROWS = pa.schema([("block", pa.int32()), ("gid", pa.int64()), ("kind", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()),
                   ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32()))])
#: Kinds of rows: a block's words, a buffer's texts, a block's grams.
WORDS, TEXTS, GRAMS = 0, 1, 2


def is_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def blocks_of(words: list[bytes], blocks: int) -> np.ndarray:
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(blocks)).astype(np.int64)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _pieces(bodies: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of closed texts and the place of the text of each, about ``PIECE_BYTES``
    at a time; a longer text comes in several pieces, each behind the bytes before it."""
    held, sizes, owner = [], [], []

    def grams():
        return C.grams(np.frombuffer(b"".join(held), np.uint8), np.array(sizes)), np.repeat(owner, sizes)

    for i, t in enumerate(bodies):
        whole = END * C.ORDER + t
        for at in range(0, len(t), PIECE_BYTES):
            held.append(whole[at:at + PIECE_BYTES + C.ORDER])
            sizes.append(len(held[-1]) - C.ORDER)
            owner.append(i)
            if sum(sizes) >= PIECE_BYTES or len(sizes) >= PIECE_TEXTS:
                yield grams()
                held, sizes, owner = [], [], []
    if sizes:
        yield grams()


def _different(bodies: list[bytes], held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different grams of a buffer's texts, sorted, with their training counts."""
    parts, size = [], 0
    for keys, owner in _pieces(bodies):
        keys = np.sort(keys << np.uint64(1) | held[owner].astype(np.uint64))  # a gram has 56 bits
        train = 1 - (keys & np.uint64(1)).astype(np.int64)
        keys >>= np.uint64(1)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        parts.append((keys[first], np.add.reduceat(train, first)))
        size += len(first)
        if size > MERGE:  # so that memory follows the different grams
            parts = [C.added(*parts)]
            size = 0
    keys, n = C.added(*parts)
    return keys, n.astype("<u4")


def _sorted_pieces(bodies: list[bytes]) -> tuple[list[tuple], np.ndarray]:
    """Of each piece its different grams, at which of its sorted symbols they start (bits),
    its first text, and the text of each sorted symbol counted from that one; and the
    different grams of all pieces, sorted."""
    pieces, parts, size = [], [], 0
    for some, owner in _pieces(bodies):
        order = np.argsort(some, kind="stable")  # half the time of the default
        some = some[order]
        new = np.concatenate([[True], some[1:] != some[:-1]])
        pieces.append((some[new], np.packbits(new), int(owner[0]), (owner[order] - owner[0]).astype(np.uint16)))  # under PIECE_TEXTS
        parts.append(pieces[-1][0])
        size += len(parts[-1])
        if size > MERGE:
            parts, size = [C.different(np.concatenate(parts))], 0
    return pieces, C.different(np.concatenate(parts or [np.empty(0, np.uint64)]))


def _in_blocks(keys: np.ndarray, blocks: int, hot: dict) -> tuple[np.ndarray, list[int]]:
    """Order of sorted grams by block, and where the blocks start."""
    block = C.blocks_of(keys, blocks, hot)
    order = np.argsort(block, kind="stable")
    return order, np.searchsorted(block[order], np.arange(blocks + 1)).tolist()


def _words_in_blocks(words, blocks: int) -> tuple[list[bytes], list[int]]:
    """Different words sorted by block and word, and where the blocks start."""
    words = sorted(words)
    block = blocks_of(words, blocks)
    order = np.argsort(block, kind="stable")
    return [words[i] for i in order.tolist()], np.searchsorted(block[order], np.arange(blocks + 1)).tolist()


def _gather(batches, blocks: int, hot: dict):
    """Step 1: rows of the kinds WORDS, TEXTS and GRAMS."""
    part, number = TaskContext.get().partitionId(), 0
    ids, held, sizes, bodies, length = [], [], [], [], 0
    count: dict[bytes, int] = {}

    def send():
        nonlocal number
        gid = part << 24 | number
        number += 1
        words, at = _words_in_blocks(count, blocks)
        n = np.array([count[w] for w in words], "<u4")
        yield from ({"block": b, "gid": gid, "kind": WORDS, "words": C.pack_bytes(b" ".join(words[x:y])), "counts": C.pack(n[x:y])}
                    for b, (x, y) in enumerate(zip(at, at[1:], strict=False)) if x < y)
        keys, n = _different(bodies, np.array(held, bool))
        order, at = _in_blocks(keys, blocks, hot)
        keys, n = keys[order], n[order]
        yield from ({"block": b, "gid": gid, "kind": GRAMS, "words": C.pack_keys(keys[x:y]), "counts": C.pack(n[x:y])}
                    for b, (x, y) in enumerate(zip(at, at[1:], strict=False)) if x < y)
        yield {"block": gid % blocks, "gid": gid, "kind": TEXTS, "ids": ids, "held": held, "sizes": sizes, "words": C.pack_bytes(b"".join(bodies))}

    def sent():
        rows = []
        for r in send():
            rows.append(r)
            if len(rows) >= 256:
                yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)

    for b in sliced(batches):
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            w = split(t)
            out = is_held_out(i)
            ids.append(i)
            held.append(out)
            sizes.append(len(w))
            bodies.append(b" ".join(w) + END)
            for x, c in Counter(w).items():
                count[x] = count.get(x, 0) + (0 if out else c)
            length += len(bodies[-1])
            if length >= BUFFER_BYTES or len(ids) >= BUFFER_TEXTS:
                yield from sent()
                ids, held, sizes, bodies, length = [], [], [], [], 0
                count = {}
    if ids:
        yield from sent()


def _hot_contexts(src: DataFrame, share: float) -> dict[int, np.ndarray]:
    """Contexts between the shared and the longest order that hold at least 1 in
    ``HOT`` of the grams of a sample of texts, by order, sorted."""
    def count(batches):
        seen = {k: (np.empty(0, np.uint64), np.empty(0, np.int64)) for k in range(C.SHARED, C.ORDER)}
        for b in sliced(batches, 4096):
            for keys, _ in _pieces([b" ".join(split(t)) + END for t in b.column(0).to_pylist()]):
                for k in seen:  # order SHARED stands for the whole number
                    seen[k] = C.added(seen[k], np.unique(keys & C.mask(k) if k > C.SHARED else keys & np.uint64(0), return_counts=True))
        for k, (arcs, n) in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k)), pa.array(arcs.view(np.int64)), pa.array(n)], ["k", "context", "n"])

    some = src.where(F.pmod(F.xxhash64("id", "t"), F.lit(1 << 20)) < int(share * (1 << 20))).select("t")
    rows = some.mapInArrow(count, "k long, context long, n long").groupBy("k", "context").agg(F.sum("n").alias("n"))
    rows = materialize(rows, "contexts")
    total = rows.where(F.col("k") == C.SHARED).agg(F.sum("n")).first()[0] or 0
    found = rows.where((F.col("k") > C.SHARED) & (F.col("n") * HOT >= total)).collect()  # fewer than HOT + 1 of an order
    return {k: np.sort(np.array([r["context"] for r in found if r["k"] == k], np.int64).view(np.uint64)) for k in range(C.SHARED + 1, C.ORDER)}


def _merged_words(rows: list[dict]) -> tuple[list[list[bytes]], dict[bytes, int]]:
    """Each row's words, and the training counts of a block's words."""
    count: dict[bytes, int] = {}
    words = [C.unpack_bytes(r["words"]).split(b" ") for r in rows]
    for r, some in zip(rows, words, strict=True):
        for w, c in zip(some, C.unpack(r["counts"], "<u4").tolist(), strict=True):
            count[w] = count.get(w, 0) + c
    return words, count


def _merged_grams(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """A block's different grams, sorted, their training counts, and each row's grams."""
    got = [C.unpack_keys(r["words"]) for r in rows]
    every = C.added(*((some, C.unpack(r["counts"], "<u4")) for some, r in zip(got, rows, strict=True)))
    return *every, got


STATS = "kind int, key long, n long"
#: Kinds of sums: training tokens, different ones, escapes left out that were new, or not; ARC + k: arcs of order k.
TOKENS, TYPES, NEW, OLD, ARC = 0, 1, 2, 3, 10


def _block_stats(table: pa.Table, hot: dict) -> pa.Table:
    """Step 2, one block: rows (kind, key, n) that add up to the shared model."""
    rows = table.to_pylist()
    if rows[0]["kind"] == WORDS:
        count = _merged_words(rows)[1]
        out = [(TOKENS, [0], [sum(count.values())]), (TYPES, [0], [sum(c > 0 for c in count.values())])]
    else:
        keys, n, _ = _merged_grams(rows)
        own, part = C.block_arcs(keys[n > 0], n[n > 0], hot)
        new, old = (sum(x) for x in zip(*(C.Order(k, *x).left_out() for k, x in own.items()), strict=True))
        out = [(ARC + k, *x) for k, x in part.items()] + [(k, np.flatnonzero(x), x[x > 0]) for k, x in ((NEW, new), (OLD, old))]
    return pa.concat_tables([pa.table({"kind": pa.array(np.full(len(x), k, np.int32)), "key": pa.array(np.asarray(x).astype(np.int64)),
                                       "n": pa.array(np.asarray(c, np.int64))}) for k, x, c in out])


def _score_rows(table: pa.Table, model: C.Model, hot: dict) -> pa.Table:
    """Step 3: counts of the words, or log10 probabilities of the grams, of each gid."""
    asked = table.to_pylist()
    if asked[0]["kind"] == WORDS:
        words, count = _merged_words(asked)
        values = (np.array([count[w] for w in some], "<u8") for some in words)
    else:
        keys, n, got = _merged_grams(asked)
        p = model.log10(keys, C.block_arcs(keys[n > 0], n[n > 0], hot)[0]).astype("<f4")
        values = (p[np.searchsorted(keys, some)] for some in got)
    return pa.Table.from_pylist([{"block": r["block"], "gid": r["gid"], "kind": r["kind"], "counts": C.pack_values(v)}
                                 for r, v in zip(asked, values, strict=True)], schema=_ROWS)


SCORED = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score_texts(table: pa.Table, totals: tuple[int, int, int], blocks: int, hot: dict) -> pa.Table:
    """Step 4: one buffer's texts.  totals: training tokens, different ones, end tokens."""
    rows = sorted(table.select(["kind", "block", "counts"]).to_pylist(), key=lambda r: (r["kind"], r["block"]))
    texts = table.filter(pa.array(table.column("kind").to_numpy() == TEXTS)).to_pylist()[0]

    def joined(of, kind):
        return np.concatenate([C.unpack_values(r["counts"], kind) for r in rows if r["kind"] == of] or [np.empty(0, kind)])

    bodies = [t + END for t in C.unpack_bytes(texts["words"]).split(END)[:-1]]
    tokens, types, ends = totals
    words = _words_in_blocks({w for t in bodies for w in t.split()}, blocks)[0]
    count = dict(zip(words, joined(WORDS, "<u8").tolist(), strict=True))
    all_ = float(tokens + types + 1)
    base, known = np.empty(len(bodies)), np.empty(len(bodies), np.int64)
    for i, t in enumerate(bodies):
        c = np.fromiter(chain(map(count.__getitem__, t.split()), [ends]), float)
        base[i], known[i] = np.log10((c + 1) / all_).sum(), np.count_nonzero(c)
    pieces, keys = _sorted_pieces(bodies)
    p = np.empty(len(keys), np.float32)
    p[_in_blocks(keys, blocks, hot)[0]] = joined(GRAMS, "<f4")
    score = np.zeros(len(bodies))
    for some, new, first, owner in pieces:
        place = np.cumsum(np.unpackbits(new, count=len(owner)), dtype=np.int32) - 1
        sums = np.bincount(owner, p[np.searchsorted(keys, some)].astype(float)[place])
        score[first:first + len(sums)] += sums
    return pa.table({
        "id": pa.array(texts["ids"], pa.int64()), "held_out": pa.array(texts["held"], pa.bool_()),
        "n_tokens": pa.array(np.array(texts["sizes"], np.int64) + 1), "n_known": pa.array(known),
        "train_tokens": pa.array(np.full(len(bodies), tokens), pa.int64()), "base_score": pa.array(base), "score": pa.array(score)})


def score_texts(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigram), score (PPM); both log10.

    Training rows are those that :func:`is_held_out` leaves.  Null and empty
    texts are their end token; a null id is a training row.  Without training
    rows the model holds all symbols alike.  Other columns are not read.
    """
    src = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    size = src.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(BLOCKS, -(-size // BLOCK_BYTES))
    spark = df.sparkSession
    hot = _hot_contexts(src, min(1.0, LOOK_BYTES / max(1, size)))
    rows = materialize(src.mapInArrow(lambda it: _gather(it, blocks, hot), ROWS), "words")
    asked = rows.where(F.col("kind") != TEXTS).select("block", "gid", "kind", "words", "counts")
    stats = asked.groupBy("kind", "block").applyInArrow(lambda t: _block_stats(t, hot), STATS).groupBy("kind", "key").agg(F.sum("n").alias("n"))
    stats = stats.toArrow()  # at most 256^3 arcs, 256 a hot context, and the states
    kinds, key, n = (stats.column(c).to_numpy() for c in ("kind", "key", "n"))

    def of(kind):
        k, v = key[kinds == kind], n[kinds == kind]
        order = np.argsort(k.view(np.uint64))
        return k[order], v[order]

    escapes = [np.zeros(C.STATES, np.int64) for _ in range(2)]
    for x, kind in zip(escapes, (NEW, OLD), strict=True):
        at, v = of(kind)
        x[at] = v
    part = {k: (of(ARC + k)[0].view(np.uint64), of(ARC + k)[1]) for k in range(C.SHARED, C.ORDER)}
    ends = rows.where(F.col("kind") == TEXTS).select(F.explode("held").alias("h")).where("NOT h").count()
    totals = (int(of(TOKENS)[1].sum()) + ends, int(of(TYPES)[1].sum()) + (ends > 0), ends)
    model = spark.sparkContext.broadcast(C.Model(part, *escapes))
    scored = asked.groupBy("kind", "block").applyInArrow(lambda t: _score_rows(t, model.value, hot), ROWS)
    scored = scored.unionByName(rows.where(F.col("kind") == TEXTS))  # the texts skip the blocks
    return scored.groupBy("gid").applyInArrow(lambda t: _score_texts(t, totals, blocks, hot), SCORED)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
