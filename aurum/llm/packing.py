"""Order-preserving packing of token sequences by dynamic programming.

The documents of a partition form one stream of tokens (each document's ids,
then an end id).  Windows of at most ``window`` tokens cover the stream.
Candidate cuts are document ends, sentence ends and, inside long stretches
without either, every ``STEP`` tokens.  Over the candidates p_1 < p_2 < ...

    f(j) = min over p_j - p_i <= window of  f(i) + (window - (p_j - p_i)) + penalty(j)

is the least padding plus truncation penalty.  Since f(i) + p_i is all that a
transition needs of i, the least one within reach is the head of a monotone
queue and every candidate is pushed and popped once.  The last window of a
stream may instead be cut at powers of two, which need no padding.

No shuffle: a partition packs its own documents, in its order.  Memory is
bounded by ``BUFFER`` tokens plus one document: when a buffer is full, the
windows up to the cheapest cut near its end are final and the rest of the
stream moves on.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, sliced
from .presplit import KEPT, Memo, default_path, to_chars, vocabulary

WINDOW = 2048
END = 1
#: Truncation penalties in tokens, by where a window ends.
SENTENCE_CUT, HARD_CUT = 2, 6
#: Spacing of candidates within stretches that have no sentence end.
STEP = 32
BUFFER = 1 << 20


class Encoder:
    """Ids by the tokenizers library as little-endian unsigned 32-bit bytes, remembered per chunk."""

    def __init__(self, path: str):
        self.voc = vocabulary(path)
        self._ids = Memo(self._chunk)
        size = max([*self.voc.ids.values(), *self.voc.added.values(), END]) + 1
        self.ends_sentence = np.zeros(size, bool)
        newline = to_chars("\n")
        for t, i in self.voc.ids.items():
            self.ends_sentence[i] = t.rstrip(newline).endswith((".", "!", "?")) or t.endswith(newline)

    def _chunk(self, chunk: str) -> bytes:
        parts = self.voc.pretokens(chunk)
        if len(parts) > 1:
            return b"".join(map(self._ids.__getitem__, parts))
        tokens = self.voc.library.model.tokenize(to_chars(chunk))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def encode(self, text: str) -> np.ndarray:
        parts = []
        for s, added in self.voc.segments(text):
            parts.append(np.uint32(added).tobytes() if added is not None
                         else b"".join(map(self._ids.__getitem__, self.voc.chunks(s))))
        return np.frombuffer(b"".join(parts), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


KEPT.append(encoder)


def candidates(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cut positions (the last is the stream's end) and their penalties."""
    penalty = np.full(len(ids) + 1, -1, np.int8)
    penalty[1:][ends_sentence[ids]] = SENTENCE_CUT
    penalty[doc_ends] = 0
    penalty[0], penalty[-1] = -1, max(penalty[-1], 0)
    pos = np.flatnonzero(penalty >= 0)
    gaps = np.diff(pos, prepend=0)
    step = min(STEP, window)
    more = np.where(gaps > min(2 * STEP, window), (gaps - 1) // step, 0)
    number = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    penalty[np.repeat(pos - gaps, more) + number * step] = HARD_CUT
    pos = np.flatnonzero(penalty >= 0)
    return pos, penalty[pos]


def tail_cuts(length: int) -> list[int]:
    """Cut lengths of a tail into powers of two, largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def plan(pos, pen, window: int, last: bool) -> list[int]:
    """The ends of the windows that cover the stream, at least total cost."""
    at, pen = [0, *pos.tolist()], [0, *pen.tolist()]
    key, back = [0] * len(at), [0] * len(at)  # key(j) = f(j) + p_j
    queue, head = [0], 0  # candidates in reach, their keys increase
    for j in range(1, len(at)):
        reach = at[j] - window
        while at[queue[head]] < reach:
            head += 1
        back[j] = i = queue[head]
        key[j] = k = key[i] + window + pen[j]
        while len(queue) > head and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    f = [k - p for k, p in zip(key, at, strict=True)]
    ends, j, end = [], len(at) - 1, at[-1]
    if not last:  # the stream goes on: the cheapest way to any cut in reach of its end
        j = min((f[i], -i) for i in range(1, len(at)) if end - at[i] < window)[1] * -1
    else:  # the last window may end in pieces of powers of two
        cost, i = min((f[i] + (bin(end - at[i]).count("1") - 1) * HARD_CUT, -i) for i in range(len(at) - 1)
                      if end - at[i] <= window) if j else (1, 0)
        if j and cost <= f[j]:
            e = at[-i]
            for k in tail_cuts(end - e):
                e += k
                ends.append(e)
            ends.reverse()
            j = -i
    while j:
        ends.append(at[j])
        j = back[j]
    return ends[::-1]


def pack_stream(docs, ends_sentence, window: int = WINDOW, first_sequence: int = 0, buffer: int = BUFFER):
    """Pieces of a stream of (id, ids array): yields lists of
    (doc id, start, ids, doc tokens, sequence, offset), in order."""
    held: list[tuple] = []  # (doc id, start of what is left, ids left, doc tokens)
    size, sequence = 0, first_sequence

    def cut(last: bool):
        nonlocal held, size, sequence
        ids = np.concatenate([h[2] for h in held])
        ends = np.cumsum([len(h[2]) for h in held])
        pos, pen = candidates(ids, ends, ends_sentence, window)
        cuts = plan(pos, pen, window, last)
        done = cuts[-1] if cuts else 0
        seq_ends = np.array(cuts, np.int64)
        borders = np.union1d(seq_ends, ends[ends <= done])
        starts = np.concatenate([[0], borders[:-1]]) if len(borders) else borders
        doc_at = np.searchsorted(ends, starts, side="right")
        seq_at = np.searchsorted(seq_ends, starts, side="right")
        doc_starts, seq_starts = ends - [len(h[2]) for h in held], np.concatenate([[0], seq_ends])
        out = []
        for s, e, d, q in zip(starts.tolist(), borders.tolist(), doc_at.tolist(), seq_at.tolist(), strict=True):
            doc, base, _, total = held[d]
            out.append((doc, base + s - int(doc_starts[d]), ids[s:e], total, sequence + q, s - int(seq_starts[q])))
        sequence += len(cuts)
        rest = []
        for k, h in enumerate(held):
            if ends[k] > done:
                skip = max(0, done - int(doc_starts[k]))
                rest.append((h[0], h[1] + skip, h[2][skip:], h[3]))
        held, size = rest, sum(len(r[2]) for r in rest)
        return out

    for doc, ids in docs:
        held.append((doc, 0, ids, len(ids)))
        size += len(ids)
        if size >= buffer:
            yield cut(False)
    if held:
        yield cut(True)


def pack_documents(df: DataFrame, text: str = "text", doc_id: str = "doc_id", vocab_path: str | None = None,
                   window: int = WINDOW) -> DataFrame:
    """Pieces: doc_id, start, length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.

    Every id of a document (its text's ids, then END) is in one piece; a null
    or empty text is the end id alone.  Rows that repeat an id are packed as
    they come.  An empty table gives no pieces.  Other columns are not read.
    """
    path = vocab_path or default_path()
    kind = df.schema[doc_id].dataType
    schema = f"doc_id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def rows(batches):
        enc = encoder(path)
        end, kinds = np.array([END], "<u4"), []

        def docs():
            for b in sliced(batches):
                kinds[:] = [b.column(0).type]
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    yield d, np.concatenate([enc.encode(t or ""), end])

        # a partition numbers its own sequences: a retried task gives the same numbers
        for out in pack_stream(docs(), enc.ends_sentence, window, TaskContext.get().partitionId() << 40):
            for k in range(0, len(out), 4096):
                doc, start, ids, total, seq, off = zip(*out[k:k + 4096], strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc, kinds[0]), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()),
                    pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return df.select(doc_id, text).mapInArrow(rows, schema)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
