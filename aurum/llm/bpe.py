"""BPE encoding and decoding by a tokenization automaton.

``Automaton`` compiles the merge list of a vocabulary file into a
deterministic automaton whose arcs are labelled with tokens.  It starts with
one state that has a loop for every byte.  The gadget of merge (u, v) takes
the state q that u-arcs lead to: if q has a v-arc, then u-arcs are redirected
to a copy of q that lacks it, and every state with a u-arc gets an arc
labelled uv that leads where v-arcs led.  After the last gadget a sequence of
tokens is a path exactly when BPE would produce it, so a byte string has one
path, which is its encoding.

Copies are not written out: a state is kept as (label, time), the arc that a
gadget removed as ``cut[u, v] = time``, and whether an arc leaves a state is
read from those tables along the components of both labels (``leaves``) and
kept in a transition table.  A pre-split word is encoded by a walk over the
arcs that spell it, long arcs first, back where no arc goes on; each prefix has
one path, so a position needs one state only and is walked from once.  Decoding
emits the arcs' labels.

Tasks build the automaton once per Python worker from the file at
``vocab_path`` (present on every machine).  Rows are independent: there is no
shuffle, and whole texts are encoded.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .presplit import BYTE_CHAR, Memo, default_path, vocabulary

#: Entries of the transition table kept between words (recomputed beyond it).
TRANSITIONS = 2_000_000


class Automaton:
    def __init__(self, path: str):
        voc = self.voc = vocabulary(path)
        char_byte = {ord(c): b for b, c in BYTE_CHAR.items()}
        self.label: dict[int, bytes] = {}
        for t, i in voc.ids.items():
            self.label[i] = t.translate(char_byte).encode("latin-1")
        special = {i: c.encode() for c, i in voc.added.items()}
        self.parts: dict[int, tuple[int, int]] = {}  # of a merged token: what its gadget joined
        self.made: dict[int, int] = {}  # when
        self.cut: dict[tuple[int, int], int] = {}  # the v-arc removed behind u, and when
        self._leaves: dict[tuple[int, int], bool] = {}
        single = set(BYTE_CHAR.values())
        arcs = {i for t, i in voc.ids.items() if t in single}
        for time, (a, b) in enumerate(voc.merges):
            u, v, w = voc.ids[a], voc.ids[b], voc.ids[a + b]
            if u in arcs and v in arcs and self.leaves(u, v):
                self.cut[u, v] = time
                if w not in arcs:
                    arcs.add(w)
                    self.parts[w], self.made[w] = (u, v), time
        self._leaves.clear()  # answers of half-built states
        self.arc = {self.label[i]: i for i in arcs}
        self.label.update(special)
        self._spelt = {s[:n]: -1 for s in self.arc for n in range(1, len(s))} | self.arc  # -1: longer arcs start so
        size = max(self.label, default=-1) + 1
        self.labels = [self.label.get(i, b"") for i in range(size)]
        self._ids = Memo(self._chunk)

    def leaves(self, a: int, t: int) -> bool:
        """Whether a t-arc leaves the state that a-arcs lead to.

        That state carries the cuts behind a, those made behind a's right
        component before a was merged, and so on; t exists there only if its
        left component did when t was merged, and so on."""
        before = 1 << 60
        while True:
            y, until = t, 1 << 60
            while True:
                time = self.cut.get((a, y))
                if time is not None and time < before and time <= until:
                    return False
                if y not in self.parts:
                    break
                until = self.made[y]
                y = self.parts[y][0]
            if a not in self.parts:
                return True
            before = self.made[a]
            a = self.parts[a][1]

    def _word(self, piece: str) -> tuple[int, ...]:
        w = piece.encode()
        whole = self.arc.get(w)
        if whole is not None:
            return (whole,)
        n, spelt, table = len(w), self._spelt.get, self._leaves
        state = [-1] * (n + 1)  # of the positions that were reached
        walk = []  # positions behind the current one
        i = 0
        while True:
            for j in range(i + 1, n + 1):  # the longest arc that spells what follows
                x = spelt(w[i:j])
                if x is None:
                    break
                if x >= 0:
                    t, end = x, j
            while True:
                if state[end] < 0:  # else there is no way on from there
                    if not i:
                        break
                    at = state[i]
                    ok = table.get((at, t))
                    if ok is None:
                        ok = self.leaves(at, t)
                        if len(table) < TRANSITIONS:
                            table[at, t] = ok
                    if ok:
                        break
                end -= 1  # the next shorter arc, else back
                while True:
                    if end == i:
                        i = walk.pop()
                    elif (t := spelt(w[i:end])) >= 0:
                        break
                    end -= 1
            state[end] = t
            walk.append(i)
            i = end
            if i == n:
                return (*map(state.__getitem__, walk[1:]), t)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        parts = self.voc.pretokens(chunk)
        if len(parts) == 1:
            return self._word(chunk)
        return tuple(i for p in parts for i in self._ids[p])

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        known = self._ids.__getitem__
        for s, added in self.voc.segments(text):
            if added is not None:
                ids.append(added)
            else:
                ids += chain.from_iterable(map(known, self.voc.chunks(s)))
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(path)


def encode(df: DataFrame, text: str = "text", vocab_path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``ids array<int>``, one row per row (null text: empty)."""
    path = vocab_path or default_path()
    fields = [df.schema[c] for c in keep]

    def rows(batches):
        a = automaton(path)
        for b in batches:
            ids = pa.array([a.encode(t or "") for t in b.column(len(fields)).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], ids], [*keep, "ids"])

    return df.select(*keep, text).mapInArrow(rows, _schema(fields, "ids", "array<int>"))


def decode(df: DataFrame, ids: str = "ids", vocab_path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``text``, from token ids (null ids: empty)."""
    path = vocab_path or default_path()
    fields = [df.schema[c] for c in keep]

    def rows(batches):
        a = automaton(path)
        for b in batches:
            texts = pa.array([a.decode(x or []) for x in b.column(len(fields)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], texts], [*keep, "text"])

    return df.select(*keep, ids).mapInArrow(rows, _schema(fields, "text", "string"))


def _schema(fields, name: str, kind: str):
    from pyspark.sql import types as T
    return T.StructType([*fields, T.StructField(name, T._parse_datatype_string(kind))])


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text, one digest row per document."""
    path = default_path()

    def rows(batches):
        a = automaton(path)
        decimal = [b"%d," % i for i in range(len(a.labels))]
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in b.column("text").to_pylist():
                ids = a.encode(t or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b"".join(map(decimal.__getitem__, ids))[:-1]).hexdigest())
                text_sha.append(hashlib.sha256(a.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                                              pa.array(text_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
