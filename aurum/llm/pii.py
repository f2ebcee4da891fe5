"""Personal data by a skip-chain conditional random field.

Base spans come from fixed patterns.  The nodes of a document's field are its
number runs of ``MIN_DIGITS`` digits or more, dotted quads and words with an
@; labels are the kinds and "other".  A node on a base span is observed.
Unary potentials score a node's shape, chain potentials join nodes that follow
each other closely, and skip potentials join distant nodes that are the same
or similar (words with the same local part before their @, numbers that end in
the same ``MIN_DIGITS`` digits or more), weighed by how similar they are.
Loopy sum-product message passing gives every node its marginals, so a
mention in a form that no pattern has takes the label of its other mentions;
an unobserved node whose marginal of a kind exceeds one half adds a span.

The weights are trained by pseudo-likelihood on a bounded sample of documents,
with the base spans as labels; an unmatched node that is similar to a matched
one has no known label and is left out there.  Weights are a few hundred
numbers; documents are independent rows, read once, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, read_table, sliced, text_of

#: The kinds, in the order of the output.
KINDS = ["email", "ip", "card", "phone"]
LABELS = ["other", *KINDS]
MIN_DIGITS, MAX_DIGITS = 7, 19
#: Characters between nodes that a chain potential joins.
NEAR = 40
SAMPLE, SAMPLE_CHARS = 3000, 30_000
ROUNDS, DAMPING, STOP = 50, 0.5, 1e-4

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match has to begin where its run of digits does, and no shorter run can help it
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"\+?[0-9](?:[\x20().-]{0,2}[0-9])*")
_AT_WORD = re.compile(r"(?<![^\s<>()\[\]\"',;:])[^\s<>()\[\]\"',;:@]*+@[^\s<>()\[\]\"',;:]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _emails(text: str):
    """Leftmost matches of the address pattern, found from their @s."""
    low, at = 0, text.find("@")
    while at >= 0:
        local = text[low:at]
        start = at - (len(local) - len(local.rstrip(_LOCAL)))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        low = m.end() if m else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind."""
    out = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text)
                if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = _digits(m.group())
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), m.end(), "card"))
        if "+" in text:
            out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


class Nodes:
    """The field of one document: spans, features, observed labels and edges."""

    def __init__(self, text: str, base: list[tuple[int, int, str]]):
        found = []
        if _DIGIT.search(text):
            for m in _NUMBER.finditer(text):
                # numbers longer than any kind are several, set apart by blanks
                for n in re.finditer(r"[^\x20]+", m.group()) if len(_digits(m.group())) > MAX_DIGITS else [m]:
                    s, a = n.group(), m.start() + (n.start() if n is not m else 0)
                    if len(_digits(s)) >= MIN_DIGITS or s.count(".") == 3:
                        found.append((a, a + len(s), s))
        if "@" in text:
            found += [(m.start(), m.end(), m.group().rstrip(".!?")) for m in _AT_WORD.finditer(text)]
        found.sort()
        self.spans = [(a, a + len(s)) for a, _, s in found]
        self.features = [shape(s) for _, _, s in found]
        self.label = [0] * len(found)
        self.observed = [False] * len(found)
        k = 0
        for i, (a, b) in enumerate(self.spans):
            while k < len(base) and base[k][1] <= a:
                k += 1
            j = k
            while j < len(base) and base[j][0] < b:
                if base[j][1] > a:
                    self.label[i], self.observed[i] = LABELS.index(base[j][2]), True
                    break
                j += 1
        self.chain = [(i, i + 1) for i in range(len(found) - 1) if self.spans[i + 1][0] - self.spans[i][1] <= NEAR]
        self.skip, self.alike = [], []  # edges, and how similar their nodes are (at most 1)
        last: dict[str, int] = {}
        plain = [s.lower() if "@" in s else _digits(s) for _, _, s in found]
        for i, s in enumerate(plain):
            keys = similarity_keys(s)
            j = next((last[k] for k in keys if k in last), None)
            if j is not None:
                self.skip.append((j, i))
                self.alike.append(similarity(plain[j], s))
            last.update(dict.fromkeys(keys, i))


def similarity_keys(s: str) -> list[str]:
    """What a lower-cased @-word, or the digits of a number, shares with similar ones, closest first."""
    if "@" in s:
        head = s[:s.index("@")]
        local = head[len(head.rstrip(_LOCAL)):]
        return [s, local + "@"] if local else [s]
    return [s[-n:] for n in range(min(len(s), MAX_DIGITS), MIN_DIGITS - 1, -1)]


def similarity(a: str, b: str) -> float:
    """Share of the shorter one that both have in common: from the local part on, or at the end of digits."""
    if a == b:
        return 1.0
    if "@" in a:
        a, b = (s[len(h) - len(h[len(h.rstrip(_LOCAL)):]):] for s, h in ((a, a[:a.index("@")]), (b, b[:b.index("@")])))
    else:
        a, b = a[::-1], b[::-1]
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return same / min(len(a), len(b))


def shape(s: str) -> list[int]:
    """Numbers of the features that hold for a node's text."""
    d = _digits(s)
    on = [0, 1 + min(len(d), 20)]
    if "@" in s:
        on.append(22)
        if _DOMAIN.search(s, s.index("@")):
            on.append(23)
    else:
        if s.startswith("+"):
            on.append(24)
        if len(d) >= 12 and luhn(d):
            on.append(25)
        parts = s.split(".")
        if len(parts) == 4:
            on.append(26 if all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts) else 27)
        on += [k for c, k in ((" ", 28), ("-", 29), (".", 30), ("(", 31)) if c in s]
    return on


FEATURES = 32


class Field:
    """Weights and inference."""

    def __init__(self):
        n = len(LABELS)
        self.unary = np.zeros((FEATURES, n))
        self.unary[0, 0] = 2.0  # most candidates are nothing
        self.chain = np.zeros((n, n))
        self.skip = 6.0 * np.eye(n)  # prior: mentions of one thing agree

    def scores(self, features: list[list[int]]) -> np.ndarray:
        return np.array([self.unary[f].sum(axis=0) for f in features]).reshape(-1, len(LABELS))

    def train(self, docs: list[Nodes], steps: int = 200, rate: float = 0.5, ridge: float = 1e-3) -> None:
        """Gradient ascent on the pseudo-likelihood with a ridge around the prior weights."""
        x, y, pairs, alike = [], [], {"chain": [], "skip": []}, {"chain": [], "skip": []}
        for d in docs:
            unknown = set()
            for a, b in d.skip:
                for i, j in ((a, b), (b, a)):
                    if d.label[i] and not d.label[j]:
                        unknown.add(j)
            place = {}
            for i, f in enumerate(d.features):
                if i not in unknown:
                    place[i] = len(y)
                    x.append(f)
                    y.append(d.label[i])
            for name, edges, strength in (("chain", d.chain, [1.0] * len(d.chain)), ("skip", d.skip, d.alike)):
                for (a, b), w in zip(edges, strength, strict=True):
                    if a in place and b in place:
                        pairs[name].append((place[a], place[b]))
                        alike[name].append(w)
        if not y:
            return
        hot = np.zeros((len(y), FEATURES))
        for i, f in enumerate(x):
            hot[i, f] = 1
        y = np.array(y)
        target = np.eye(len(LABELS))[y]
        edges = {k: np.array(v + [(b, a) for a, b in v]).reshape(-1, 2).astype(int) for k, v in pairs.items()}
        alike = {k: np.array(v + v).reshape(-1, 1) for k, v in alike.items()}
        prior = {"unary": self.unary.copy(), "chain": self.chain.copy(), "skip": self.skip.copy()}
        for _ in range(steps):
            z = hot @ self.unary
            for k, e in edges.items():
                np.add.at(z, e[:, 0], alike[k] * getattr(self, k)[y[e[:, 1]]])
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            miss = target - p / p.sum(axis=1, keepdims=True)
            self.unary += rate * (hot.T @ miss / len(y) * 10 - ridge * (self.unary - prior["unary"]))
            for k, e in edges.items():
                g = np.zeros_like(self.chain)
                np.add.at(g, y[e[:, 1]], alike[k] * miss[e[:, 0]])
                w = getattr(self, k)
                w += rate * ((g + g.T) / len(y) * 5 - ridge * (w - prior[k]))

    def marginals(self, d: Nodes) -> np.ndarray:
        """Loopy sum-product over a document's field."""
        unary = self.scores(d.features)
        for i, seen in enumerate(d.observed):
            if seen:
                unary[i] = -30.0
                unary[i, d.label[i]] = 0.0
        pairs = [(a, b, self.chain) for a, b in d.chain] + [(a, b, w * self.skip) for (a, b), w in zip(d.skip, d.alike, strict=True)]
        if not pairs:
            return _softmax(unary)
        src = np.array([[a, b] for a, b, _ in pairs]).ravel()
        dst = np.array([[b, a] for a, b, _ in pairs]).ravel()
        back = np.arange(len(src)) ^ 1
        weights = np.exp(np.repeat(np.array([w for _, _, w in pairs]), 2, axis=0))
        message = np.zeros((len(src), len(LABELS)))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, dst, message)
            out = belief[src] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("ij,ijk->ik", out, weights))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - message).max()
            message = DAMPING * message + (1 - DAMPING) * new
            if change < STOP:
                break
        belief = unary.copy()
        np.add.at(belief, dst, message)
        return _softmax(belief)

    def added(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Spans of unobserved nodes whose marginal of a kind is over one half."""
        d = Nodes(text, base)
        if all(d.observed):
            return []
        p = self.marginals(d)
        taken = sorted((a, b) for a, b, _ in base)
        out = []
        for i, (a, b) in enumerate(d.spans):
            k = int(p[i].argmax())
            if not d.observed[i] and k and p[i, k] > 0.5 and not any(s < b and a < e for s, e in taken):
                out.append((a, b, LABELS[k]))
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def find(text: str, field: Field) -> tuple[list, list]:
    """(base spans, all spans) of a text, each (start, end, kind)."""
    base = base_spans(text)
    more = field.added(text, base)
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Field:
    """Weights from a bounded sample of documents that hold digits or an @."""
    some = docs.select(text_of(text).alias("t"), F.col(doc_id).alias("id")).where(F.length("t") <= SAMPLE_CHARS)
    some = bounded_sample(some.where(F.col("t").rlike("[0-9@]")), ["id", "t"], SAMPLE)
    field = Field()
    field.train([Nodes(r["t"], base_spans(r["t"])) for r in some])
    return field


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def find_pii(df: DataFrame, field: Field, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``spans`` (kind, start, end in code points, whether
    a base pattern has it), by start, then kind.  A null text has none."""
    held = df.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
    fields = [df.schema[c] for c in keep]

    def rows(batches):
        for b in batches:
            out = []
            for t in b.column(len(keep)).to_pylist():
                base, spans = find(t, held.value)
                base = set(base)
                out.append([{"kind": s[2], "start": s[0], "end": s[1], "base": s in base} for s in spans])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, kind)], [*keep, "spans"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"spans {SPANS}"])
    return df.select(*keep, text_of(text).alias("__text")).mapInArrow(rows, schema)


def mask_pii(df: DataFrame, field: Field, text: str = "text", length: str | None = None) -> DataFrame:
    """``df`` with every span replaced by its kind in angle brackets (a null text
    stays null); ``length`` names a column that holds the text's code points."""
    held = df.sparkSession.sparkContext.broadcast(field)
    at = df.columns.index(text)

    def masked(t):
        if t is None:
            return None
        out, end = [], 0
        for a, b, kind in find(t, held.value)[1]:
            if b <= end:
                continue
            if a >= end:
                out += [t[end:a], f"<{kind.upper()}>"]
            end = b  # what overlaps a masked span goes with it
        return "".join([*out, t[end:]])

    def rows(batches):
        for b in sliced(batches):
            done = pa.array([masked(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([done if i == at else c for i, c in enumerate(b.columns)], b.schema.names)

    out = df.mapInArrow(rows, df.schema)
    return out if length is None else out.withColumn(length, F.length(text).cast(df.schema[length].dataType))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are of base spans; ``spans`` holds the added ones too."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, fit(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
