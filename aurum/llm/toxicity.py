"""Toxicity by nearest labelled examples.

Terms are lower-cased words and word starts of a few lengths.  A bounded
sample of labelled rows (``EXAMPLES`` per class, in the order of a hash of the
id) gives the examples; all their terms are dimensions, those whose presence
depends on the label (chi-squared) with more weight.  Inverse document
frequencies are counted over all documents.  The examples' TF-IDF vectors go into an inverted
index.  Terms of many examples have weights cut into tiles, one per block of
examples, with the largest weight of each (term, block); the others have short
lists, which are read whole.  The bound of a block is what its largest weights and
the lists give at most: a query reads its best blocks first, then those whose
bound reaches its k-th best cosine, and no other, so its neighbours are exact.
Queries of a batch share the reading of a tile.

The neighbours vote with their cosines; each class counts by its share of the
sample.  Votes become probabilities by isotonic regression on the examples
themselves, each scored without itself and weighted back to the share its
class has among all labelled rows.  The evidence of a score is its neighbours.

The index is broadcast: the postings of at most 2 EXAMPLES texts.  Every
document's whole text is scored where it is read; nothing else is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_bucket, give_back, materialize, read_table, sliced, text_of
from .presplit import Memo, forget

#: Bounds of the fit: rows per class, characters of a row that may be an example.
EXAMPLES, EXAMPLE_CHARS = 2000, 30_000
#: Chi-squared at which a term has half of the full weight.
HALF_CHI2 = 25.0
#: Terms in at least this share of the examples have a whole row of weights.
HEAVY = 1 / 16
NEIGHBOURS = 25
BLOCK = 64
#: Texts that are searched together.
BATCH = 64
#: Blocks that are visited first, and cosines that count as equal.
STRIDE, TIE = 8, 1e-5
STARTS = (4, 5, 6)
THRESHOLD = 0.3
#: Bytes that are not part of words (ASCII except letters) as blanks, A-Z as a-z.
_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def word_terms(word: bytes) -> tuple:
    """The word itself and its starts (a start is marked by a leading ^)."""
    if len(word) > 64:
        return (word,)
    w = word.decode("utf-8", "replace")
    return (word, *((b"^" + w[:n].encode()) for n in STARTS if len(w) > n))


class Counted:
    """Word counts of texts as arrays of numbers of words, which take a fraction of
    the counters' memory; given as dicts, one at a time."""

    def __init__(self, texts: Iterable[str]):
        number: dict[bytes, int] = {}
        self.rows = []
        for t in texts:
            c = Counter(words(t))
            self.rows.append((np.fromiter((number.setdefault(w, len(number)) for w in c), np.int32, len(c)),
                              np.fromiter(c.values(), np.int32, len(c))))
        self.words = list(number)

    def __len__(self) -> int:
        return len(self.rows)

    def __iter__(self) -> Iterator[dict[bytes, int]]:
        for at, n in self.rows:
            yield dict(zip(map(self.words.__getitem__, at.tolist()), n.tolist(), strict=True))


def choose_terms(docs: list[Counter], toxic: np.ndarray) -> list[bytes]:
    """All terms of the examples, those whose presence depends on the label first.  docs: counts of words."""
    return weighed_terms(docs, toxic)[0]


def weighed_terms(docs: Iterable[dict], toxic: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The terms and the chi-squared of each."""
    number, a, b = term_counts(docs, toxic)
    chi2 = chi_squared(a, b, toxic)
    order = np.argsort(-chi2, kind="stable")
    terms = list(number)
    return [terms[i] for i in order.tolist()], chi2[order]


def term_counts(docs: Iterable[dict], toxic: np.ndarray) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Numbers of the examples' terms, and in how many toxic and other examples each is."""
    number: dict[bytes, int] = {}
    numbers = Memo(lambda w: tuple(number.setdefault(t, len(number)) for t in word_terms(w)), 150_000)
    seen = [np.fromiter(s := set().union(*map(numbers.__getitem__, d)), np.int32, len(s)) for d in docs]

    def count(y):
        some = [x for x, z in zip(seen, toxic.tolist(), strict=True) if z == y]
        return np.bincount(np.concatenate(some or [np.empty(0, np.int32)]), minlength=len(number))

    return number, count(1), count(0)


def chi_squared(a: np.ndarray, b: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Of terms in ``a`` toxic and ``b`` other examples."""
    n, n1 = float(len(toxic)), float(toxic.sum())
    n0, c = n - n1, (a + b).astype(float)
    if not 0 < n1 < n:
        return np.zeros(len(a))
    return np.where((c > 0) & (c < n), n * (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum(1, n1 * n0 * c * (n - c)), 0.0)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions from each start on, one range behind another."""
    end = np.cumsum(size)
    out = np.repeat(start - end + size, size)
    out += np.arange(len(out))
    return out


class Postings:
    """Weights by term and example.  Terms of many examples have a whole row, cut into a
    tile per block of ``BLOCK`` examples, with the largest weight of each (term,
    block); the others have lists."""

    def __init__(self, terms: int, term: np.ndarray, at: np.ndarray, w: np.ndarray, width: int):
        order = np.lexsort((at, term))
        term, self.at, self.w, self.width = term[order], at[order].astype(np.int32, copy=False), w[order].astype(np.float32, copy=False), width
        del order
        self.start = np.searchsorted(term, np.arange(terms + 1))
        self.blocks = width // BLOCK
        heavy = np.flatnonzero(np.diff(self.start) >= max(1, HEAVY * width))
        self.row = np.full(terms, -1, np.int32)
        self.row[heavy] = np.arange(len(heavy))
        self._cut(term)

    def _cut(self, term: np.ndarray) -> None:
        """Tiles and bounds of the frequent terms (``term``: of each list entry)."""
        self.tiles = np.zeros((self.blocks, int(self.row.max(initial=-1)) + 1, BLOCK), np.float32)
        some = self.row[term] >= 0
        x = self.at[some]
        self.tiles[x // BLOCK, self.row[term[some]], x % BLOCK] = self.w[some]
        self.most = np.ascontiguousarray(self.tiles.max(axis=2).T)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("tiles", "most")}  # made again from the lists

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.at = self.at.astype(np.intp)  # what bincount takes without a copy
        self._cut(np.repeat(np.arange(len(self.row)), np.diff(self.start)))

    def listed(self, q: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Dot products with all examples over terms that have lists."""
        start = self.start[q]
        size = self.start[q + 1] - start
        post = _ranges(start, size)
        return np.bincount(self.at[post], self.w[post] * np.repeat(w, size), self.width)

    def __getitem__(self, q: np.ndarray) -> np.ndarray:
        """Whole rows of any terms."""
        out = np.zeros((len(q), self.width), np.float32)
        for k, t in enumerate(np.asarray(q).tolist()):
            x, y = self.start[t], self.start[t + 1]
            out[k, self.at[x:y]] = self.w[x:y]
        return out


def coherent_order(rows: np.ndarray) -> np.ndarray:
    """Examples in an order in which neighbours are alike, which makes block bounds
    tight: halves along the first principal component, again and again."""
    out, stack = [], [np.arange(len(rows))]
    while stack:
        own = stack.pop()
        if len(own) <= BLOCK:
            out.append(own)
            continue
        x = rows[own] - rows[own].mean(axis=0)
        v = np.random.default_rng(1).standard_normal(x.shape[1]).astype(np.float32)
        for _ in range(12):
            v = x.T @ (x @ v)
            v /= max(float(np.linalg.norm(v)), 1e-9)
        own = own[np.argsort(x @ v, kind="stable")]
        half = -(-len(own) // (2 * BLOCK)) * BLOCK
        stack += [own[half:], own[:half]]
    return np.concatenate(out) if out else np.empty(0, int)


class Index:
    """Block-max inverted index over the examples.

    Term 0 stands for all words that no example has, so that norms are over the
    whole text."""

    def __init__(self, terms: list[bytes], df: np.ndarray, n_docs: int, docs: Iterable[Counter], toxic: np.ndarray, ids: list,
                 class_rows: tuple[int, int], chi2: np.ndarray | None = None):
        self.number = {t: i + 1 for i, t in enumerate(terms)}
        self.look = None
        self.idf = 1 + np.log((n_docs + 1) / (np.append(n_docs, df) + 1))
        if chi2 is None:
            number, a, b = term_counts(docs, toxic)
            every = chi_squared(a, b, toxic)
            chi2 = np.array([every[number[t]] if t in number else 0.0 for t in terms])
        # a weight that no term loses wholly: one expects a chi-squared of 1 by chance
        self.idf[1:] *= (chi2 + 1) / (chi2 + HALF_CHI2)
        look = lookup(self.number)
        vectors = [(q.astype(np.int32), w.astype(np.float32)) for q, w in (self.vector(d, look) for d in docs)]
        del look
        give_back()
        term = np.concatenate([q for q, _ in vectors] or [np.empty(0, np.int32)])
        at = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(q) for q, _ in vectors])
        w = np.concatenate([x for _, x in vectors] or [np.empty(0, np.float32)])
        often = np.flatnonzero(np.bincount(term, minlength=len(terms) + 1) >= 2 * HEAVY * len(vectors))
        row = np.full(len(terms) + 1, -1, np.int32)
        row[often] = np.arange(len(often))
        rows = np.zeros((len(vectors), len(often)), np.float32)
        some = row[term] >= 0
        rows[at[some], row[term[some]]] = w[some]
        order = coherent_order(rows)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        del rows, some
        self.ids, self.toxic = [ids[i] for i in order], toxic[order].astype(int)
        at = place[at] if len(at) else at
        self.impact = Postings(len(terms) + 1, term, at, w, -(-len(order) // BLOCK) * BLOCK)
        del term, at, w
        give_back()
        share = [max(1, int((self.toxic == y).sum())) for y in (0, 1)]
        self.weight = np.array([class_rows[y] / share[y] for y in (0, 1)])  # rows of the class per example of it
        self.plain = None
        self.steps = self._calibrate([vectors[i] for i in order])
        self.plain = self.search(np.zeros(1, int), np.ones(1))  # of a text without any term

    def vector(self, word_counts, look) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and weights (unit length) of a text's terms."""
        word_counts = word_counts if isinstance(word_counts, dict) else dict(word_counts)
        got = list(map(look.__getitem__, word_counts))
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        n = np.fromiter(word_counts.values(), float, len(got))
        q, place = np.unique(np.fromiter(chain.from_iterable(got), np.int64, int(sizes.sum())), return_inverse=True)
        hits, other = np.bincount(place, np.repeat(n, sizes), len(q)), n[sizes == 0].sum()
        if other or not len(q):
            q, hits = np.append(q, 0), np.append(hits, max(1, other))
        w = (1 + np.log(hits)) * self.idf[q]
        return q, w / np.sqrt((w * w).sum())

    def search(self, q: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int = -1):
        """Positions and cosines of the k nearest examples and of all as near as the k-th."""
        return self.search_all([(q, w)], k, [without])[0]

    def search_all(self, vectors, k: int = NEIGHBOURS, without=None) -> list[tuple[np.ndarray, np.ndarray]]:
        """:meth:`search` for several texts, which share the reading of a tile.

        The bound of a block is what its listed terms give at most and the largest
        weights of the others.  A text's ``STRIDE`` best blocks are read first, then
        those whose bound reaches its k-th best cosine; other tiles are not read
        for it."""
        p, n = self.impact, len(vectors)
        weight, score = np.zeros((n, p.tiles.shape[1]), np.float32), np.zeros((n, p.width), np.float32)
        for i, (q, w) in enumerate(vectors):
            row = p.row[q]
            some = row >= 0
            weight[i, row[some]] = w[some]
            score[i] = p.listed(q[~some], w[~some])
        by_block = score.reshape(n, p.blocks, BLOCK)
        bounds = weight @ p.most + by_block.max(axis=2)
        done, least = np.zeros((n, p.blocks), bool), np.zeros(n, np.float32)
        for last in (False, True):
            wanted = (bounds > 0) & (bounds >= least[:, None] - TIE) & ~done
            if not last and STRIDE < p.blocks:
                wanted &= bounds >= np.partition(bounds, p.blocks - STRIDE, axis=1)[:, p.blocks - STRIDE, None]
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                t = np.flatnonzero(wanted[:, b])
                if len(t) == n:
                    by_block[:, b] += weight @ p.tiles[b]
                else:
                    by_block[t, b] += weight[t] @ p.tiles[b]
            done |= wanted
            if not last:
                known = np.where(done[:, :, None], by_block, 0).reshape(n, -1)
                for i, x in enumerate(without or ()):
                    if x >= 0:
                        known[i, x] = 0
                if k <= p.width:
                    least = np.partition(known, p.width - k, axis=1)[:, p.width - k]
        out = []
        score = np.where(done[:, :, None], by_block, 0).reshape(n, -1)
        for i in range(n):
            if self.plain is not None and len(vectors[i][0]) == 1 and not vectors[i][0][0]:
                out.append(self.plain)
                continue
            if without and without[i] >= 0:
                score[i, without[i]] = 0
            at = np.flatnonzero((score[i] > 0) & (score[i] >= least[i] - TIE))  # no other is among the k best
            near = score[i, at]
            kth = np.partition(near, len(at) - k)[len(at) - k] if k <= len(at) else 0.0
            at = at[near >= kth - TIE]
            at = at[np.lexsort((at, -score[i, at]))]
            out.append((at, score[i, at]))
        return out

    def __getstate__(self):
        return self.__dict__ | {"look": None, "number": b" ".join(self.number)}  # one string is sent with less memory than a dict

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.number = {t: i for i, t in enumerate(state["number"].split(), 1)}

    def nearest(self, texts: list[str]):
        """Neighbours of texts, one text after another."""
        if self.look is None:
            self.look = lookup(self.number)  # kept by the worker from task to task
        for i in range(0, len(texts), BATCH):
            yield from self.search_all([self.vector(Counter(words(t)), self.look) for t in texts[i:i + BATCH]])

    def vote(self, at, cos) -> float:
        """Share of the toxic class in the distance-weighted votes, -1 without a neighbour."""
        if not len(at):
            return -1.0
        v = np.bincount(self.toxic[at], cos * self.weight[self.toxic[at]], 2)
        return float(v[1] / v.sum())

    def _calibrate(self, vectors) -> tuple[np.ndarray, np.ndarray]:
        """Isotonic regression of labels on votes: thresholds and probabilities."""
        some = []
        for x in range(0, len(vectors), BATCH):
            found = self.search_all(vectors[x:x + BATCH], without=list(range(x, min(x + BATCH, len(vectors)))))
            some += [self.vote(*f) for f in found]
            give_back()
        votes = np.array(some)
        weight = self.weight[self.toxic]
        groups: list[list[float]] = []  # lowest vote, weight, weighted positives
        prior = float((weight * self.toxic).sum() / weight.sum()) if len(votes) else 0.0
        for i in np.argsort(votes, kind="stable").tolist():
            if groups and votes[i] == groups[-1][0]:
                groups[-1][1] += weight[i]
                groups[-1][2] += weight[i] * self.toxic[i]
            else:
                groups.append([votes[i], weight[i], weight[i] * self.toxic[i]])
            while len(groups) > 1 and groups[-2][2] * groups[-1][1] >= groups[-1][2] * groups[-2][1]:
                _, a, b = groups.pop()
                groups[-1][1] += a
                groups[-1][2] += b
        if not groups:
            return np.array([-1.0]), np.array([prior])
        return np.array([g[0] for g in groups]), np.array([(g[2] + prior) / (g[1] + 1) for g in groups])

    def probability(self, vote: float) -> float:
        """Calibrated probability: that of the step, and a little of the vote to order its rows."""
        x, p = self.steps
        step = max(0, int(np.searchsorted(x, vote, side="right")) - 1)
        return float((1 - 1e-3) * min(1.0, p[step]) + 1e-3 * max(0.0, vote))


def fit(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, toxic: str) -> Index:
    """Fit on a bounded sample of the labelled rows; frequencies come from all of ``docs``.

    ``labels`` are the rows that may be learned from.  Of several labels of one
    id the larger counts; labels other than 0 and 1 are left out."""
    rows = (labels.where(F.col(toxic).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id"))
            .agg(F.max(toxic).cast("int").alias("y")))
    rows = materialize(rows, "labels")
    share = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    # take twice the examples, since some ids have no document or a very long one
    picked = None
    for y in (0, 1):
        # a hash bound that about 4 EXAMPLES rows meet, so that few rows are sorted in one task
        under = int(min(1.0, 4 * EXAMPLES / max(1, share.get(y, 0))) * (1 << 40))
        some = rows.where((F.col("y") == y) & (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < under))
        some = some.orderBy(F.xxhash64("id"), "id").limit(2 * EXAMPLES)
        picked = some if picked is None else picked.unionByName(some)
    picked = F.broadcast(materialize(picked, "picked"))  # at most 4 EXAMPLES ids
    found = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("t")).where(F.length("t") <= EXAMPLE_CHARS).join(picked, "id")
    found = materialize(found.dropDuplicates(["id"]), "examples")
    taken = []
    for y in (0, 1):
        taken += found.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(EXAMPLES).collect()
    y, ids = np.array([r["y"] for r in taken], int), [r["id"] for r in taken]
    taken.reverse()
    counted = Counted(taken.pop()["t"] for _ in range(len(taken)))  # a text goes when it is counted
    give_back()
    terms, chi2 = weighed_terms(counted, y) if 0 < y.sum() < len(y) else ([], np.empty(0))
    df, n = document_frequencies(docs, text, terms)
    return Index(terms, df, n, counted, y, ids, (share.get(0, 0), share.get(1, 0)), chi2)


def lookup(number: dict[bytes, int]) -> Memo:
    """Numbers of a word's terms (:func:`word_terms`; bytes are letters in an ASCII word)."""
    get, at = number.get, [(n, n + 1) for n in STARTS]

    def numbers(w: bytes) -> tuple:
        if not w.isascii() or len(w) > 64:
            return tuple(number[t] for t in word_terms(w) if t in number)
        i, size, head = get(w), len(w), b"^" + w
        found = () if i is None else (i,)
        for n, end in at:
            if size > n:
                i = get(head[:end])
                if i is not None:
                    found += (i,)
        return found

    return Memo(numbers, 250_000)


def document_frequencies(docs: DataFrame, text: str, terms: list[bytes]) -> tuple[np.ndarray, int]:
    """In how many of all documents each term is, and their number."""
    joined = b" ".join(terms)  # terms have no blanks; one string is sent with less memory than a dict

    def count(batches):
        forget()
        number = {t: i for i, t in enumerate(joined.split())}
        look, df, n = lookup(number), np.zeros(len(number) + 1, np.int64), 0
        for b in sliced(batches):
            for t in b.column(0).to_pylist():
                n += 1
                hit = np.fromiter(chain.from_iterable(map(look.__getitem__, set(words(t)))), np.int64)
                df[hit] += 1  # a term of several words counts once
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], ["term", "n"])

    out = np.zeros(len(terms) + 1)
    rows = docs.select(text_of(text).alias("t")).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # of the examples' terms, as arrays: a row object each would take ten times as much
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return out[:-1], int(out[-1])


def score(docs: DataFrame, index: Index, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, score, evidence (nearest examples: doc_id, toxic, cosine) for every row."""
    kind = docs.schema[doc_id].dataType
    held = docs.sparkSession.sparkContext.broadcast(index)
    near = pa.struct([("doc_id", pa.string()), ("toxic", pa.int32()), ("cosine", pa.float64())])

    def rows(batches):
        ix = held.value
        for b in batches:
            scores, evidence = [], []
            for at, cos in ix.nearest(b.column(1).to_pylist()):
                scores.append(ix.probability(ix.vote(at, cos)))
                evidence.append([{"doc_id": str(ix.ids[i]), "toxic": int(ix.toxic[i]), "cosine": float(c)}
                                 for i, c in zip(at[:3].tolist(), cos[:3].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(near))],
                                             ["doc_id", "score", "evidence"])

    return docs.select(doc_id, text_of(text).alias("t")).mapInArrow(
        rows, f"doc_id {kind.simpleString()}, score double, evidence array<struct<doc_id:string,toxic:int,cosine:double>>")


def drop_toxic(docs: DataFrame, index: Index, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score stays under the threshold, with all their columns."""
    held, at = docs.sparkSession.sparkContext.broadcast(index), docs.columns.index(text)

    def rows(batches):
        forget()
        ix = held.value
        for b in sliced(batches, 8 * BATCH):
            stay = [ix.probability(ix.vote(*found)) < threshold for found in ix.nearest([t or "" for t in b.column(at).to_pylist()])]
            yield b.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)


def learnable(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The label rows that may be learned from (the others are held out)."""
    return labels.where(crc_bucket(doc_id, 4) != 2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score all documents.  Null and empty texts have no neighbour: they get
    the share of toxic rows among examples without one.  A null id is not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = learnable(read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = score(docs, fit(docs, labels, "text", "doc_id", "toxic"))
    return out.select("doc_id", F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
