"""Ranked lexical search without random access (NRA).

Documents are scored for a query by the sum over its terms of an integer
weight (rarer terms weigh more) times an integer impact (how much of a document
of its length a term makes).  Postings of a term are read sequentially, highest
impact first, all lists in step.  A document read in some lists has a lower
bound (what was read) and an upper bound (that and, for each list it was not
yet met in, the list's next impact).  A document whose upper bound is below the
k-th best lower bound is out; as soon as the next impacts of all lists together
are below it, documents not met yet are out as well, and entries of documents
that are out are skipped from then on.  Reading ends when every document that
is left has equal bounds: members, ties and scores are final.

1. *Queries* are different texts, in blocks of about ``QUERY_BYTES``; a block's
   terms are a dictionary that tasks hold.
2. *Postings* (one pass over the texts): per document its number of terms and
   the counts of the block's terms, written to the shared folder.  Number of
   documents, of terms, and document frequencies are sums over that table.
3. *Search*.  A task cuts its documents into indexes of at most ``SHARD_DOCS``
   documents and ``SHARD_POSTINGS`` postings, answers each query from each index,
   with the k-th best score of the earlier ones as a bound to start from, and
   sends at most k documents a query.  A ranking merges the tasks' answers.

Nothing grows with a term's frequency but the lists of an index, which its
bounds limit; no list is in one task as a whole.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import look_up, materialize, read_table, text_of

#: Bytes of query texts in a block, in the mean.
QUERY_BYTES = 4 << 20
#: Documents and postings of one index.
SHARD_DOCS, SHARD_POSTINGS = 1 << 14, 1 << 21
#: Queries whose answers go into one batch.
ANSWERS = 200
#: Entries that are read from each list first; each later step reads twice as many.
FIRST_READ = 128
#: Letters and digits stay (A-Z lower-cased), as do bytes of other alphabets; the rest of ASCII separates terms.
_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Queries:
    """A block of queries: numbers of all its terms, and the terms of each query (every term once)."""
    number: dict[bytes, int]
    ids: list[int]
    wanted: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Queries:
        number: dict[bytes, int] = {}
        wanted = [np.array([number.setdefault(t, len(number)) for t in sorted(set(terms(text)))], np.int64) for _, text in rows]
        return cls(number, [i for i, _ in rows], wanted)


class Shard:
    """Impact-sorted lists of a bounded number of documents: ``doc`` and ``impact`` from start[t] to start[t + 1]."""

    def __init__(self, n_terms: int, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, m: np.ndarray):
        tf = tf.astype(np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, self.docs = doc[order], impact[order], len(m)
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))


def nra(shard: Shard, wanted: np.ndarray, weights: np.ndarray, k: int, known: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents and exact scores of all that can be among the k best: ties with
    the k-th are included, scores below ``known`` (a k-th best elsewhere) are not."""
    wanted = wanted[(weights[wanted] > 0) & (shard.start[wanted + 1] > shard.start[wanted])]
    w = weights[wanted]
    at, end = shard.start[wanted], shard.start[wanted + 1]
    lower = np.zeros(shard.docs, np.int64)
    met = np.zeros((shard.docs, len(wanted)), bool)
    out = np.zeros(shard.docs, bool)  # documents that can't be among the best
    closed, read, least = False, FIRST_READ, known
    while True:
        size = np.minimum(read, end - at)
        here = np.repeat(at - np.cumsum(size) + size, size) + np.arange(size.sum())
        which = np.repeat(np.arange(len(wanted)), size)
        doc = shard.doc[here]
        keep = ~out[doc]
        if closed:
            keep &= lower[doc] > 0
        doc, here, which = doc[keep], here[keep], which[keep]
        lower += np.bincount(doc, w[which] * shard.impact[here], shard.docs).astype(np.int64)  # sums far below 2^53
        met[doc, which] = True
        at, read = at + size, 2 * read
        more = at < end
        bound = np.where(more, w * shard.impact[np.minimum(at, len(shard.impact) - 1)], 0) if len(at) else np.zeros(0, np.int64)
        rest = int(bound.sum())  # of a document that no list has shown
        left = np.flatnonzero((lower > 0) & ~out)
        if len(left) >= k:
            least = max(least, int(np.partition(lower[left], len(left) - k)[len(left) - k]))
        far = lower[left] + rest < least
        out[left[far]] = True
        left = left[~far]
        upper = lower[left] + ((~met[left]) @ bound.astype(float)).astype(np.int64)
        out[left[upper < least]] = True
        resolved = bool((upper == lower[left])[upper >= least].all())
        left = left[upper >= least]
        closed = closed or rest < least
        if not rest or closed and resolved:
            return left, lower[left]


def _first(score: np.ndarray, ids: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: highest score, then smallest id, null ids last."""
    return np.lexsort((ids, null, -score))[:k]


def postings(docs: DataFrame, queries, text: str, doc_id: str) -> DataFrame:
    """doc_id, n and the block's terms with their counts, for every document with a term."""
    def rows(batches):
        number = queries.value.number
        for b in batches:
            ids, ns, found, counts = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = terms(t)
                if not words:
                    continue
                hits = [(number[x], c) for x, c in Counter(words).items() if x in number]
                ids.append(i)
                ns.append(len(words))
                found.append(np.array([h for h, _ in hits], np.int32).tobytes())
                counts.append(np.array([c for _, c in hits], np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(found, pa.binary()),
                                              pa.array(counts, pa.binary())], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("t")).mapInArrow(
        rows, "doc_id long, n long, terms binary, counts binary")


def frequencies(table: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Number of documents, number of terms in them, and in how many documents each of the block's terms is."""
    def count(batches):
        df = np.zeros(n_terms, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                df[np.frombuffer(x, np.int32)] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["term", "n"])

    sums = table.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(n_terms, np.int64)
    for r in table.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]  # terms of one block of queries
    return sums["docs"], sums["terms"] or 0, df


def search(table: DataFrame, queries, n_docs: int, n_terms: int, weights: np.ndarray, k: int) -> DataFrame:
    """query, doc_id, score: the best k of each task, by NRA over indexes of bounded size."""
    def rows(batches):
        block: Queries = queries.value
        best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in block.ids]
        held: list[tuple] = []
        size = 0

        def answer():
            m = np.array([50 + 50 * n * n_docs // n_terms for _, n, _, _ in held], np.int64)
            ids = np.array([i or 0 for i, _, _, _ in held], np.int64)
            null = np.array([i is None for i, _, _, _ in held], bool)
            found = [np.frombuffer(x, np.int32) for _, _, x, _ in held]
            doc = np.repeat(np.arange(len(held)), [len(x) for x in found])
            shard = Shard(len(block.number), np.concatenate(found), doc, np.concatenate([np.frombuffer(x, np.int32) for *_, x in held]), m)
            if not len(shard.doc):
                return
            for q, wanted in enumerate(block.wanted):
                score, i, none = best[q]
                at, more = nra(shard, wanted, weights, k, int(score[k - 1]) if len(score) >= k else 0)
                score, i, none = np.concatenate([score, more]), np.concatenate([i, ids[at]]), np.concatenate([none, null[at]])
                first = _first(score, i, none, k)
                best[q] = score[first], i[first], none[first]

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(row)
                size += len(row[2]) // 4
                if len(held) >= SHARD_DOCS or size >= SHARD_POSTINGS:
                    answer()
                    held, size = [], 0
        if held:
            answer()
        for x in range(0, len(best), ANSWERS):  # few batches, not one a query: each is a buffer in the JVM
            some = best[x:x + ANSWERS]
            score, i, none = (np.concatenate([r[c] for r in some]) for c in range(3))
            q = np.repeat(np.array(block.ids[x:x + ANSWERS], np.int64), [len(r[0]) for r in some])
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i, mask=none), pa.array(score)], ["query", "doc_id", "score"])

    return table.select("doc_id", "n", "terms", "counts").mapInArrow(rows, "query long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", doc_id: str = "doc_id",
                   item_id: str = "item_id", item_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item, with a score above 0.

    Equal scores rank by doc_id (null last; rows that repeat an id are documents
    of their own).  Null texts have no term; documents without a term don't
    count, items without one have no result.  Items that repeat a text share a
    search; rows that repeat an item id are items of their own.  No documents, or
    no items, give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), text_of(item_text).alias("query_text"))
    texts = asked.groupBy("query_text").agg(F.count("*").alias("uses"))
    texts = materialize(texts.withColumn("query", F.monotonically_increasing_id()), "queries")
    total = texts.agg(F.sum("uses").alias("uses"), F.sum(F.octet_length("query_text")).alias("bytes")).first()
    blocks = max(1, -(-(total["bytes"] or 0) // query_bytes))
    ranked = None
    for block in range(blocks):
        some = [(r["query"], r["query_text"]) for r in
                texts.where(F.pmod(F.xxhash64("query_text"), F.lit(blocks)) == block).select("query", "query_text").collect()]
        queries = Queries.of(sorted(some))
        if not queries.number:
            continue
        held = spark.sparkContext.broadcast(queries)
        table = materialize(postings(docs, held, text, doc_id), "postings")
        n_docs, n_terms, df = frequencies(table, len(queries.number))
        weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
        found = search(table, held, n_docs, n_terms, weights, k)
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
        found = materialize(found.withColumn("rank", place).where(F.col("rank") <= k), "ranked")
        ranked = found if ranked is None else ranked.unionByName(found)
    if ranked is None:
        ranked = spark.createDataFrame([], "query long, doc_id long, score long, rank int")
    numbered = look_up(asked, texts.select("query_text", "uses", "query"), "query_text", total["uses"] or 0)
    return numbered.join(ranked, "query").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return rank_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                          read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


_SQL_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_SQL_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
size AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS terms FROM d WHERE len(terms) > 0),
m AS (SELECT rid, doc_id, 50 + (50 * len(d.terms) * docs) // size.terms AS m FROM d, size WHERE len(d.terms) > 0),
q AS (SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM (SELECT row_number() OVER () AS item, item_id, {_SQL_TERMS} AS terms FROM benchmark)),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size),
s AS (SELECT item, any_value(item_id) AS item_id, rid, any_value(doc_id) AS doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY item, rid)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""
