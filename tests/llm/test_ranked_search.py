import math
import re
from collections import Counter

import numpy as np

from aurum.llm.ranked_search import Shard, nra, rank_documents, terms

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in _TERM.findall(text or "")]


def plain(docs, items, k=50):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, size = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, x in held:
            m = 100 - 50 + 50 * x * n // size
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(plain_terms(text)) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return Counter(out)


def ranked(spark, docs, items, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'?' AS terms", "0 AS query", "1 AS uses", "2 AS rank")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS query", "1 AS uses", "'?' AS query_text", "1 AS doc_id")
    return Counter(tuple(r) for r in rank_documents(d, q, **how).collect())


def corpus(seed=0, n=400):
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"w{i}" for i in range(300)] + ["Émile", "ñandú", "X9", "日本"])
    p = 1 / np.arange(1, len(vocabulary) + 1)
    p /= p.sum()
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 60), p=p))) for i in range(n)]
    items = [(i, ", ".join(rng.choice(vocabulary, rng.integers(1, 40), p=p))) for i in range(20)]
    return docs, items


def test_terms():
    for text in ["", "A-b_C9é", "x\x7fy\x00z", "日本、x", "\u00a0É É", "a\nB\tc"]:
        assert [t.decode() for t in terms(text)] == plain_terms(text)


def test_against_brute_force_with_odd_rows(spark):
    docs, items = corpus()
    docs += [(5000, None), (5001, ""), (5002, "--- !!"), (None, docs[3][1]), (None, docs[3][1]), (7, docs[7][1]), (5003, "w1 " * 200_000 + "w299"), (5004, docs[3][1])]
    docs += [(6000 + i, "w2 w5 zebra") for i in range(80)]  # more ties than places
    items += [(100, None), (101, "..."), (102, "nowhere"), (103, "zebra"), (3, items[3][1]), (104, items[3][1]), (None, "w7 w7 W7"), (105, "w2 zebra w299")]
    got = ranked(spark, docs, items)
    assert got == plain(docs, items) and sum(got.values()) > 800
    assert ranked(spark, docs, items, k=3, query_bytes=400) == plain(docs, items, 3)  # several blocks of queries


def test_empty_tables(spark):
    docs, items = corpus(1, 20)
    assert not ranked(spark, [], items)
    assert not ranked(spark, docs, [])
    assert not ranked(spark, [(1, None)], items)
    assert not ranked(spark, docs, [(1, None)])


def test_a_term_of_all_documents_has_no_weight_but_counts(spark):
    docs = [(i, "the cat") for i in range(2000)] + [(3000, "the dog")]
    items = [(1, "the"), (2, "the dog")]
    assert ranked(spark, docs, items) == plain(docs, items)


def index(seed, docs=3000, n_terms=40):
    rng = np.random.default_rng(seed)
    term, doc = np.nonzero(rng.random((n_terms, docs)) < rng.random((n_terms, 1)) ** 3)
    tf, m = rng.integers(1, 6, len(term)), rng.integers(50, 400, docs)
    return Shard(n_terms, term, doc, tf, m), rng.integers(0, 9000, n_terms)


def exact(shard, wanted, weights):
    score = np.zeros(shard.docs, np.int64)
    for t in wanted:
        x = slice(shard.start[t], shard.start[t + 1])
        score[shard.doc[x]] += weights[t] * shard.impact[x]
    return score


def test_bounds_keep_all_of_the_best_with_exact_scores():
    for seed in range(30):
        shard, weights = index(seed)
        rng = np.random.default_rng(seed)
        wanted, k = rng.choice(40, rng.integers(1, 20), replace=False), int(rng.integers(1, 60))
        want = exact(shard, wanted, weights)
        kth = np.sort(want)[-k]
        at, score = nra(shard, wanted, weights, k)
        assert (score == want[at]).all()
        assert set(np.flatnonzero((want >= kth) & (want > 0))) <= set(at.tolist())
        at, score = nra(shard, wanted, weights, k, known=int(kth))
        assert (score == want[at]).all() and set(np.flatnonzero((want >= kth) & (want > 0))) <= set(at.tolist())


def test_lists_are_not_read_to_their_ends_where_bounds_decide():
    """Documents that a closed search hasn't met are never scored."""
    docs = 50_000
    term = np.repeat([0, 1], docs)
    doc = np.tile(np.arange(docs), 2)
    tf = np.where(doc < 20, 500, 1)
    shard = Shard(2, term, doc, tf, np.full(docs, 100))
    at, _ = nra(shard, np.array([0, 1]), np.array([1000, 900]), 10)
    assert set(at.tolist()) <= set(range(20)) and len(at) >= 10
