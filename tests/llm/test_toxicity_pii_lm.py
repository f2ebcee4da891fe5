import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from aurum.llm import lm_score as L
from aurum.llm import pii as P
from aurum.llm import toxicity as X

SMOKE = "/root/testdata/sf0.001"


# ---- toxicity

def made(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = i % 5 == 0
        w = [rng.choice("ka lo mi ne pu ra si to".split()) + rng.choice("ba de fi go".split()) for _ in range(rng.randint(5, 60))]
        for _ in range(rng.randint(1, 4) if y else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scum,", "MORON"]))
        rows.append((i, " ".join(w), int(y)))
    return rows


def test_search_is_exact():
    rows = made(600)
    docs = [Counter(X.words(t)) for _, t, _ in rows]
    y = np.array([r[2] for r in rows])
    terms = X.choose_terms(docs, y)
    assert {b"idiot", b"scum", b"moron"} <= set(terms)
    ix = X.Index(terms, np.full(len(terms), 20.0), len(rows), docs, y, [r[0] for r in rows], (480, 120))
    look = X.lookup(ix.number)
    for _, t, _ in made(60, seed=3):
        q, w = ix.vector(Counter(X.words(t)).items(), look)
        ix.plain = None
        at, cos = ix.search(q, w)
        whole = w.astype(np.float32) @ ix.impact[q]
        least = np.sort(whole[:len(ix.ids)])[-X.NEIGHBOURS]
        assert set(at.tolist()) == set(np.flatnonzero(whole >= least - X.TIE).tolist())
        assert np.allclose(cos, whole[at], atol=1e-5)


def test_scores_of_held_out_rows(spark, table):
    rows = made(800) + [(900, None, 0), (901, "", 0), (902, "idiot " * 20_000, 1), (902, "again", 0)]
    df = table([(i, t) for i, t, _ in rows])
    labels = X.learnable(spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int"))
    got = X.score(df, X.fit(df, labels, "text", "doc_id", "toxic")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.doc_id < 800 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    wrong = [r for r in held if (r.score >= X.THRESHOLD) != bool(truth[r.doc_id])]
    assert len(held) > 100 and len(wrong) <= 0.05 * len(held)
    left = X.drop_toxic(df, X.fit(df, labels, "text", "doc_id", "toxic"))
    assert left.columns == df.columns and 500 < left.count() < 700


def test_no_rows_or_no_labels(spark, table):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in X.score(table([(1, "x")]), X.fit(table([(1, "x")]), labels, "text", "doc_id", "toxic")).collect()] == [0.0]
    empty = table([])
    assert X.score(empty, X.fit(empty, labels, "text", "doc_id", "toxic")).count() == 0


# ---- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            doubled = sum(sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d)))
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")) or kind == "phone" and 9 <= len(d) <= 15 \
                    or kind == "card" and 12 <= len(d) <= 19 and doubled % 10 == 0:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], P.KINDS.index(s[2])))


def test_base_spans_are_the_patterns():
    rng = random.Random(2)
    parts = ["@a.b", "1.2.3.4", "+49 ", "4111 1111 1111 1111", "256.0.0.1", "a@b.c_d@e.f", *"aB019.@+- ()_%é\n"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 15)))
        assert P.base_spans(t) == plain_spans(t), t
    for long in ("1" * 100_000, "a" * 100_000 + "@", "@" * 100_000, "+1" + " " * 100_000, "1." * 50_000):
        P.base_spans(long)


def test_field_carries_labels_to_similar_mentions():
    field = P.Field()
    t = "Call +49 170 1234567 now. Later 0170 1234567 or 0170-123-4567; mail Joe@Example.com, id 9912345678"
    assert [(t[a:b], k) for a, b, k in P.find(t, field)[1]] == [
        ("+49 170 1234567", "phone"), ("0170 1234567", "phone"), ("0170-123-4567", "phone"), ("Joe@Example.com", "email")]
    clean = "Order 9912345678 of 1999-12-31 costs 1234.50, twice 9912345678."
    assert P.find(clean, field) == ([], [])


def test_messages_equal_enumeration():
    """On a chain (a tree) sum-product gives the exact marginals."""
    field = P.Field()
    rng = np.random.default_rng(0)
    field.chain = rng.standard_normal((5, 5))
    field.chain += field.chain.T
    d = P.Nodes("1234567 2345678 3456789", [])
    p = field.marginals(d)
    z = np.zeros((5, 5, 5))
    u = field.scores(d.features)
    for i in range(5):
        for j in range(5):
            for k in range(5):
                z[i, j, k] = u[0, i] + u[1, j] + u[2, k] + field.chain[i, j] + field.chain[j, k]
    z = np.exp(z)
    z /= z.sum()
    assert np.allclose(p, [z.sum((1, 2)), z.sum((0, 2)), z.sum((0, 1))], atol=2e-3)


def test_pii_frames(spark, table):
    df = table([(1, "a@b.cd and 1.2.3.4"), (2, None), (3, ""), (3, "a@b.cd"), (None, "x" * 50_000 + " a@b.cd")])
    field = P.fit(df)
    got = P.find_pii(df, field).collect()
    assert sorted(len(r.spans) for r in got) == [0, 0, 1, 1, 2]
    masked = P.mask_pii(df, field, length="n_chars")
    assert masked.columns == df.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in masked.collect() if r.doc_id} == {(1, "<EMAIL> and <IP>", 16), (2, None, None), (3, "", 0), (3, "<EMAIL>", 7)}
    assert P.find_pii(table([]), P.fit(table([]))).count() == 0


# ---- language model

def base_scores(rows):
    tokens = [[*(t or "").encode().lower().split(), b"\t"] for _, t in rows]
    train = Counter(w for (i, _), t in zip(rows, tokens, strict=True) if not L.is_held_out(i) for w in t)
    n, v = sum(train.values()), len(train)
    return [(i, L.is_held_out(i), len(t), sum(train[w] > 0 for w in t), n, sum(np.log10((train[w] + 1) / (n + v + 1)) for w in t))
            for (i, _), t in zip(rows, tokens, strict=True)]


def test_language_model(spark, table):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    rows += [(10_001, None), (10_002, ""), (10_003, "The THE the"), (10_003, "zzqj xkcd"), (10_004, "w" * 30_000)]
    got = sorted(L.score_texts(table(rows)).collect(), key=lambda r: (r.id, r.n_tokens, r.score))
    want = sorted(base_scores(rows), key=lambda r: (r[0], r[2]))
    assert [(r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got if r.id != 10_003] == [w[:5] for w in want if w[0] != 10_003]
    assert np.allclose(sorted(r.base_score for r in got), sorted(w[5] for w in want), rtol=1e-12)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert L.score_texts(table([])).count() == 0


def test_held_out_texts_are_better_predicted_than_by_words_alone(table):
    rng = random.Random(8)
    tongues = [["".join(rng.choice(s) for _ in range(rng.randint(1, 3))) for _ in range(150)] for s in (["ba", "de", "ki"], ["mou", "rel", "vis"])]
    rows = [(i, " ".join(rng.choice(tongues[i % 2]) for _ in range(60))) for i in range(300)]
    held = [r for r in L.score_texts(table(rows)).collect() if r.held_out]
    assert len(held) > 20 and sum(r.score for r in held) > sum(r.base_score for r in held) + 5 * len(held)
