import random

import pytest
from pyspark.sql import functions as F

import aurum.llm.ngram_join as J


def brute(rows, width, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)})
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                comp[max(root(a), root(b))] = min(root(a), root(b))
    smallest = {}
    for k, (i, _) in enumerate(rows):
        smallest.setdefault(root(k), []).append(i)
    return sorted((i, len(sets[k]), min(smallest[root(k)])) for k, (i, _) in enumerate(rows))


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    passage = [rng.choice(words) for _ in range(30)]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 2, 5, 40, 120]))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            t[rng.randrange(len(t))] = rng.choice(words)
        if rng.random() < 0.4:
            t = passage + t
        rows.append((1000 - i, rng.choice([" ", "\n", "  "]).join(t)))
    return [*rows, (5000, None), (5001, ""), (5002, " \t"), (5003, "One two"), (5004, "one TWO"), (5005, "one two")]


@pytest.mark.parametrize("width, percent, chunk", [(3, 90, 256), (5, 80, 4), (1, 50, 4)])
def test_components_equal_brute_force(table, monkeypatch, width, percent, chunk):
    monkeypatch.setattr(J, "CHUNK", chunk)  # lists of many blocks
    rows = corpus(width, 120)
    got = J.jaccard_components(table(rows), width=width, percent=percent).select("id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, width, percent)


def test_null_and_repeated_ids(table):
    got = J.jaccard_components(table([(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "x")]), width=2).collect()
    assert sorted(((r.id, r.component_id, r.kept) for r in got), key=repr) == sorted(
        [(None, 2, False), (2, 2, True), (2, 2, False), (None, None, True)], key=repr)


def test_empty_table(table):
    assert J.jaccard_components(table([])).count() == 0


def test_long_word_runs_and_packing():
    import numpy as np
    x = np.array([0, 1, (1 << 40) - 1], np.uint64)
    assert (J._unpack(J._pack(x)) == x).all()
    assert len(J.shingle_hashes("a " * 50_000, 3)) == 1


def test_undecided_pairs_are_made_about_once(spark):
    """A group of texts shares many lists, each without a few of them; all pairs
    across components come, each about once, and no member is copied by the size of its list."""
    rng = random.Random(3)
    comp = {r: 0 if r < 500 else r for r in range(520)}  # one large component and 20 single members
    lists = {t: [r for r in comp if rng.random() < 0.9] for t in range(40)}
    rows = [(t, r, comp[r], len(m)) for t, m in lists.items() for r in m]
    members = spark.createDataFrame(rows, "tok long, rid long, comp long, g long")
    got = [tuple(r) for r in J.undecided_pairs(members, [], lambda a, b: F.lit(True)).collect()]
    want = {(a, b) for m in lists.values() for a in m for b in m if a < b and comp[a] != comp[b]}
    assert set(got) == want
    assert len(got) < 1.2 * len(want)  # before: about 32 times
