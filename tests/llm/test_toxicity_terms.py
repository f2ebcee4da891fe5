import pickle
import random
import tracemalloc
from collections import Counter

import numpy as np

from aurum.llm import toxicity as X


def test_a_word_of_three_examples_is_no_other_word():
    docs = [Counter({b"common": 3, b"zqlone": 1}) if i < 3 else Counter({b"common": 3, b"word%d" % (i % 7): 1}) for i in range(400)]
    y = np.array([int(i < 3) for i in range(400)])
    y[200:320] = 1
    terms = X.choose_terms(docs, y)
    assert {b"zqlone", b"common"} <= set(terms)
    ix = X.Index(terms, np.array([400.0 if t == b"common" else 3.0 for t in terms]), 400, docs, y, list(range(400)), (277, 123))
    at, cos = ix.search(*ix.vector([(b"zqlone", 1)], X.lookup(ix.number)), k=3)
    assert sorted(ix.ids[i] for i in at) == [0, 1, 2] and cos.min() > 0.5


def test_lookup_gives_the_numbers_of_a_words_terms():
    some = [b"zebra", b"zebr", b"caf\xc3\xa9teria", b"a" * 65, b"ab", b"unseenword", b"unse"]
    number = {t: i for i, t in enumerate(sorted({t for w in some[:5] for t in X.word_terms(w)} | {b"^unse"}))}
    look = X.lookup(number)
    for w in some:
        assert look[w] == tuple(number[t] for t in X.word_terms(w) if t in number)


def test_counts_of_examples_take_a_fraction_of_counters_memory():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(300)) for _ in range(200)] + [""]

    def held(make):
        tracemalloc.start()
        out = make()
        size = tracemalloc.get_traced_memory()[0]
        tracemalloc.stop()
        return out, size

    (counters, many), (counted, few) = held(lambda: [Counter(X.words(t)) for t in texts]), held(lambda: X.Counted(texts))
    assert [list(c.items()) for c in counted] == [list(c.items()) for c in counters] and len(counted) == 201
    assert few < many / 4


def test_an_index_is_sent_without_its_dict():
    docs = [Counter({b"common": 1, b"word%d" % (i % 7): 1}) for i in range(100)]
    y = np.array([i % 2 for i in range(100)])
    terms = X.choose_terms(docs, y)
    ix = X.Index(terms, np.ones(len(terms)), 100, docs, y, list(range(100)), (50, 50))
    assert isinstance(ix.__getstate__()["number"], bytes)
    assert list(pickle.loads(pickle.dumps(ix)).number.items()) == list(ix.number.items())
