import random

import numpy as np
import pytest

from aurum.llm import contexts as C
from aurum.llm import lm_score as L

WORDS = "the cat sat on a mat and saw one dog run to its red box by old tree".split()


def ordered(rng, n):
    """Words that mostly follow each other in one order."""
    k, out = rng.randrange(len(WORDS)), []
    for _ in range(n):
        out.append(WORDS[k])
        k = (k + 1) % len(WORDS) if rng.random() < 0.9 else rng.randrange(len(WORDS))
    return out


def test_shuffled_text_scores_lower(table):
    rng = random.Random(4)
    rows = [(i, " ".join(ordered(rng, 60))) for i in range(400)]
    held = [(i, t) for i, t in rows if L.is_held_out(i)]
    ids = iter(x for x in range(10_000, 99_999) if L.is_held_out(x))
    shuffled = {next(ids): i for i, _ in held}
    text = dict(rows)
    rows += [(x, " ".join(rng.sample(text[i].split(), 60))) for x, i in shuffled.items()]
    score = {r.id: r.score for r in L.score_texts(table(rows)).collect()}
    assert len(shuffled) > 30
    assert all(score[x] < score[i] - 5 for x, i in shuffled.items())


TEXT = b"the thin thing that they think of then\t" * 3 + b"other texts\t"


def trained(text, hot, blocks=1):
    """Different grams, and the model with the own arcs of each block."""
    keys, n = np.unique(C.grams(np.frombuffer(b"\t" * C.ORDER + text, np.uint8), np.array([len(text)])), return_counts=True)
    block = C.blocks_of(keys, blocks, hot)
    parts, new, old, own = {}, 0, 0, []
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    for b in range(blocks):
        mine, shared = C.block_arcs(keys[block == b], n[block == b], hot)
        own.append(mine)
        for k, x in shared.items():
            parts[k] = C.added(parts.get(k, none), x)
        more = [C.Order(k, *x).left_out() for k, x in mine.items()]
        new, old = new + sum(x for x, _ in more), old + sum(x for _, x in more)
    return keys, C.Model(parts, new, old), own


def all_hot(text):
    keys = np.unique(C.grams(np.frombuffer(b"\t" * C.ORDER + text, np.uint8), np.array([len(text)])))
    return {k: np.unique(keys & C.mask(k)) for k in range(C.SHARED + 1, C.ORDER)}


def test_symbols_of_every_context_sum_to_one():
    keys, model, (own,) = trained(TEXT, {})
    for context in (b"he thi", b"xxxxhe", b"zzzzzt", b"zzzzzz", b"\t" * 6):
        high = sum(b << 8 * (k + 1) for k, b in enumerate(context))
        asked = np.array([high | s for s in range(256)], np.uint64)
        assert (10 ** model.log10(asked, own)).sum() == pytest.approx(1)


@pytest.mark.parametrize("which", ["all", "few"])
def test_hot_contexts_change_nothing(which):
    want, plain, (own,) = trained(TEXT, {})
    hot = all_hot(TEXT)
    if which == "few":  # a longer context is hot only if its shorter ones are
        hot = {3: hot[3][::2]}
    keys, model, split = trained(TEXT, hot, 5)
    block = C.blocks_of(keys, 5, hot)
    got = np.empty(len(keys))
    for b in range(5):
        got[block == b] = model.log10(keys[block == b], split[b])
    assert np.allclose(got, plain.log10(want, own), rtol=1e-12)


class Plain:
    """PPM with dictionaries, byte by byte, as the module's text defines it."""

    def __init__(self, texts):
        self.count = {}
        for t in texts:
            t = b"\t" * C.ORDER + t
            for i in range(C.ORDER, len(t)):
                c = self.count.setdefault(t[i - C.ORDER:i], {})
                c[t[i]] = c.get(t[i], 0) + 1
        longer = dict(self.count)
        for k in range(C.ORDER - 1, -1, -1):
            shorter = {}
            for context, symbols in longer.items():
                for s in symbols:  # each different longer arc counts once
                    c = shorter.setdefault(context[1:], {})
                    c[s] = c.get(s, 0) + 1
            self.count |= shorter
            longer = shorter
        self.new, self.old = {}, {}
        for context, c in self.count.items():
            t, d, ones = sum(c.values()), len(c), sum(n == 1 for n in c.values())
            if t > 1:
                a, b = self.state(context, t - 1, max(d - 1, 1)), self.state(context, t - 1, d)
                self.new[a] = self.new.get(a, 0) + ones
                self.old[b] = self.old.get(b, 0) + t - ones

    @staticmethod
    def state(context, t, d):
        def size(x):
            return x if x <= 4 else x.bit_length() + 2
        blank = max(context.rfind(b" "), context.rfind(b"\t"))
        return len(context), len(context) - 1 - blank if blank >= 0 else len(context), min(size(t), 63), min(size(d), 15)

    def escape(self, context, t, d):
        s = self.state(context, t, d)
        new, old = self.new.get(s, 0), self.old.get(s, 0)
        return (new + 0.5) / (new + old + 1) if new + old else d / (t + d)

    def log10(self, text):
        t, total = b"\t" * C.ORDER + text, 0.0
        for i in range(C.ORDER, len(t)):
            gone = set()
            for k in range(C.ORDER, -1, -1):
                c = self.count.get(t[i - k:i])
                if c is None:
                    gone = set()
                    continue
                n, free = sum(c.values()), sum(x for s, x in c.items() if s not in gone)
                e = self.escape(t[i - k:i], n, len(c))
                whole = (1 - e) * free + e * n
                if t[i] in c:
                    total += np.log10((1 - e) * c[t[i]] / whole)
                    break
                total += np.log10(e * n / whole)
                gone = set(c)
            else:
                total -= np.log10(256 - len(self.count.get(b"", {})))
        return total


def test_scores_equal_a_brute_force_ppm(table, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(ordered(rng, rng.randint(0, 30)))) for i in range(150)] + [(200 + i, "é日本 " * i + "Zebra") for i in range(20)]
    rows += [(300, None), (301, ""), (302, "unheard-of bytes \u00ff\x01")]
    closed = {i: b" ".join(L.split(t)) + b"\t" for i, t in rows}
    plain = Plain([t for i, t in closed.items() if not L.is_held_out(i)])
    want = {i: plain.log10(t) for i, t in closed.items()}
    for hot in (1024, 20):
        monkeypatch.setattr(L, "HOT", hot)
        got = {r.id: r.score for r in L.score_texts(table(rows)).collect()}
        assert got.keys() == want.keys()
        assert all(got[i] == pytest.approx(want[i], rel=1e-5) for i in want)


def test_pieces_of_long_texts_lose_no_gram(monkeypatch):
    bodies = [b"abcdefghijklmnopqrstuvwxyz" * 9 + b"\t", b"\t", b"short\t", b"x" * 99 + b"\t"]
    whole = [(k.tolist(), o.tolist()) for k, o in L._pieces(bodies)]
    monkeypatch.setattr(L, "PIECE_BYTES", 16)
    pieces = [(k.tolist(), o.tolist()) for k, o in L._pieces(bodies)]
    assert len(pieces) > 10 > len(whole)
    assert [sum((x[i] for x in pieces), []) for i in (0, 1)] == [sum((x[i] for x in whole), []) for i in (0, 1)]


def test_blocks_and_buffers_change_nothing(table, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(ordered(rng, rng.randint(0, 40)))) for i in range(120)]
    want = sorted((r.id, r.score) for r in L.score_texts(table(rows)).collect())
    monkeypatch.setattr(L, "BLOCKS", 3)
    got = sorted((r.id, r.score) for r in L.score_texts(table(rows).repartition(3)).collect())
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-6)


def test_an_empty_table_finds_no_hot_context(spark):
    src = spark.createDataFrame([], "id long, t string")
    assert all(len(x) == 0 for x in L._hot_contexts(src, 1.0).values())


def test_sorted_pieces_give_each_symbol_its_gram_and_text(monkeypatch):
    monkeypatch.setattr(L, "PIECE_BYTES", 200)
    monkeypatch.setattr(L, "PIECE_TEXTS", 7)
    monkeypatch.setattr(L, "MERGE", 300)
    rng = random.Random(6)
    bodies = [" ".join(ordered(rng, rng.choice([0, 3, 9, 150]))).encode() + L.END for _ in range(60)]
    want = [(int(g), int(i)) for keys, owner in L._pieces(bodies) for g, i in zip(keys, owner, strict=True)]
    pieces, keys = L._sorted_pieces(bodies)
    got = []
    for some, new, first, owner in pieces:
        place = np.cumsum(np.unpackbits(new, count=len(owner)), dtype=np.int64) - 1
        got += [(int(g), int(i) + first) for g, i in zip(some[place], owner, strict=True)]
    assert sorted(got) == sorted(want) and len(pieces) > 5
    assert keys.tolist() == sorted({g for g, _ in want})


def test_texts_of_a_task_share_what_they_send(monkeypatch):
    """A buffer sends its grams once: 6 MB of text are one buffer (two before), held in few bytes for each byte."""
    import pyarrow as pa

    monkeypatch.setattr(L, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": staticmethod(lambda: 3)}))}))
    rng = random.Random(7)
    some = [" ".join(ordered(rng, 500)) for _ in range(40)]
    texts = [rng.choice(some) for _ in range(4000)]
    assert 6 << 20 < sum(map(len, texts)) < 16 << 20
    batch = pa.RecordBatch.from_pydict({"id": list(range(4000)), "t": texts})
    rows = [r for b in L._gather([batch], 16, {}) for r in b.to_pylist()]
    assert [r["ids"] for r in rows if r["kind"] == L.TEXTS] == [list(range(4000))]
    pieces, _ = L._sorted_pieces([t.encode() + L.END for t in texts])
    assert sum(x.nbytes for p in pieces for x in p if isinstance(x, np.ndarray)) < 4 * sum(map(len, texts))


def test_grams_of_a_buffer_are_sorted_not_hashed(monkeypatch):
    """np.unique without counts hashes numbers, which took a third of the scoring of texts."""
    bodies = [b" ".join(ordered_words) + b"\t" for ordered_words in ([w.encode() for w in WORDS], [b"cat"] * 9, [])]
    want = np.unique(np.concatenate([keys for keys, _ in L._pieces(bodies)]))

    def hashed(*_, **__):
        raise AssertionError("np.unique")

    monkeypatch.setattr(np, "unique", hashed)
    assert L._sorted_pieces(bodies)[1].tolist() == want.tolist()
    assert not len(C.different(np.empty(0, np.uint64)))
