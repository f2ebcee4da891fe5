import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from aurum.llm.bpe import Automaton, automaton, decode, encode
from aurum.llm.packing import END, encoder, pack_documents, pack_stream, plan, tail_cuts
from aurum.llm.presplit import default_path

TEXTS = ["", "Hello, world!", "a <|endoftext|> b<|endoftext|><|endoftext|>  c", "x\n  y", "x\n \ny ", " ", "a  ", "a" * 150, "ab" * 50, " " * 200,
         "\n" * 77 + " x", "it's we'LL they're 12 345", "՘֋ x࢏", "日本語テキスト 👍🏽 ẞ", "a b  c", "a\0b \0 c", "naïve café"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_path())


def random_texts(n):
    rng = random.Random(4)
    alphabet = "aabeethinger  \n\t.,!'s0123é漢👍ß՘ 　<|>"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_automaton_and_memo_encode_like_the_library(library):
    texts = TEXTS + random_texts(3000)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    a, e = automaton(default_path()), encoder(default_path())
    assert [a.encode(t) for t in texts] == want
    assert [e.encode(t).tolist() for t in texts] == want
    assert [a.decode(i) for i in want] == [library.decode(i, skip_special_tokens=False) for i in want] == texts


def test_decode_of_cut_characters_is_the_library_s(library):
    ids = library.encode("漢字👍", add_special_tokens=False).ids[:-1]
    assert automaton(default_path()).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_frames_round_trip(table):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, "again")]
    df = table(rows)
    got = decode(encode(df)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert encode(table([])).count() == 0


@pytest.mark.parametrize("window, buffer", [(2048, 1 << 20), (64, 500), (16, 20)])
def test_streams_lose_nothing(window, buffer):
    rng = np.random.default_rng(window)
    ends = np.zeros(100, bool)
    ends[[3, 7]] = True
    docs = [(k, np.append(rng.integers(0, 100, rng.integers(0, 400)), END).astype("<u4")) for k in range(60)]
    seen, at = {}, {}
    for out in pack_stream(iter(docs), ends, window, 5, buffer):
        for doc, start, ids, total, seq, offset in out:
            assert offset == at.get(seq, 0) and len(ids) and seq >= 5
            at[seq] = offset + len(ids)
            assert start == sum(map(len, seen.setdefault(doc, []))) and total == len(docs[doc][1])
            seen[doc].append(ids)
    assert all((np.concatenate(seen[k]) == ids).all() for k, ids in docs)
    assert max(at.values()) <= window


def test_plan_is_the_cheapest():
    def brute(pos, pen, window):
        at, best = [0, *pos], [0] + [1e9] * len(pos)
        for j in range(1, len(at)):
            best[j] = min([best[i] + window - (at[j] - at[i]) + pen[j - 1] for i in range(j) if at[j] - at[i] <= window], default=1e9)
        return best

    rng = random.Random(1)
    for _ in range(200):
        pos = sorted(rng.sample(range(1, 200), 40))
        if max(b - a for a, b in zip([0, *pos], pos, strict=False)) > 32:
            continue
        pen = [rng.choice([0, 2, 6]) for _ in pos]
        cuts = plan(np.array(pos), np.array(pen), 32, False)
        cost = sum(32 - (b - a) + pen[pos.index(b)] for a, b in zip([0, *cuts], cuts, strict=False))
        assert cost == min(c for c, p in zip(brute(pos, pen, 32)[1:], pos, strict=True) if pos[-1] - p < 32)


def test_tail_is_cut_at_powers_of_two():
    assert tail_cuts(1027) == [1024, 2, 1]


def test_packed_frame(table, library):
    rows = [(k, t) for k, t in enumerate(TEXTS * 3)] + [(900, None), (901, "word " * 30_000)]
    got = {}
    for r in sorted(pack_documents(table(rows)).collect(), key=lambda r: (r.doc_id, r.start)):
        assert len(r.ids) == 4 * r.length
        got.setdefault(r.doc_id, []).append(bytes(r.ids))
    for i, t in rows:
        want = np.array([*library.encode(t or "", add_special_tokens=False).ids, END], "<u4").tobytes()
        assert zlib.crc32(b"".join(got[i])) == zlib.crc32(want)
    assert pack_documents(table([])).count() == 0


def test_ids_of_any_type_and_null_ids(spark):
    from aurum.llm.packing import pack_documents
    for kind, ids in (("int", [3, None, 3, None]), ("string", ["a", None, "a", "b"]), ("smallint", [None] * 4)):
        out = pack_documents(spark.createDataFrame(list(zip(ids, ["one two", None, "one two", ""], strict=True)), f"doc_id {kind}, text string"))
        assert out.schema["doc_id"].dataType.simpleString() == kind
        got = out.collect()
        assert sorted(str(r.doc_id) for r in got if r.start == 0) == sorted(map(str, ids))
        assert sorted(r.doc_tokens for r in got if r.start == 0)[:2] == [1, 1]  # null and empty: the end id alone


def test_words_are_walked_with_few_lookups(library):
    class Counting(dict):
        n = 0

        def get(self, key):
            Counting.n += 1
            return dict.get(self, key)

    rng = random.Random(7)
    words = [" " + "".join(rng.choice("eeaaitnoshrdlugenstionß") for _ in range(rng.randint(3, 40))) for _ in range(3000)]
    a = Automaton(default_path())
    a._spelt = Counting(a._spelt)
    assert [list(a._word(w)) for w in words] == [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    assert Counting.n < 3 * sum(len(w.encode()) for w in words)
