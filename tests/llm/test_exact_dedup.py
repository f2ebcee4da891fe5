import hashlib
import re

import pytest

from aurum.llm.exact_dedup import deduplicate, exact_groups

ROWS = [(3, "a  b\tc"), (1, "a b c"), (2, "a b c"), (7, None), (5, ""), (9, " "), (4, "x" * 9000), (8, "x" * 9000), (6, "x" * 9001),
        (10, "y" * 4096 + "z"), (11, "y" * 4096 + "w"), (None, "a b c")]


def expected(rows):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, norm, strict=True):
        same = [j for (j, _), u in zip(rows, norm, strict=True) if u == t]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


# few key bits force clashes of names on every level; small blocks make many levels
@pytest.mark.parametrize("block_chars, key_bits", [(2048, 64), (3, 64), (3, 3)])
def test_groups_equal_brute_force(table, block_chars, key_bits):
    rows = [(i, t if t is None or len(t) < 5000 or block_chars > 100 else t[:40] + t[-1]) for i, t in ROWS]
    got = exact_groups(table(rows), block_chars=block_chars, key_bits=key_bits).select("id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_repeated_rows_leave_one(table):
    df = table([(1, "a b"), (1, "a b"), (1, "other"), (2, "a  b"), (2, "own")])
    got = deduplicate(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, " ".join(r.text.split())) for r in got.collect()) == [(1, "a b"), (1, "other"), (2, "own")]


def test_empty_table(table):
    assert exact_groups(table([])).count() == 0
    assert deduplicate(table([])).count() == 0


def test_no_python_in_the_plan(table):
    plan = exact_groups(table(ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
