import numpy as np
import pytest
from pyspark.sql import functions as F

from aurum.llm.hard_negatives import first_of_heaps, integer_rows, mine, strassen


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (64, 64, 64), (65, 33, 129), (0, 4, 5), (4, 0, 5), (17, 31, 1)])
def test_strassen_is_the_product(shape):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-300, 300, shape[:2]), rng.integers(-300, 300, shape[1:])
    assert (strassen(a, b, leaf=4) == a @ b).all()


def test_strassen_is_exact_beyond_doubles_and_wraps():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2**29, 2**29, (21, 13)), rng.integers(-2**29, 2**29, (13, 18))
    assert (strassen(a, b, leaf=2) == a @ b).all()
    a, b = rng.integers(-2**62, 2**62, (9, 10)), rng.integers(-2**62, 2**62, (10, 9))
    assert (strassen(a, b, leaf=2) == a @ b).all()  # both modulo 2^64


def test_heaps_merge():
    rng = np.random.default_rng(2)
    heap, score, ids = rng.integers(0, 5, 400), rng.integers(0, 20, 400), rng.permutation(400)
    whole = first_of_heaps(heap, score, ids, 5)
    parts = np.concatenate([first_of_heaps(heap[i:i + 100], score[i:i + 100], ids[i:i + 100], 5) + i for i in range(0, 400, 100)])
    merged = parts[first_of_heaps(heap[parts], score[parts], ids[parts], 5)]
    assert set(whole) == set(merged) and len(whole) == 25


def plain(rows, k=5, low=80):
    """rows: (vec_id, label, vector) as given; brute force in Python integers."""
    use = []
    for n, (i, y, v) in enumerate(rows):
        if i is None or y is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((n, i, (y + 1) % 10 if i % 7 == 0 else y, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for n, i, y, v in use:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for m, j, z, w in use if m != n]  # noqa: B905  a shorter vector ends the sum
        for p, j, _ in sorted(x[:2] + (0,) for x in scored if x[2] == y)[:k]:
            window = sorted(x[:2] for x in scored if x[2] != y and low * -p <= 100 * -x[0] <= 100 * -p)[:k]
            out += [(i, j, r + 1, nid, -p, -s) for r, (s, nid) in enumerate(window)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr(
        "*", "'?' AS v", "0 AS rid", "0 AS side", "0 AS windows", "1 AS uses", "0 AS anchor")
    return sorted(tuple(r) for r in mine(integer_rows(df), F.col("vec_id") % 100 == 0).collect())


def test_against_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(4, 10))
    rows = []
    for n in range(400):
        v = centre[n % 4] + 0.4 * rng.normal(size=10)
        rows.append((n * 5, int(rng.integers(0, 4)), [float(x) for x in v / np.linalg.norm(v)]))
    rows += [rows[0], rows[20], (rows[20][0], 3, rows[21][2])]  # repeated rows, a repeated id
    rows += [(9000, 1, None), (9100, None, rows[5][2]), (9200, 1, [1.0, None] + [0.0] * 8), (9300, 1, [float("nan")] * 10), (9400, 1, [float("inf")] * 10),
             (None, 1, rows[5][2]), (9500, 1, []), (9600, 77, rows[5][2]), (9700, 1, [0.0] * 10), (9800, 2, rows[5][2][:4])]
    rows += [(10001 + i, 2, rows[8][2]) for i in range(30)]  # ties
    got = mined(spark, rows)
    assert got == plain(rows) and len(got) > 100


def test_none_and_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0, 0.0]), (2, 2, [1.0, 0.0])]) == []  # no anchor
    assert mined(spark, [(100, 1, [1.0, 0.0]), (2, 2, [1.0, 0.0])]) == []  # no positive


def test_one_label_of_all_rows_has_no_negatives(spark):
    assert mined(spark, [(100 * n + 100, 1, [1.0, n / 9]) for n in range(3)]) == []


def test_several_blocks_give_the_same(spark, monkeypatch):
    from aurum.llm import hard_negatives
    rng = np.random.default_rng(4)
    rows = [(n * 10, int(n % 3), [float(x) for x in rng.normal(size=6) + (n % 5 == 0)]) for n in range(300)]
    whole = mined(spark, rows)
    monkeypatch.setattr(hard_negatives, "ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    assert mined(spark, rows) == whole == plain(rows) and whole
