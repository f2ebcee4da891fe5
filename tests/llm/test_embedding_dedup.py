import numpy as np
import pytest

import aurum.llm.embedding_dedup as E


def brute(rows, threshold):
    ok = [k for k, (i, v, y) in enumerate(rows) if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1], float) / max(map(abs, rows[k][1])) for k in ok}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    near = {k: [j for j in ok if j != k and rows[j][2] == rows[k][2] and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= threshold] for k in ok}
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        comp = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(near.get(k, [])), comp, i == comp))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [512, 8])
def test_links_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(E, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    rows = []
    for y in (0, 1):
        for c in rng.standard_normal((40, 16)):
            for _ in range(rng.integers(1, 6)):
                rows.append((len(rows), (c + rng.standard_normal(16) * rng.choice([0, 0.02, 0.05, 0.1])).tolist(), y))
    rows += [(9000 + k, rows[0][1], 0) for k in range(30)]  # many copies
    rows += [(9100, None, 0), (9101, [], 0), (9102, [0.0] * 16, 0), (9103, [1.0, None], 0), (9104, [float("nan")] * 16, 0), (9105, [float("inf"), 1.0], 0),
             (9106, rows[0][1], None), (9107, [1.0, 0.0], 0), (9108, [2.0, 0.0], 0), (None, rows[0][1], 0), (9109, [1e-200, 0.0], 1), (9110, [1e200, 0.0], 1)]
    df = spark.createDataFrame([(*r, "?") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    assert sorted(map(tuple, E.near_duplicates(df).collect()), key=repr) == brute(rows, E.THRESHOLD)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_recall_of_pairs_at_the_threshold():
    bits, tables = E.tables_for(100_000, 0.98, 1e-4)
    rng = np.random.default_rng(1)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.standard_normal((3000, 64))
    o -= (o * a).sum(axis=1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    b = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * o
    planes = E._planes(64, bits * tables)
    same = ((a @ planes >= 0) == (b @ planes >= 0)).reshape(3000, tables, bits).all(axis=2).any(axis=1)
    assert same.mean() >= 0.999
