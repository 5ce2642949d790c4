import numpy as np
from brute import find

from tidemark.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, threshold):
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def unit(x, label):
        if label is None or x is None or any(v is None for v in x):
            return None
        x = np.array(x, np.float32).astype(float)
        if not len(x) or not np.isfinite(x).all() or not x.any():
            return None
        return x / np.linalg.norm(x)

    units = [unit(x, label) for _, x, label in rows]
    for a in range(n):
        for b in range(a):
            x, y = units[a], units[b]
            if x is None or y is None or len(x) != len(y) or rows[a][2] != rows[b][2]:
                continue
            if x @ y >= threshold:
                links[a] += 1
                links[b] += 1
                parent[find(parent, a)] = find(parent, b)
    least = {}
    for a in range(n):
        root = find(parent, a)
        least[root] = min(least.get(root, 10**9), rows[a][0])
    return sorted(
        (rows[a][0], links[a], least[find(parent, a)], rows[a][0] == least[find(parent, a)])
        for a in range(n)
    )


def _rows():
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for group in range(6):
        centre = rng.normal(size=16)
        for k in range(25):
            x = centre + rng.normal(size=16) * 0.12 * (k % 4)
            rows.append((i, [float(v) for v in x], group % 2))
            i += 1
    rows += [(i + k, rows[k][1], rows[k][2]) for k in range(0, 60, 7)]
    i += 20
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16]
    rows += [(i + k, x, 0) for k, x in enumerate(bad)]
    rows += [(i + 10, rows[0][1], None), (i + 11, rows[0][1][:8], 0), (i + 12, rows[0][1][:8], 0)]
    rows += [(i + 13, [v * 1e-30 for v in rows[0][1]], 0), (0, rows[0][1], 0)]
    return rows


def _found(df):
    return sorted(tuple(r)[:4] for r in df.collect())


def test_equals_brute_force(spark):
    rows = _rows()
    got = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA))
    assert _found(got) == _brute(rows, 0.98)


def test_blocks_do_not_change_links(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 7)
    monkeypatch.setattr(near_vectors, "LOOKING", 11)
    rows = _rows()
    got = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA), threshold=0.9)
    assert _found(got) == _brute(rows, 0.9)


def test_empty_and_unusable_tables(spark):
    assert near_vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, 0), (2, [1.0], None)]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA))
    assert _found(got) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_components_of_a_chain():
    label = np.arange(9)
    a, b = np.array([7, 5, 3, 1]), np.array([5, 3, 1, 8])
    assert near_vectors._joined(a, b, label).tolist() == [0, 1, 2, 1, 4, 1, 6, 1, 1]
