import tracemalloc

import numpy as np
import pytest

from sitewise.llm import vectors as V
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(seed=1, n=240, dim=24):
    r = np.random.default_rng(seed)
    rows = []
    for label in (1, 2, None):
        base = r.standard_normal((n // 6, dim))
        near = base[r.integers(0, len(base), n // 6)] + r.normal(0, r.choice([0.02, 0.1, 0.14, 0.2, 0.3], (n // 6, 1)), (n // 6, dim))
        rows += [(x.tolist(), label) for x in np.concatenate([base, near, near[:5] * 3.5, near[:4]])]
    rows += [(rows[0][0], 2), ([0.0] * dim, 1), ([0.0] * dim, 1), (None, 1), ([], 1), ([float("nan")] * dim, 1), ([float("inf")] + [1.0] * (dim - 1), 1), ([None] + [1.0] * (dim - 1), 1), ([1.0] * (dim - 1), 1), ([1.0] * dim, 1)]
    return [(i + 7, x, label) for i, (x, label) in enumerate(rows)]


def expected(rows, cosine=V.COSINE):
    good = [(i, np.array(x, dtype=np.float32).astype(float), y) for i, x, y in rows if y is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    links = []
    for k, (i, x, y) in enumerate(good):
        for j, z, w in good[:k]:
            if y == w and len(x) == len(z) and x @ z / np.linalg.norm(x) / np.linalg.norm(z) >= cosine:
                links.append((i, j))
    n = {i: 0 for i, _, _ in rows}
    for pair in links:
        for i in pair:
            n[i] += 1
    reach = brute.reach(n, links)
    return {i: (n[i], reach[i], reach[i] == i) for i in n}


@pytest.mark.parametrize("block", [1024, 8])
def test_brute_force(spark, block):
    rows = table()
    want = expected(rows)
    assert sum(1 for n, _, _ in want.values() if n) > 60
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "'x' as block")
    got = V.near_vectors(df, block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want and len(got) == len(rows)


def test_other_tables(spark):
    assert V.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    got = V.near_vectors(spark.createDataFrame([(4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (None, None, None)], SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1) for r in got) == [(-1, 0, -1), (-1, 2, 4), (4, 2, 4), (4, 2, 4)]


def test_estimates_are_unbiased_and_bounds_hold():
    r = np.random.default_rng(5)
    x = r.standard_normal((600, 64))
    x, y = V.unit_rows(x), V.unit_rows(x[:300] + 0.3 * r.standard_normal((300, 64)))
    truth = x @ y.T
    error = V.estimates(V.rotated(x), V.Codes.of(y)) - truth
    assert abs(error.mean()) < 0.002 and 0.05 < error.std() < 0.15
    y = V.unit_rows(x + 0.003 * r.standard_normal(x.shape))
    near = V.Codes.of(y)
    reach = V.estimates(V.rotated(x), near) + V.margins(near)[None, :] >= V.COSINE
    assert (x @ y.T >= V.COSINE).any() and not (~reach & (x @ y.T >= V.COSINE)).any()
    assert reach.mean() < 0.05


def test_a_large_group_of_near_copies_stays_small(spark):
    r = np.random.default_rng(8)
    n, dim = 5000, 64
    x = r.standard_normal(dim) + 0.02 * r.standard_normal((n, dim))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = V.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == n and {(q.component_id, q.n_links) for q in got} == {(0, n - 1)}
    # one pair of dense blocks, as a task holds it
    u = V.unit_rows(x[:2048])
    row = {"block_a": 1, "block_b": 1, "dim": dim, "nodes_a": np.arange(2048).tobytes(), "vectors_a": u.tobytes(), "copies_a": np.ones(2048, np.int64).tobytes()}
    row |= {f"{k}_b": row[f"{k}_a"] for k in ("nodes", "vectors", "copies")} | {"columns": np.arange(2048, dtype=np.int32).tobytes()}
    tracemalloc.start()
    out = V._compare(row, V.COSINE)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 300e6 and out["links"].sum() == 2048 * 2047


def test_very_small_and_large_components_lose_no_link(spark):
    rows = [(5, [1.0, 0.0], 1), (8, [5.0, 0.01], 1), (1, [1e-200, 0.0], 1), (2, [1e200, 0.0], 1), (3, [2e200, 1e198], 1), (4, [5e-324, 0.0], 1), (6, [0.0, 5e-324], 1), (7, [1.7e308, -1.7e308], 1), (9, [1.0, -1.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {i: (5, 1) for i in (1, 2, 3, 4, 5, 8)} | {6: (0, 6), 7: (1, 7), 9: (1, 7)}


def test_forest_spans():
    r = np.random.default_rng(6)
    for _ in range(50):
        n = int(r.integers(1, 40))
        pairs = r.integers(0, n, (int(r.integers(0, 50)), 2))
        edges = V.forest(pairs, n)
        assert len(edges) < n and brute.reach(range(n), edges.tolist()) == brute.reach(range(n), pairs.tolist())
