import numpy as np

from docspark.llm import vector_forest as V
from tests.llm.helpers import components

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    edges = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b]
    found = components(ids, edges)
    return {i: (int(near[k].sum()) - 1, found[i]) for k, i in enumerate(ids)}


def result(df, **kw):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in V.digest(*V.near_vectors(df, **kw)).collect()}


def planted(rng, clusters, each, noise, dim=64):
    rows = []
    for _ in range(clusters):
        base = rng.standard_normal(dim)
        for _ in range(each):
            rows.append((base + noise * rng.standard_normal(dim)).astype(np.float32))
    return rows


def test_equals_brute_force_with_copies_and_dense_groups(spark):
    rng = np.random.default_rng(4)
    vectors = planted(rng, 120, 5, 0.3) + planted(rng, 1, 200, 0.2) + list(rng.standard_normal((400, 64)).astype(np.float32))
    vectors += [vectors[0]] * 30 + [vectors[700] * 2]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    want = brute(rows)
    got = result(spark.createDataFrame(rows, SCHEMA), leaf=64)
    links = sum(n for n, _ in want.values())
    assert links > 10_000
    assert sum(abs(got[i][0] - want[i][0]) for i in want) <= 0.01 * links
    assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.99


def test_recall_at_the_threshold(spark):
    """Pairs between 0.9 and 0.93 among unrelated vectors."""
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(300):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        r = rng.standard_normal(64)
        r -= (r @ a) * a
        r /= np.linalg.norm(r)
        c = rng.uniform(0.901, 0.93)
        vectors += [a, c * a + np.sqrt(1 - c * c) * r]
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(vectors)]
    got = result(spark.createDataFrame(rows, SCHEMA), leaf=32)
    assert np.mean([got[i][0] >= 1 for i in range(600)]) > 0.99


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (6, [], 1),
        (7, [1.0, 1.0], 1), (8, [2.0, 2.0], 2), (9, [1.0, -1.0], 1), (10, [1.0, 1.0, 1.0], 1), (7, [1.0, 1.0], 1), (None, [1.0, 1.0], 1),
    ]
    got = sorted(V.digest(*V.near_vectors(spark.createDataFrame(rows, SCHEMA))).collect(), key=lambda r: r["vec_id"] or 0)
    linked = {(r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["n_links"]}
    assert linked == {(None, 3, 7), (7, 3, 7), (8, 3, 7)}
    assert all(r["component_id"] == r["vec_id"] and r["kept"] for r in got if not r["n_links"])
    assert len(got) == 12
    assert V.digest(*V.near_vectors(spark.createDataFrame([], SCHEMA))).count() == 0


def test_more_vectors_get_more_trees():
    part = V.parted(0.9, 0.5)
    assert 0.028 < part < 0.031
    for n in (10, 1024, 20_000, 100_000, 4_000_000, 20_000_000, 10**9):
        trees = V.trees_for(n, 1024)
        assert trees >= 4 and (1 - (1 - part) ** V.levels_for(n, 1024)) ** trees <= 1 / 600
    assert V.trees_for(1000, 1024) == 4 < V.trees_for(4_000_000, 1024) < V.trees_for(10**9, 1024)
