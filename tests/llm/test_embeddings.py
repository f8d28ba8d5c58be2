"""Vector groups and link counts against all pairs."""

import numpy as np

from panelfold.llm import embeddings as E
from panelfold.llm.queries import QUERIES


def slow(ids, x, cosine):
    """(links, component) of each row of the matrix, by all pairs."""
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    root = E._roots(len(x), *np.nonzero(near)) if near.any() else np.arange(len(x))
    least = {}
    for k, i in enumerate(ids):
        least[root[k]] = min(least.get(root[k], i), i)
    return near.sum(axis=1), [least[r] for r in root]


def clustered(n=900, seed=3):
    """Clusters of several sizes, wide and narrow, one of them denser than any window, and copies."""
    r = np.random.default_rng(seed)
    rows = []
    for size, noise in ((300, 0.02), (40, 0.03), (40, 0.06), (10, 0.08), (5, 0.01), (2, 0.09)):
        centre = r.standard_normal(32)
        rows.append(centre / np.linalg.norm(centre) + noise * r.standard_normal((size, 32)))
    x = np.concatenate(rows)
    x = np.concatenate([x, r.standard_normal((n - len(x) - 50, 32)), x[[0] * 40], 3.0 * x[300:310]])
    return x[r.permutation(len(x))]


def test_recall_and_no_false_link(spark):
    x = clustered()
    ids = [7 * k + 3 for k in range(len(x))]
    df = spark.createDataFrame([(i, v.tolist(), "x", 1) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, first string, n int").repartition(5)
    got = {r.vec_id: r for r in E.near_duplicates(df).collect()}
    links, component = slow(ids, x, 0.95)
    mine = np.array([got[i].n_links for i in ids])
    assert (mine <= links).all() and mine.sum() >= 0.98 * links.sum()
    assert np.mean([got[i].component_id == c for i, c in zip(ids, component)]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_a_component_of_several_tiles_is_counted_exactly(spark):
    x = clustered()
    members = spark.createDataFrame([(1, k, 1 + k % 2, 32, v.tolist()) for k, v in enumerate(x)], "component long, first long, n long, length int, vector array<double>")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    want = near @ np.array([1 + k % 2 for k in range(len(x))])
    got = {r["first"]: r.links for r in E.count_links(members, 0.9, tile=32).collect()}
    assert [got[k] for k in range(len(x))] == want.tolist()


def cone(n, pairs, mutual=0.8, cosine=0.955, seed=5):
    """``n`` unit vectors of a mutual cosine, the first ``pairs`` of them each with a partner at ``cosine``."""
    r = np.random.default_rng(seed)
    across = r.standard_normal((n, 64))
    across[:, 0] = 0
    x = np.sqrt(1 - mutual) * across / np.linalg.norm(across, axis=1)[:, None]
    x[:, 0] = np.sqrt(mutual)
    away = r.standard_normal((pairs, 64))
    away -= np.einsum("ij,ij->i", away, x[:pairs])[:, None] * x[:pairs]
    return np.concatenate([x, cosine * x[:pairs] + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away, axis=1)[:, None]])


def test_passes_go_on_until_dense_pairs_are_found(spark):
    x = cone(5000, 1000)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r.component_id for r in E.near_duplicates(df, passes=2, neighbours=4).collect()}
    assert np.mean([got[5000 + k] == got[k] for k in range(1000)]) > 0.95


def test_few_pairs_among_many_dense_rows_are_found_by_the_passes(spark):
    x = cone(20_000, 60)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    got = {r.vec_id: (r.component_id, r.n_links) for r in E.near_duplicates(df).collect()}
    assert sum(got[20_000 + k] == (k, 1) for k in range(60)) >= 54
    assert sum(n for _, n in got.values()) <= 120


def test_bytes_bound_the_cosine():
    x = E._unit(np.random.default_rng(2).standard_normal((500, 48)) * np.geomspace(1, 50, 48))
    small, unit, lost = E._bytes_of(x)
    y = small * unit[:, None]
    error = np.abs(x @ x.T - y @ y.T)
    assert (error <= lost[:, None] + lost + lost[:, None] * lost + 1e-12).all() and lost.max() < 0.03


def test_edge_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (5, v), (3, [2.0, 4.0, 6.0]), (5, v), (9, None), (8, []), (7, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (10, [float("nan"), 1.0, 1.0]), (11, [float("inf"), 1.0, 1.0]),
        (None, v), (12, [1.0, 2.0]), (13, [2.0, 4.0]), (14, [1e300, 2e300, 3e300]), (15, [-1.0, -2.0, -3.0]), (16, [1e-300, 2e-300, 3e-300]),
    ]
    out = E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == len(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out}
    assert got == {
        5: (4, 3), 3: (4, 3), 14: (4, 3), 16: (4, 3), 9: (0, 9), 8: (0, 8), 7: (0, 7), 6: (0, 6), 10: (0, 10), 11: (0, 11), None: (0, None), 12: (1, 12), 13: (1, 12), 15: (0, 15),
    }
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    links, component = slow([r.vec_id for r in rows], np.array([r.embedding for r in rows], float), 0.95)
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op6_embeddings"](spark, sf).collect()}
    assert got == {r.vec_id: (n, c) for r, n, c in zip(rows, links.tolist(), component)}
