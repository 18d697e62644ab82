import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import graph_dedup, tree_search
from lakemart.llm.queries import op6_near_vectors, op9_ann

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int, score double"
ODD = [
    (900, None, 1, 0.0), (901, [0.0, 0.0, 0.0, 0.0], 1, 0.0), (902, [1.0, None, 0.0, 0.0], 1, 0.0),
    (903, [1.0, float("nan"), 0.0, 0.0], 1, 0.0), (904, [float("inf"), 1.0, 0.0, 0.0], 1, 0.0), (905, [1.0, 2.0], 1, 0.0),
]


def cloud(seed=0, groups=12, size=15, noise=0.04):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, 4)) * 3
    x = (centre[:, None, :] + noise * rng.normal(size=(groups, size, 4))).reshape(-1, 4)
    return [(i + 1, [float(v) for v in row], int(i % 3), 0.5) for i, row in enumerate(x)]


def brute_links(rows, limit):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= limit) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    lowest = np.array(ids)
    while True:
        new = np.minimum(lowest, np.where(linked, lowest[None, :], 10**9).min(axis=1))
        if (new == lowest).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), lowest)}
        lowest = new


@pytest.mark.parametrize("block", [1_200, 25])
def test_links_against_brute_force(spark, block):
    rows = cloud()
    got = graph_dedup.link(spark.createDataFrame(rows, SCHEMA), graph_dedup.Graph(shard=30, block=block)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute_links(rows, 0.98)


def test_link_corner_cases(spark):
    same = [(10, [1.0, 2.0, 3.0, -0.0], 1, 0.0), (11, [1.0, 2.0, 3.0, 0.0], 1, 0.0), (12, [2.0, 4.0, 6.0, 0.0], 1, 0.0),
            (13, [1.0, 2.0, 3.0, 0.0], 2, 0.0), (14, [1.0, 2.0, 3.0, 0.0], None, 0.0), (None, [1.0, 2.0, 3.0, 0.0], 1, 0.0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in graph_dedup.link(spark.createDataFrame(ODD + same, SCHEMA)).collect()}
    assert len(got) == len(ODD) + len(same)
    assert all(got[i] == (0, i, True) for i in (900, 901, 902, 903, 904, 905, 13, 14))
    assert got[10] == (2, 10, True) and got[11] == got[12] == (2, 10, False) and got[None] == (0, None, True)
    assert graph_dedup.link(spark.createDataFrame([], SCHEMA)).count() == 0


def test_link_query_covers_the_table(spark):
    assert op6_near_vectors(spark, SF).count() == spark.read.parquet(f"{SF}/embeddings.parquet").count()


def test_search_query_against_brute_force(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in e])
    x = np.array([r.embedding for r in e], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found, hits, wanted = {}, 0, 0
    for r in op9_ann(spark, SF).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {int(i) for i in ids if i % 50 == 0}
    for q, rows in found.items():
        near = x @ x[np.searchsorted(ids, q)]
        near[np.searchsorted(ids, q)] = -9
        best = np.lexsort((ids, -near))[:5]
        assert [r[0] for r in sorted(rows)] == [1, 2, 3, 4, 5]
        for _, v, s in rows:
            assert s == pytest.approx(near[np.searchsorted(ids, v)], abs=1e-12)
        hits += len({r[1] for r in rows} & set(ids[best].tolist()))
        wanted += 5
    assert hits >= 0.9 * wanted


def test_search_corner_cases(spark):
    rows = ODD + [(50, [1.0, 0.0, 0.0, 0.0], 1, 0.0), (3, [1.0, 0.1, 0.0, 0.0], 1, 0.0), (2, [2.0, 0.2, 0.0, 0.0], 1, 0.0),
                  (2, [2.0, 0.2, 0.0, 0.0], 1, 0.0), (100, [0.0, 1.0, 0.0, 0.0], None, 0.0), (None, [1.0, 0.0, 0.0, 0.0], 1, 0.0)]
    got = tree_search.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [
        (50, 1, 2), (50, 2, 3), (50, 3, 100), (100, 1, 2), (100, 2, 3), (100, 3, 50)]
    empty = spark.createDataFrame([], SCHEMA)
    assert tree_search.search(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_search_through_a_deep_tree(spark):
    rows = cloud(seed=3, groups=40, size=40, noise=0.3)
    setting = tree_search.Setting(branch=4, leaf=20)
    got = tree_search.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, setting).collect()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in ids[ids % 50 == 0]:
        near = x @ x[q - 1]
        near[q - 1] = -9
        hits += len(set(ids[np.argsort(-near)[:5]].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert hits >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_leaves_grow_with_the_table(spark):
    """A tree fitted on few rows is split further until its leaves are bounded, but for near copies."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6_000, 8))
    x[:2_000] = x[0] + 1e-4 * rng.normal(size=(2_000, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    setting = tree_search.Setting(leaf=64, sample=300)
    small = tree_search.grow(tree_search.unit(x[5_700:]), setting)
    tree = tree_search.refined(rows, small, 150, setting, 0.98)
    counts = np.bincount(tree.nearest(tree_search.unit(x)), minlength=tree.leaves)
    assert len(counts) == tree.leaves and counts.sum() == 6_000
    held = np.bincount(tree.nearest(tree_search.unit(x[:2_000])), minlength=tree.leaves)
    assert held.max() > 1_500, "near copies stay together"
    # A leaf is left whole if half of it lies close to its centre.
    assert counts[held == 0].max() <= 150 and (counts - held).max() <= held.max()
    assert sorted(tree.best_first(tree_search.unit(x[:1])[0], tree.leaves)) == list(range(tree.leaves))


def test_refined_search_equals_brute_force(spark):
    rows = cloud(seed=3, groups=40, size=12)
    setting = tree_search.Setting(leaf=8, sample=60, most=20)
    got = tree_search.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, setting).collect()
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T
    np.fill_diagonal(near, -2)
    want = {(i + 1, j + 1) for i in range(19, len(rows), 20) for j in np.argsort(-near[i])[:5]}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.97 * len(want)


@pytest.mark.parametrize("most", [25, 10_000])
def test_links_with_bounded_shards(spark, most):
    rows = cloud(seed=6)
    graph = graph_dedup.Graph(shard=30, sample=60, most=most, recall=1.0)
    got = graph_dedup.link(spark.createDataFrame(rows, SCHEMA), graph).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute_links(rows, 0.98)
