from collections import Counter, defaultdict

import numpy as np
import pytest

from lakemart.llm import jaccard
from lakemart.llm.common import components
from lakemart.llm.queries import op10_jaccard


def brute(texts, width=5, similarity=0.8):
    sets = {}
    for doc, text in texts.items():
        w = (text or "").lower().split()
        sets[doc] = set(zip(*[w[k:] for k in range(width)])) if len(w) >= width else {tuple(w)} if w else set()
    held = defaultdict(list)
    for doc, s in sets.items():
        for g in s:
            held[g].append(doc)
    shared = Counter((a, b) for docs in held.values() for a in docs for b in docs if a < b)
    degree, parent = Counter(), {d: d for d in texts}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, b), n in shared.items():
        if n >= similarity * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            degree[a] += 1
            degree[b] += 1
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {d: (degree[d], top(d)) for d in texts}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = op10_jaccard(spark, path).collect()
    assert {r.doc_id: (r.n_links, r.component_id) for r in rows} == brute(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def near_copies(n, length=200, seed=0):
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 10**6, length)]
    out = {}
    for i in range(n):
        own = base.copy()
        for at in rng.integers(0, length, rng.integers(0, 6)):
            own[at] = f"x{rng.integers(0, 10**6)}"
        out[i * 3 + 1] = " ".join(own)
    return out


def test_large_group_in_several_blocks(spark):
    texts = near_copies(150)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = jaccard.join(docs, jaccard.Forest(block=40)).collect()
    assert {r.doc_id: (r.n_links, r.component_id) for r in rows} == brute(texts)


def test_corner_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a b"), (5, "a  B"), (6, "one two three four five six"),
            (7, "one two three four five six"), (7, "one two three four five six"), (None, "a b"), (8, "z " * 30_000)]
    docs = spark.createDataFrame([(*r, 5, True) for r in rows], "doc_id long, text string, class_id long, kept boolean")
    got = jaccard.join(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.class_id, r.n_links, r.component_id, r.kept))
    assert len(got) == len(rows)
    assert by[1] == [(1, 0, 1, True)] and by[2] == [(2, 0, 2, True)] and by[3] == [(3, 0, 3, True)]
    assert by[4] == [(4, 1, 4, True)] and by[5] == [(5, 1, 4, False)]
    assert by[6] == [(6, 2, 6, True)] and by[7] == [(6, 2, 6, False)] * 2
    assert by[None] == [(None, 0, None, True)] and by[8] == [(8, 0, 8, True)]
    assert jaccard.join(docs.limit(0)).count() == 0


def test_prefix_is_shortened_to_the_recall():
    forest = jaccard.Forest()
    length = forest.prefix()
    recall = lambda n: 1 - (1 - forest.similarity**n) ** forest.trees
    assert recall(length) >= forest.recall > recall(length + 1)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(6, 90)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 90)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
