"""Near-duplicate vectors through a robust-pruned flat graph.

Vectors of one label are dealt out to overlapping shards: the nearest leaves of
a k-means tree that was fitted on a bounded sample. Each shard links its vectors
by a robust-pruned graph, the shards' adjacency lists are united, and every
vector is searched for in its shards: greedily from the medoid, then on through
all vectors near the wanted range. What is found is verified in double precision.
Recall is audited against brute force on a bounded sample of vectors over all
rows; while it falls short, overlap and search are widened and the search redone.

Equal vectors of a label are one vector with copies. A shard of any size is cut
into blocks, and pairs of blocks are searched apart, so no task grows with a hot
shard. A pair of vectors counts in the smallest shard that both are in; only
counts and a spanning forest leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import components, staged
from lakemart.llm.jaccard import roots
from lakemart.llm.tree_search import Setting as TreeSetting
from lakemart.llm.tree_search import grow, refined
from lakemart.llm.vectors import cosines, dimension, matrix, unit, usable


@dataclass(frozen=True)
class Graph:
    """``slack``: how far below the range a vector may be and still lead on."""

    similarity: float = 0.98
    degree: int = 16
    candidates: int = 64
    alpha: float = 1.2
    beam: int = 24
    slack: float = 0.04
    overlap: int = 3
    shard: int = 400
    block: int = 1_200
    sample: int = 20_000
    audit: int = 100
    recall: float = 0.999
    most: int = 10_000


def robust_prune(x: np.ndarray, graph: Graph) -> np.ndarray:
    """Neighbours of each row, -1 where there are fewer: close ones that no closer neighbour covers.

    A candidate goes when a chosen neighbour is ``alpha`` times as near to it as
    the row itself; squared distances of unit rows stand for the angles.
    """
    n = len(x)
    if n < 2:
        return np.full((n, 1), -1)
    near = x @ x.T
    np.fill_diagonal(near, -9.0)
    k = min(graph.candidates, n - 1)
    chosen = np.argpartition(-near, k - 1, axis=1)[:, :k]
    # Some far rows keep the graph connected.
    far = np.random.default_rng(n).integers(0, n, (n, min(8, n)))
    chosen = np.concatenate([chosen, far], axis=1)
    distance = 2 - 2 * np.take_along_axis(near, chosen, axis=1)
    alive = (chosen != np.arange(n)[:, None])
    out = np.full((n, graph.degree), -1)
    rows = np.arange(n)
    for place in range(graph.degree):
        best = np.where(alive, distance, np.inf).argmin(axis=1)
        some = alive[rows, best]
        if not some.any():
            break
        picked = chosen[rows, best]
        out[some, place] = picked[some]
        between = 2 - 2 * near[picked[:, None], chosen]
        between[chosen == picked[:, None]] = 0
        alive &= graph.alpha**2 * between > distance
        alive[rows, best] = False
    return out


def range_search(x: np.ndarray, links: np.ndarray, graph: Graph) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of ``x`` in groups, with the similarity to all rows met on the way (-9: not met).

    From the medoid every query opens its best unopened row at each step: at
    least ``beam`` rows, and on as long as one lies within ``slack`` of the range.
    """
    n, step = len(x), 4
    medoid = int((x @ x.mean(axis=0)).argmax())
    bound = graph.similarity - graph.slack
    for at in range(0, n, 512):
        q = x[at : at + 512]
        row = np.arange(len(q))
        met = np.full((len(q), n), -9.0)
        unopened = np.full((len(q), n), -9.0)
        met[:, medoid] = unopened[:, medoid] = q @ x[medoid]
        opened, active = 0, row
        while len(active):
            pool = unopened[active]
            k = min(step, n)
            best = np.argpartition(-pool, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(pool, best, axis=1)
            go = (value >= bound) | ((value > -9) & (opened < graph.beam))
            active, best, go = active[go.any(axis=1)], best[go.any(axis=1)], go[go.any(axis=1)]
            if not len(active):
                break
            opened += k
            a, b = np.nonzero(go)
            unopened[active[a], best[a, b]] = -9
            asker = np.repeat(active[a], links.shape[1])
            target = links[best[a, b]].ravel()
            keep = target >= 0
            asker, target = asker[keep], target[keep]
            fresh = met[asker, target] == -9
            key = np.unique(asker[fresh] * n + target[fresh])
            asker, target = key // n, key % n
            for i in range(0, len(asker), 100_000):
                s = slice(i, i + 100_000)
                met[asker[s], target[s]] = unopened[asker[s], target[s]] = np.einsum(
                    "ij,ij->i", q[asker[s]], x[target[s]])
        yield at, met


_GROUP = ["label", "shard", "row_block", "column_block"]


def _edges(graph: Graph):
    def run(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        links = robust_prune(unit(matrix(table["vector"])), graph)
        a, b = np.nonzero(links >= 0)
        b = links[a, b]
        both = np.concatenate([np.stack([ids[a], ids[b]], 1), np.stack([ids[b], ids[a]], 1)])
        return pa.table({"a": both[:, 0], "b": both[:, 1]})

    return run


def _found(graph: Graph, only: bool):
    """Links found from every vector of a group: their number, and a root; or for the audit the pairs."""

    def run(table: pa.Table) -> pa.Table:
        ids, copies = table["vec_id"].to_numpy(), table["copies"].to_numpy()
        own, raw = table["own"].to_numpy(), matrix(table["vector"])
        shard, i, j = (table[c][0].as_py() for c in ("shard", "row_block", "column_block"))
        x, n = unit(raw), len(ids)
        place = {v: k for k, v in enumerate(ids.tolist())}
        lists = [[place[b] for b in row or () if b in place] for row in table["links"].to_pylist()]
        links = np.full((n, max(map(len, lists), default=0) or 1), -1)
        for k, row in enumerate(lists):
            links[k, : len(row)] = row
        # The smallest common shard counts a pair.
        others = [set(s) for s in table["shards"].to_pylist()]
        smaller = sorted({s for o in others for s in o if s < shard})
        inside = np.zeros((n, max(len(smaller), 1)), bool)
        at = {s: k for k, s in enumerate(smaller)}
        for k, o in enumerate(others):
            inside[k, [at[s] for s in o if s < shard]] = True
        linked = np.zeros((n, n), bool)
        for start, met in range_search(x, links, graph):
            near = met >= graph.similarity - 1e-9
            a, b = np.nonzero(near & (np.abs(met - graph.similarity) <= 1e-9))
            near[a, b] = cosines(raw[a + start], raw[b]) >= graph.similarity
            linked[start : start + len(met)] = near
        linked |= linked.T
        np.fill_diagonal(linked, False)
        linked &= (inside.astype(np.float32) @ inside.T.astype(np.float32)) == 0
        if i != j:
            linked &= own[:, None] != own[None, :]
        if only:
            asked = np.flatnonzero(table["asked"].to_numpy(zero_copy_only=False))
            a, b = np.nonzero(linked[asked])
            return pa.table({"a": ids[asked[a]], "b": ids[b]})
        count = linked @ copies
        some = np.flatnonzero(count)
        return pa.table({"vec_id": ids[some], "n": count[some], "root": roots(linked, ids)[some]})

    return run


def _brute(graph: Graph):
    """All links of the audited vectors in one block of a label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = np.zeros((0, 2), np.int64)
        if left.num_rows and right.num_rows:
            ids, asked = left["vec_id"].to_numpy(), right["asked_id"].to_numpy()
            x, q = matrix(left["vector"]), matrix(right["asked_vector"])
            a, b = np.nonzero(unit(q) @ unit(x).T >= graph.similarity - 1e-9)
            keep = (asked[a] != ids[b]) & (cosines(q[a], x[b]) >= graph.similarity)
            pairs = np.stack([asked[a[keep]], ids[b[keep]]], axis=1)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def link(vectors: DataFrame, graph: Graph = Graph()) -> DataFrame:
    """Near-duplicates of ``vectors`` (vec_id, embedding, label) among those of the same label.

    Per row: vec_id, n_links (other rows linked directly), component_id
    (smallest vec_id reachable) and kept (vec_id = component_id). Rows with a
    null label, or whose vector is null, zero or holds null or non-finite
    components, or has another length than the commonest, link with nothing and
    are kept. So are rows with a null vec_id, whose component_id is null. Equal
    rows that repeat an id are links of each other. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"), usable(F.col("embedding")).alias("good"))
    good = rows.where("good AND label IS NOT NULL AND vec_id IS NOT NULL").select("vec_id", "label", "vector")
    size = dimension(good, "vector")
    good = good.where(F.size("vector") == size)
    # Adding zero makes minus zero zero: such vectors are equal.
    sized = good.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0)))
    classes = staged(sized.groupBy("label", "vector").agg(
        F.min("vec_id").alias("class_id"), F.count("*").alias("copies")))
    member = staged(sized.join(classes, ["label", "vector"]).select("vec_id", "class_id", "copies"))
    own = classes.select(F.col("class_id").alias("vec_id"), "label", "copies", "vector")

    taught = own.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(graph.sample).select("vector").toArrow()
    setting = TreeSetting(leaf=graph.shard, sample=graph.sample)
    tree = grow(unit(matrix(taught["vector"])) if len(taught) else np.zeros((0, 0)), setting)
    # Groups of near copies stay together, however large: they are what is looked for.
    tree = refined(own, tree, graph.most, setting, graph.similarity)
    shared = spark.sparkContext.broadcast(tree)
    audited = staged(own.orderBy(F.xxhash64("vec_id", F.lit(6)), "vec_id").limit(graph.audit))
    block = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / graph.block))
    sizes = own.groupBy("label").agg(F.count("*").alias("n"))
    everyone = own.join(sizes, "label").select("label", block.alias("part"), "vec_id", "vector")
    parts = everyone.select(F.col("label").alias("asked_label"), F.col("part").alias("asked_part")).distinct()
    asked = audited.select("label", F.col("vec_id").alias("asked_id"), F.col("vector").alias("asked_vector")).join(
        parts, F.col("label") == F.col("asked_label")).drop("label")
    truth = staged(everyone.groupBy("label", "part").cogroup(asked.groupBy("asked_label", "asked_part")).applyInArrow(
        _brute(graph), "a long, b long"))
    wanted = truth.count()

    while True:
        members = staged(_members(own, shared, graph))
        edges = members.groupBy(*_GROUP).applyInArrow(_edges(graph), "a long, b long").distinct()
        # At most 2 * degree from every group a vector is in, most of them the same.
        links = edges.groupBy("a").agg(F.collect_list("b").alias("links")).withColumnRenamed("a", "node")
        joined = members.join(links, F.col("vec_id") == F.col("node"), "left").drop("node")
        ids = audited.select(F.col("vec_id").alias("node"))
        with_flag = staged(joined.join(ids, F.col("vec_id") == F.col("node"), "left").withColumn(
            "asked", F.col("node").isNotNull()).drop("node"))
        asked_groups = with_flag.where("asked").select(*_GROUP).distinct()
        got = with_flag.join(asked_groups, _GROUP, "left_semi").groupBy(*_GROUP).applyInArrow(
            _found(graph, only=True), "a long, b long").distinct().join(truth, ["a", "b"]).count()
        if got >= graph.recall * wanted:
            break
        if graph.overlap >= tree.leaves and graph.slack >= 2:
            raise RuntimeError(f"the graphs find {got} of {wanted} audited links at their widest setting")
        graph = replace(graph, overlap=graph.overlap * 2, beam=graph.beam * 2, slack=graph.slack * 2)
    found = staged(with_flag.groupBy(*_GROUP).applyInArrow(_found(graph, only=False), "vec_id long, n long, root long"))
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("linked")).withColumnRenamed("vec_id", "of")
    reached = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    best = counts.join(reached, F.col("of") == F.col("id"), "left").select("of", "linked", "component")
    component = F.coalesce("component", "class_id")
    good_rows = member.join(best, F.col("class_id") == F.col("of"), "left").select(
        "vec_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
    alone = rows.where(~(F.col("good") & F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (
        F.size("vector") == size), F.lit(False)))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return good_rows.union(alone)


def _members(own: DataFrame, shared, graph: Graph) -> DataFrame:
    """Vectors in their shards, large shards cut into blocks that meet in pairs."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(3))
            near = [sorted(shared.value.best_first(v, graph.overlap)) for v in (unit(x) if len(x) else x)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.list_(pa.int32()))], ["vec_id", "label", "copies", "vector", "shards"])

    dealt = own.mapInArrow(placed, "vec_id long, label int, copies long, vector array<double>, shards array<int>")
    each = dealt.withColumn("shard", F.explode("shards"))
    blocks = each.groupBy("label", "shard").agg(F.ceil(F.count("*") / graph.block).cast("int").alias("blocks"))
    own_block = F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")
    pairs = each.join(blocks, ["label", "shard"]).withColumn("own", own_block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.select(
        "label", "shard", F.least("own", "other").alias("row_block"), F.greatest("own", "other").alias("column_block"),
        "own", "vec_id", "copies", "shards", "vector")
