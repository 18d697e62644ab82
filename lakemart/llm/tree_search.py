"""Nearest neighbours through a hierarchical k-means tree.

The tree is fitted on a bounded sample, its leaves split further on samples of
their own until none holds too many vectors, and sent to every task; all vectors
are dealt out to its leaves. A query walks the tree best bin first: a priority queue
holds the branches seen so far by the cosine of their centres, and each leaf
taken from it is visited. How many leaves a query visits is widened until the
recall against brute force, measured on a bounded sample of queries over all
vectors, reaches the target; if nothing less does, all leaves are visited.

A leaf's vectors are split into blocks of a bounded number of rows, so one leaf
may hold any share of the table. A block keeps each query's best; these meet.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import staged
from lakemart.llm.vectors import cosines, dimension, k_means, matrix, unit, usable

FOUND = "query_id long, vec_id long, score double"
_BLOCK_ROWS = 4_000


@dataclass(frozen=True)
class Setting:
    """``sample`` rows fit the tree, ``calibrate`` queries measure recall, a leaf holds ``most`` rows."""

    branch: int = 8
    leaf: int = 64
    sample: int = 20_000
    calibrate: int = 64
    recall: float = 0.97
    neighbours: int = 5
    most: int = 50_000


@dataclass
class Tree:
    """Inner nodes in one array: centres, and for each child a node number or a leaf as ~number."""

    centres: list[np.ndarray]
    children: list[list[int]]
    leaves: int

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row falls into, going down by the nearest centre."""
        out = np.zeros(len(x), np.int64)
        stack = [(0, np.arange(len(x)))] if self.centres else []
        while stack:
            node, rows = stack.pop()
            near = (x[rows] @ self.centres[node].T).argmax(axis=1)
            for k, child in enumerate(self.children[node]):
                own = rows[near == k]
                if child < 0:
                    out[own] = ~child
                elif len(own):
                    stack.append((child, own))
        return out

    def best_first(self, x: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves for one row, the nearest branch always next."""
        if not self.centres:
            return [0]
        found, queue = [], [(-2.0, 0, 0)]
        while queue and len(found) < visits:
            _, node, leaf = heapq.heappop(queue)
            if leaf:
                found.append(leaf - 1)
                continue
            for near, child in zip((self.centres[node] @ x).tolist(), self.children[node]):
                heapq.heappush(queue, (-near, max(child, 0), ~child + 1 if child < 0 else 0))
        return found


def grow(x: np.ndarray, setting: Setting) -> Tree:
    """Split unit rows by k-means until a node holds at most ``leaf`` of them."""
    tree = Tree([], [], 0)
    different = len(np.unique(x, axis=0)) if len(x) else 0
    if different <= setting.leaf:
        tree.leaves = 1
        return tree
    todo = [(x, None, 0)]
    while todo:
        rows, parent, place = todo.pop()
        centres = k_means(rows, setting.branch, seed=len(tree.centres)) if len(rows) > setting.leaf else rows[:1]
        if len(centres) < 2:
            tree.children[parent][place] = ~tree.leaves
            tree.leaves += 1
            continue
        number = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append([0] * len(centres))
        if parent is not None:
            tree.children[parent][place] = number
        near = (rows @ centres.T).argmax(axis=1)
        for k in range(len(centres)):
            todo.append((rows[near == k], number, k))
    return tree


def grafted(tree: Tree, leaf: int, sub: Tree) -> Tree:
    """``tree`` with one leaf replaced by a tree of its own; its first leaf keeps the number."""
    if not tree.centres:
        return sub
    number = {0: leaf} | {k: tree.leaves + k - 1 for k in range(1, sub.leaves)}
    base = len(tree.centres)
    node, place = next((i, c.index(~leaf)) for i, c in enumerate(tree.children) if ~leaf in c)
    tree.centres += sub.centres
    tree.children += [[~number[~c] if c < 0 else c + base for c in children] for children in sub.children]
    tree.children[node][place] = base
    tree.leaves += sub.leaves - 1
    return tree


def _in_leaves(tree):
    """Rows of each leaf that a batch holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            leaf, n = np.unique(tree.value.nearest(unit(x)) if len(x) else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(n)], ["leaf", "n"])

    return run


def _sampled(tree, shares):
    """A share of the rows of each leaf that is to be split, by the hash in the first column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            leaf = tree.value.nearest(unit(x)) if len(x) else np.zeros(0, np.int64)
            share = np.array([shares.value.get(k, 0.0) for k in leaf.tolist()])
            place = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) / 2.0**64
            kept = pa.array(place < share)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column(1)], ["leaf", "vector"]).filter(kept)

    return run


def refined(rows: DataFrame, tree: Tree, most: int, setting: Setting, tight: float = 2.0) -> Tree:
    """``tree`` with leaves split until none holds more than ``most`` of ``rows`` (vec_id, vector).

    The number of leaves so grows with the table. A leaf that is too large is split
    by a tree fitted on about ``sample`` of its own rows, one leaf a group; only
    counts and trees pass through the driver. Leaves stay as they are whose rows
    are equal, or of which half lie within cosine ``tight`` of their centre.
    """
    spark, whole = rows.sparkSession, set()
    while True:
        shared = spark.sparkContext.broadcast(tree)
        counts = rows.select("vec_id", "vector").mapInArrow(_in_leaves(shared), "leaf long, n long")
        large = {r.leaf: r.n for r in counts.groupBy("leaf").agg(F.sum("n").alias("n")).where(
            F.col("n") > most).collect() if r.leaf not in whole}
        if not large:
            return tree

        def subtree(group: pa.Table, large=large) -> pa.Table:
            leaf, x = group["leaf"][0].as_py(), unit(matrix(group["vector"]))
            middle = x.mean(axis=0)
            close = np.median(x @ (middle / max(float(np.sqrt(middle @ middle)), 1e-300))) >= tight
            size = max(2, int(len(x) * most / large[leaf]))
            sub = Tree([], [], 1) if close else grow(x, replace(setting, leaf=size))
            return pa.table({"leaf": pa.array([leaf], pa.int64()), "tree": pa.array([pickle.dumps(sub)], pa.binary())})

        shares = spark.sparkContext.broadcast({k: setting.sample / n for k, n in large.items()})
        grown = (
            rows.select(F.xxhash64("vec_id", F.lit(11)), "vector")
            .mapInArrow(_sampled(shared, shares), "leaf long, vector array<double>")
            .groupBy("leaf").applyInArrow(lambda t: subtree(t), "leaf long, tree binary").collect())
        for leaf, blob in sorted((r.leaf, bytes(r.tree)) for r in grown):
            sub = pickle.loads(blob)
            if sub.leaves > 1:
                tree = grafted(tree, leaf, sub)
            else:
                whole.add(leaf)
        whole |= large.keys() - {r.leaf for r in grown}


def _best(setting: Setting):
    """Each block's nearest vectors of every query that visits it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, x = left["vec_id"].to_numpy(), matrix(left["vector"])
        query_ids, q = right["query_id"].to_numpy(), matrix(right["query"])
        out: list[np.ndarray] = []
        if len(ids) and len(query_ids):
            ux, keep = unit(x), min(setting.neighbours + 1, len(ids))
            for at in range(0, len(query_ids), 256):
                near = unit(q[at : at + 256]) @ ux.T
                # Room for near ties, which the exact scores decide.
                low = np.partition(near, len(ids) - keep, axis=1)[:, len(ids) - keep]
                row, column = np.nonzero(near >= low[:, None] - 1e-9)
                row += at
                other = query_ids[row] != ids[column]
                row, column = row[other], column[other]
                score = np.concatenate([
                    cosines(q[row[i : i + 50_000]], x[column[i : i + 50_000]]) for i in range(0, len(row), 50_000)]
                ) if len(row) else np.zeros(0)
                order = np.lexsort((ids[column], -score, row))
                row, column, score = row[order], column[order], score[order]
                start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
                rank = np.arange(len(row)) - np.repeat(start, np.diff(np.r_[start, len(row)]))
                top = rank < setting.neighbours
                out.append(np.stack([query_ids[row[top]], ids[column[top]], score[top].view(np.int64)], axis=1))
        found = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        return pa.table({
            "query_id": found[:, 0], "vec_id": found[:, 1], "score": np.ascontiguousarray(found[:, 2]).view(np.float64)})

    return run


def _visit(blocks: DataFrame, visits: DataFrame, setting: Setting) -> DataFrame:
    """The nearest of each query in the leaves it visits: (query_id, rank, vec_id, score)."""
    sizes = blocks.groupBy("leaf", "block").count().select("leaf", F.col("block").alias("in_block"))
    asked = visits.join(sizes, "leaf").withColumnRenamed("leaf", "in_leaf")
    near = blocks.groupBy("leaf", "block").cogroup(asked.groupBy("in_leaf", "in_block")).applyInArrow(_best(setting), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= setting.neighbours).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _leaves(tree, visits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            lists = [tree.value.best_first(v, visits) for v in (unit(x) if len(x) else x)]
            of = np.repeat(np.arange(len(lists)), [len(p) for p in lists])
            leaf = np.array([leaf for p in lists for leaf in p], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf), batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of))],
                ["leaf", "query_id", "query"])

    return run


def search(vectors: DataFrame, query: Column, setting: Setting = Setting()) -> DataFrame:
    """Nearest vectors, by cosine, of the rows of ``vectors`` (vec_id, embedding) that ``query`` names.

    Per query its ``neighbours`` nearest others, nearest first, ties to the
    smaller vec_id: query_id, rank, vec_id, score. Rows with a null id or whose
    vector is null, zero or holds null or non-finite components take no part,
    as query or candidate, nor do vectors of another length than the commonest.
    Rows that repeat an id with other vectors are candidates of that id each;
    equal repeated rows count once. A query with fewer others gets them all.
    """
    spark = vectors.sparkSession
    good = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).distinct()
    size = dimension(good, "vector")
    good = staged(good.where(F.size("vector") == size))
    taught = good.orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(setting.sample).select("vector").toArrow()
    tree = grow(unit(matrix(taught["vector"])) if len(taught) else np.zeros((0, 0)), setting)
    tree = refined(good, tree, setting.most, setting)
    shared = spark.sparkContext.broadcast(tree)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            leaf = shared.value.nearest(unit(x)) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", "vec_id", "vector"])

    leaves = staged(good.mapInArrow(placed, "leaf long, vec_id long, vector array<double>"))
    parts = leaves.groupBy("leaf").agg(F.ceil(F.count("*") / _BLOCK_ROWS).alias("parts"))
    blocks = staged(leaves.join(parts, "leaf").select(
        "leaf", F.pmod(F.xxhash64("vec_id"), "parts").alias("block"), "vec_id", "vector"))
    queries = good.where(query).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))

    def visiting(asked: DataFrame, visits: int) -> DataFrame:
        return asked.mapInArrow(_leaves(shared, visits), "leaf long, query_id long, query array<double>")

    # Calibration: the sample's true neighbours once, then ever more leaves.
    sample = staged(queries.orderBy(F.xxhash64("query_id", F.lit(4)), "query_id").limit(setting.calibrate))
    truth = staged(_visit(blocks, visiting(sample, tree.leaves), setting))
    wanted = truth.count()
    visits = min(4, tree.leaves)
    while visits < tree.leaves:
        got = _visit(blocks, visiting(sample, visits), setting).join(
            truth.select("query_id", "vec_id"), ["query_id", "vec_id"]).count()
        if got >= setting.recall * wanted:
            break
        visits = min(visits * 2, tree.leaves)
    return _visit(blocks, visiting(queries, visits), setting)
