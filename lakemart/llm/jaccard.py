"""N-gram Jaccard join through MinHash banding.

Each text's word shingles give ``trees`` bands of MinHash values. A band's
length is fixed by the setting: the most values at which a pair at the wanted
similarity shares some band with the target probability. This replaced an LSH
forest: one limit holds for all pairs, so nothing is left to adapt to the data.
Texts that share a band are candidates. A band's rows arrive sorted by its
hash. A text is compared with the leaders of its band only, and one that almost
equals a leader follows it, already inside the reading task, so that a group of
copies of any size costs one comparison a copy.

Candidates whose signatures agree well enough form families. Within a family
the exact Jaccard similarity of all pairs is computed in blocks from the shared
shingles; only each text's number of links and a spanning forest leave a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import components, staged
from lakemart.llm.shingles import mix, shingle_hashes, slices, word_hashes

LINKED = "doc_id long, class_id long, n_links long, component_id long, kept boolean"
_SKETCH = 64
_COLUMNS = 2048


@dataclass(frozen=True)
class Forest:
    """Setting of the join; ``agree`` and ``follow`` are shares of agreeing signature values."""

    width: int = 5
    similarity: float = 0.8
    trees: int = 16
    depth: int = 6
    recall: float = 0.9995
    agree: float = 0.55
    follow: float = 0.9
    block: int = 1024

    def prefix(self) -> int:
        """The longest prefix whose matches reach the target recall, the shortest being one value."""
        for length in range(self.depth, 0, -1):
            if 1 - (1 - self.similarity**length) ** self.trees >= self.recall:
                return length
        return 1

    def multipliers(self) -> np.ndarray:
        return np.random.default_rng(20).integers(1, 2**63, self.trees * self.depth, np.uint64) | np.uint64(1)


def signatures(texts: list[str], forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Which texts have shingles, and their MinHash values, tree by tree."""
    factor = forest.multipliers()
    have, parts = [], []
    for at, end in slices(texts):
        words, sizes = word_hashes(texts[at:end])
        hashes, counts = shingle_hashes(words, sizes, forest.width)
        some = np.flatnonzero(counts)
        have.append(some + at)
        out = np.empty((len(some), len(factor)), np.uint32)
        if len(some):
            starts = (np.cumsum(counts) - counts)[some]
            for j, f in enumerate(factor):
                out[:, j] = np.minimum.reduceat(((hashes * f) >> np.uint64(32)).astype(np.uint32), starts)
        parts.append(out)
    if not parts:
        return np.zeros(0, np.int64), np.zeros((0, len(factor)), np.uint32)
    return np.concatenate(have), np.concatenate(parts)


def bucket_keys(values: np.ndarray, forest: Forest) -> np.ndarray:
    """One key per text and tree: the hash of the tree's number and shortened prefix."""
    length = forest.prefix()
    paths = values.reshape(len(values), forest.trees, forest.depth)
    keys = np.broadcast_to(np.arange(1, forest.trees + 1, dtype=np.uint64), paths.shape[:2]).copy()
    for level in range(length):
        keys = mix(keys * np.uint64(0x100000001B3) + paths[:, :, level])
    return keys.view(np.int64)


class Leaders:
    """The texts of one prefix group that later ones are compared with."""

    def __init__(self, forest: Forest):
        self.forest, self.n = forest, 0
        self.ids = np.zeros(8, np.int64)
        self.groups = np.zeros(8, np.int64)
        self.sketches = np.zeros((8, _SKETCH), np.uint8)

    def add(self, doc: int, sketch: np.ndarray) -> tuple[np.ndarray, bool]:
        """A leader of every group that ``doc`` joins up, and whether it follows one of them.

        Leaders that are joined already need no further edge, so the edges of a
        prefix group are no more than its texts.
        """
        if self.n:
            share = (self.sketches[: self.n] == sketch).mean(axis=1)
            best = int(share.argmax())
            if share[best] >= self.forest.follow:
                return self.ids[best : best + 1], True
            near = np.flatnonzero(share >= self.forest.agree)
            groups, first = np.unique(self.groups[near], return_index=True)
            linked = self.ids[near[first]]
            if len(groups):
                self.groups[: self.n][np.isin(self.groups[: self.n], groups[1:])] = groups[0]
        else:
            groups, linked = self.groups[:0], self.ids[:0]
        if self.n == len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.groups = np.concatenate([self.groups, np.zeros_like(self.groups)])
            self.sketches = np.concatenate([self.sketches, np.zeros_like(self.sketches)])
        self.ids[self.n], self.sketches[self.n] = doc, sketch
        self.groups[self.n] = groups[0] if len(groups) else self.n
        self.n += 1
        return linked.copy(), False


def _labels(forest: Forest):
    """Rows (bucket, doc, sketch) per text and tree; a follower's row is its edge, without sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            have, values = signatures([t or "" for t in batch.column(1).to_pylist()], forest)
            ids = docs[have]
            keys = bucket_keys(values, forest).ravel()
            sketch = (values[:, :: max(values.shape[1] // _SKETCH, 1)][:, :_SKETCH] & 0xFF).astype(np.uint8)
            owner = np.repeat(np.arange(len(ids)), forest.trees)
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            keep = np.ones(len(keys), bool)
            led: list[tuple[int, int]] = []
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
            lengths = np.diff(np.r_[starts, len(keys)])
            for at, n in zip(starts[lengths > 3].tolist(), lengths[lengths > 3].tolist()):
                leaders = Leaders(forest)
                for k in range(at, at + n):
                    linked, follows = leaders.add(int(ids[owner[k]]), sketch[owner[k]])
                    if follows:
                        keep[k] = False
                        led.append((int(linked[0]), int(ids[owner[k]])))
            edges = np.array(led, np.int64).reshape(-1, 2)
            edges = np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)
            rows, width = owner[keep], sketch.shape[1]
            blob = np.ascontiguousarray(sketch[rows]).tobytes()
            offsets = np.r_[np.arange(len(rows) + 1) * width, np.full(len(edges), len(rows) * width)].astype(np.int32)
            sketches = pa.Array.from_buffers(
                pa.binary(), len(rows) + len(edges), [None, pa.py_buffer(offsets), pa.py_buffer(blob)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[keys[keep], edges[:, 0]]), pa.array(np.r_[ids[rows], edges[:, 1]]), sketches],
                ["bucket", "doc", "sketch"])

    return run


def _sketches(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a sketch, and the sketches of those."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    full = np.diff(offsets) > 0
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(column) else b""
    return full, np.asarray(data, np.uint8).reshape(-1, _SKETCH)


def _bucket_edges(forest: Forest):
    """Edges between the texts of every sorted prefix group; a group may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaders = None, Leaders(forest)
        for batch in batches:
            buckets = batch.column(0).to_numpy(zero_copy_only=False)
            docs = batch.column(1).to_numpy(zero_copy_only=False)
            full, sketches = _sketches(batch.column(2))
            a, b = [docs[~full]], [buckets[~full]]
            buckets, docs = buckets[full], docs[full]
            if len(docs):
                starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
                lengths = np.diff(np.r_[starts, len(buckets)])
                pair = (lengths == 2) & (starts > 0) & (starts + 2 < len(buckets))
                first = starts[pair]
                near = (sketches[first] == sketches[first + 1]).mean(axis=1) >= forest.agree
                a.append(docs[first + 1][near])
                b.append(docs[first][near])
                other = (lengths > 2) | (starts == 0) | (starts + lengths == len(buckets))
                for at, n in zip(starts[other].tolist(), lengths[other].tolist()):
                    if key is None or key != buckets[at]:
                        key, leaders = buckets[at], Leaders(forest)
                    for k in range(at, at + n):
                        linked, _ = leaders.add(int(docs[k]), sketches[k])
                        a.append(np.full(len(linked), docs[k]))
                        b.append(linked)
            a, b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
            pairs = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _shingle_sets(forest: Forest):
    """Each family text's sorted distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            sets: list[bytes] = []
            for at, end in slices(texts):
                words, sizes = word_hashes(texts[at:end])
                hashes, counts = shingle_hashes(words, sizes, forest.width)
                for part in np.split(hashes, np.cumsum(counts)[:-1]):
                    sets.append(np.unique(part).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sets, pa.binary())],
                ["family", "many", "row_block", "column_block", "own", "doc", "copies", "hashes"])

    return run


def links_within(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Matrix of the pairs whose exact Jaccard similarity is at least ``similarity``."""
    sizes = np.array([len(s) for s in sets], np.float64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1  # a shingle of one text adds to no intersection
    column = np.where(shared, np.cumsum(shared) - 1, -1)[column]
    owner, column = owner[column >= 0], column[column >= 0]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + _COLUMNS])
        part = np.zeros((len(sets), _COLUMNS), np.float32)
        part[owner[lo:hi], column[lo:hi] - at] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= similarity * union - 1e-6
    np.fill_diagonal(linked, False)
    return linked


def roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches."""
    label = ids.copy()
    while True:
        low = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        low = np.minimum(label, low)
        if (low == label).all():
            return label
        label = low


def _verify(forest: Forest):
    """Links and spanning edges of each sorted group: one block of a family, or two."""

    def group(rows: list[tuple]) -> list[tuple]:
        family, many, i, j = rows[0][:4]
        ids = np.array([r[5] for r in rows], np.int64)
        own = np.array([r[4] for r in rows])
        copies = np.array([r[6] for r in rows], np.int64)
        linked = links_within([np.frombuffer(r[7], np.uint64) for r in rows], forest.similarity)
        linked &= ids[:, None] != ids[None, :]
        if i != j:  # pairs within a block are counted in the block's own group
            linked &= own[:, None] != own[None, :]
        n = linked @ copies
        root = roots(linked, ids)
        some = np.flatnonzero(n)
        return list(zip(ids[some].tolist(), n[some].tolist(), root[some].tolist(), [many] * len(some)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def pack(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 4
            kinds = [pa.int64()] * 3 + [pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "n", "root", "many"])

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if (row[0], row[2], row[3]) != key:
                    if len(rows) > 1:
                        out += group(rows)
                    key, rows = (row[0], row[2], row[3]), []
                rows.append(row)
            yield pack(out)
        yield pack(group(rows) if len(rows) > 1 else [])

    return run


def join(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Link the rows of ``docs`` (doc_id, text) whose shingle sets are similar enough.

    Identical texts are one class, named by its smallest doc_id; classes are
    linked by exact similarity. Per row: doc_id, class_id, n_links (other rows
    linked directly, copies included), component_id (smallest doc_id reachable)
    and kept (doc_id = component_id). Texts are compared by lower-cased words.

    A text without words (null, empty) links with nothing. A row without doc_id
    is returned unlinked, with null class_id and component_id, and kept. Rows
    that repeat an id are rows of their own; if their texts differ the id stands
    for both. Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    known = base.where(F.col("doc_id").isNotNull())
    has_words = F.col("text").rlike(r"[^\s\x1c-\x1f\x85\xa0  -     　]")
    # Texts without words stand alone: their class key holds their own id.
    keyed = known.select(
        "doc_id", F.xxhash64("text").alias("h1"),
        F.when(has_words, F.xxhash64(F.lit(17), F.col("text"))).otherwise(F.xxhash64("doc_id")).alias("h2"),
        has_words.alias("words"),
    )
    sized = keyed.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("class_id"),
        F.sum(F.col("words").cast("long")).alias("copies"))
    member = staged(keyed.join(sized, ["h1", "h2"]).select("doc_id", "class_id", "copies"))

    labels = known.mapInArrow(_labels(forest), "bucket long, doc long, sketch binary")
    edges = (
        labels.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_bucket_edges(forest), "a long, b long").distinct()
    )
    to_class = member.select("doc_id", "class_id").distinct()
    for side in ("a", "b"):
        edges = edges.join(to_class, F.col(side) == F.col("doc_id")).drop(side, "doc_id").withColumnRenamed("class_id", side)
    family = components(edges).select(F.col("id").alias("doc_id"), F.col("component").alias("family"))

    classes = member.where("doc_id = class_id").groupBy("doc_id").agg(F.max("copies").alias("copies"))
    blocks = family.groupBy("family").agg(F.ceil(F.count("*") / forest.block).cast("int").alias("blocks"))
    placed = (
        family.join(blocks, "family").join(classes, "doc_id")
        .withColumn("own", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    )
    sets = (
        known.join(placed, "doc_id")
        .select("family", (F.col("blocks") > 1).alias("many"), F.col("blocks"), F.lit(0).alias("column_block"),
                "own", "doc_id", "copies", "text")
        .mapInArrow(_shingle_sets(forest), "family long, many boolean, row_block int, column_block int,"
                    " own int, doc long, copies long, hashes binary")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("row_block") - 1)).alias("other")
    grouped = sets.select("family", "many", other, "own", "doc", "copies", "hashes").select(
        "family", "many", F.least("own", "other").alias("row_block"), F.greatest("own", "other").alias("column_block"),
        "own", "doc", "copies", "hashes")
    key = ["family", "row_block", "column_block"]
    verified = staged(
        grouped.repartition(*key).sortWithinPartitions(*key, "doc")
        .mapInArrow(_verify(forest), "doc long, n long, root long, many boolean"))
    counts = verified.groupBy("doc").agg(F.sum("n").alias("linked"))
    whole = verified.where("NOT many").select(F.col("doc").alias("id"), F.col("root").alias("component"))
    parts = components(verified.where("many").select(F.col("doc").alias("a"), F.col("root").alias("b")))
    reached = whole.union(parts).groupBy("id").agg(F.min("component").alias("component"))
    found = counts.join(reached, F.col("doc") == F.col("id"), "left").select(
        F.col("doc").alias("class_id"), "linked", "component")
    component = F.coalesce("component", "class_id")
    linked = member.join(found, "class_id", "left").select(
        "doc_id", "class_id",
        (F.coalesce("linked", F.lit(0)) + F.greatest(F.col("copies") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
    nameless = base.where(F.col("doc_id").isNull()).select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return linked.union(nameless)
