"""Ranked lexical search by classes of documents that score alike.

Only terms of some item can add to a score, so a document is cut down to the
counts of those terms and to m, which stands for its length. Documents with
equal counts and equal m are one class: they are dealt by a hash, verified by the
values themselves, and of each class the smallest ids are kept, no more than can
be asked for. Each class is scored once against all items; each task keeps the
best of each item, and the members are expanded in order of their ids.

Copies thus cost one score however many they are, and their class sends no more
than ``top`` ids from a task. Items are dealt into shards of bounded size that are
searched one after another.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import concat_ranges, staged
from lakemart.llm.terms import PATTERN, terms_of, texts

TOP = 10
#: Distinct (item, term) pairs searched at once, about 200 bytes each in a worker.
SHARD_PAIRS = 1_000_000
#: Scores and sums of one block of classes.
_BLOCK_SCORES, _BLOCK_SUMS = 2_000_000, 4_000_000
_LAST = np.iinfo(np.int64).max


@dataclass
class Items:
    """Items of a shard: ids, the terms with a weight, and the items that hold each term."""

    ids: list[str]
    weight: np.ndarray
    start: np.ndarray
    count: np.ndarray
    item: np.ndarray


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(item, term) for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)))
               for term in dict.fromkeys(terms_of(text))]
        item, term = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, batch.schema.field(0).type), pa.array(term, pa.binary())], ["item", "term"])


def _vectors(shared):
    """Number of terms of each document, and (term, count) pairs of 32-bit numbers by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, vectors = [], []
            for text in texts(batch.column(1)):
                words = terms_of(text)
                found = Counter(map(number, words))
                found.pop(None, None)
                sizes.append(len(words))
                vectors.append(np.array(sorted(found.items()), "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(vectors, pa.binary())],
                ["doc_id", "n", "vector"])

    return run


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of this task that hold each term."""
    counts = np.zeros(0, np.int64)
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")[::2]
        found = np.bincount(flat, minlength=len(counts))
        found[: len(counts)] += counts
        counts = found
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["term", "df"])


class Best:
    """The best classes of each item so far: highest score first, then smallest id."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.members: list[list[int | None]] = []

    def add(self, scores: np.ndarray, first: np.ndarray, members) -> None:
        """``scores``: a row for each class and a column for each item."""
        if len(scores) > self.top:
            self.least = np.maximum(self.least, np.partition(scores, -self.top, axis=0)[-self.top])
        row, item = np.nonzero(scores >= self.least)
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[row, item[len(self.item):]]])
        smallest = np.concatenate([self.first, first[row]])
        order = np.lexsort((smallest, -score, item))
        begin = np.searchsorted(item[order], np.arange(len(self.least)))
        order = order[np.arange(len(order)) - begin[item[order]] < self.top]
        old = len(self.item)
        self.members = [self.members[i] if i < old else members(int(row[i - old])) for i in order.tolist()]
        self.item, self.score, self.first = item[order], score[order], smallest[order]
        held = np.bincount(self.item, minlength=len(self.least)) >= self.top
        ends = np.searchsorted(self.item, np.arange(len(self.least)), "right") - 1
        self.least[held] = np.maximum(self.least[held], self.score[ends[held]])

    def expanded(self) -> Iterator[tuple[int, int | None, int]]:
        """(item, id, score) of the best documents of each item."""
        at = 0
        while at < len(self.item):
            end = int(np.searchsorted(self.item, self.item[at], "right"))
            rows = [(-int(self.score[i]), _LAST if d is None else d, d) for i in range(at, end) for d in self.members[i]]
            for score, _, doc in sorted(rows, key=lambda r: r[:2])[: self.top]:
                yield int(self.item[at]), doc, -score
            at = end


def class_scores(items: Items, vectors: list[bytes], m: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of classes in blocks: number of the first class, and a row for each."""
    sizes = np.array([len(v) // 8 for v in vectors], np.int64)
    flat = np.frombuffer(b"".join(vectors), "<i4").reshape(-1, 2).astype(np.int64)
    owner = np.repeat(np.arange(len(vectors)), sizes)
    term, tf = flat[:, 0], flat[:, 1]
    part = items.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
    sums = np.concatenate([[0], np.cumsum(items.count[term])])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    width = len(items.ids)
    at = 0
    while at < len(vectors):
        end = min(len(vectors), at + max(1, _BLOCK_SCORES // width))
        while end > at + 1 and sums[ends[end]] - sums[ends[at]] > _BLOCK_SUMS:
            end = at + (end - at) // 2
        a, b = ends[at], ends[end]
        count = items.count[term[a:b]]
        where = items.item[concat_ranges(items.start[term[a:b]], count)] + np.repeat(owner[a:b] - at, count) * width
        # Whole numbers below 2 ** 53 add up exactly as doubles.
        scores = np.bincount(where, np.repeat(part[a:b], count), (end - at) * width)
        yield at, scores.astype(np.int64).reshape(-1, width)
        at = end


def _score(shared, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        best = Best(len(items.ids), top)
        for batch in batches:
            vectors = batch.column(0).to_pylist()
            m = batch.column(1).to_numpy(zero_copy_only=False)
            members = batch.column(2)
            first = np.array([_LAST if (d := x[0].as_py()) is None else d for x in members], np.int64)
            for at, scores in class_scores(items, vectors, m):
                best.add(scores, first[at : at + len(scores)], lambda r, at=at: members[at + r].as_py())
        item, doc, score = zip(*best.expanded()) if len(best.item) else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array([items.ids[i] for i in item], pa.string()), pa.array(doc, pa.int64()),
             pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return run


def _shard_items(pairs: DataFrame) -> tuple[list[str], dict[bytes, int], list[tuple[int, int]]]:
    """Item ids, numbers of their terms, and (term, item) pairs of one shard of bounded size."""
    got = pairs.select("item", "term").toArrow()
    ids = {x: i for i, x in enumerate(sorted(set(got.column("item").to_pylist())))}
    terms = {x: i for i, x in enumerate(sorted(set(got.column("term").to_pylist())))}
    rows = sorted((terms[t], ids[i]) for i, t in zip(got.column("item").to_pylist(), got.column("term").to_pylist()))
    return list(ids), terms, rows


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, shard_pairs: int = SHARD_PAIRS
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0.

    ``docs`` has doc_id (whole number) and text, ``items`` item_id and text; other
    columns are not looked at. Terms: ``terms_of``. N counts the documents with
    terms, L all their terms, n one document's terms. A term that df documents
    hold weighs floor(1000 ln((2 N + 2) / (2 df + 1))); it adds its weight times
    (10^9 tf) div (1000 tf + 8 m), with m = 10 + (90 n N) div L. Higher scores come
    first, equal ones by ascending doc_id; a null doc_id comes last.

    Null and empty texts have no terms. Every row of ``docs`` counts as a document,
    also repeated ones. Rows that share an item_id are one item with the terms of
    all; items without an id or without terms, or of which no document has a term,
    give no rows, and so do empty tables.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    pairs = staged(
        items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string"), F.col("text").cast("string"))
        .mapInArrow(_pairs, "item string, term binary").distinct())
    shards = max(1, -(-pairs.count() // shard_pairs))
    pairs = pairs.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)))
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = [_search_shard(spark, source, pairs.where(F.col("shard") == s), top) for s in range(shards)]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select(F.col("item").cast(kind).alias("item_id"), "rank", "doc_id", "score"))


def _search_shard(spark, source: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    ids, terms, rows = _shard_items(pairs)
    vectors = staged(source.mapInArrow(
        _vectors(spark.sparkContext.broadcast(terms)), "doc_id long, n long, vector binary"))
    whole = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    held = np.zeros(max(1, len(terms)), np.int64)
    counts = vectors.where("length(vector) > 0").select("vector").mapInArrow(_holders, "term long, df long")
    for term, df in counts.groupBy("term").agg(F.sum("df")).collect():  # no more rows than item terms
        held[term] = df
    of_item = np.array(rows, np.int64).reshape(-1, 2)
    count = np.bincount(of_item[:, 0], minlength=len(held))
    weight = np.array([math.floor(1000 * math.log((2 * whole.docs + 2) / (2 * df + 1))) for df in held.tolist()])
    made = Items(ids, weight, np.cumsum(count) - count, count, of_item[:, 1].astype(np.int32))
    classes = _classes(vectors, whole.docs, whole.terms, top)
    return classes.mapInArrow(_score(spark.sparkContext.broadcast(made), top), "item string, doc_id long, score long")


def _classes(vectors: DataFrame, docs: int, terms: int, top: int) -> DataFrame:
    """Rows (vector, m, members): each class once, with its ``top`` smallest ids in order."""
    held = vectors.where("length(vector) > 0").select(
        "doc_id", "vector", F.expr(f"10 + (90 * n * {docs}L) div {max(1, terms)}L").alias("m"))
    key = ["h", "vector", "m"]
    order = Window.partitionBy(*key).orderBy(F.asc_nulls_last("doc_id"))
    return (
        held.withColumn("h", F.xxhash64("vector", "m"))
        .withColumn("r", F.row_number().over(order)).where(F.col("r") <= top)
        .groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("r", "doc_id"))).alias("members"))
        .select("vector", "m", F.transform("members", lambda x: x["doc_id"]).alias("members")))


def oracle(top: int = TOP) -> str:
    """The same ranking in DuckDB's SQL, document by document."""
    fold = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({fold}, '{PATTERN}') AS words FROM documents),
whole AS (SELECT count(*) AS n_docs, sum(len(words)) AS n_terms FROM d WHERE len(words) > 0),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({fold}, '{PATTERN}')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
p AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(words) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY rid, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM p CROSS JOIN whole GROUP BY term, n_docs),
m AS (
  SELECT rid, doc_id, 10 + (90 * len(words) * n_docs)::BIGINT // n_terms::BIGINT AS m
  FROM d CROSS JOIN whole WHERE len(words) > 0),
s AS (
  SELECT item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score, any_value(doc_id) AS doc_id
  FROM p JOIN w USING (term) JOIN m USING (rid) JOIN i USING (term) GROUP BY item_id, rid)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
  doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= {top}
"""
