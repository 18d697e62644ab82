"""Toxicity by class-conditional Kneser-Ney models.

Two models of words, toxic and ordinary. A word's probability is its discounted
count in the class, backed off to the class's continuation counts of ever
shorter stems (how many different longer stems with these first letters the
class has), backed off to the continuation counts both classes share. A rare or
unseen word is thus told apart only as far as its beginning is; one that
neither class knows counts the same in both. The difference of the two
log-likelihoods, normalised by length, is taken over the whole text and over
its most toxic windows; a logistic curve fitted on the other half of the
training documents turns these into a probability.

The models are fitted on a bounded sample of labelled documents (``Sample``);
all texts are scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import staged
from lakemart.llm.shingles import SLICE_CHARS

WORD = re.compile(r"\w+").findall
STEMS = (7, 6, 5, 4)
WINDOWS = (12, 60)
DISCOUNT = 0.75
THRESHOLD = 0.3
SCORED = "doc_id long, held_out boolean, score double, predicted int"


@dataclass(frozen=True)
class Sample:
    """Bound of the labelled sample: rows and characters of each class."""

    toxic: int = 3_000
    ordinary: int = 6_000
    chars: int = 24_000_000


class Ratios:
    """A number for each known text, kept as two arrays: 64-bit hashes in order, and values."""

    def __init__(self, known: dict[str, float]):
        keys = self._hashes(list(known))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.fromiter(known.values(), np.float64, len(known))[order]

    @staticmethod
    def _hashes(texts: list[str]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts))

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Ratios) and np.array_equal(self.keys, other.keys) and np.array_equal(
            self.values, other.values)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Which texts are known, and the values of those."""
        keys = self._hashes(texts)
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(0)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return known, self.values[at[known]]


@dataclass
class KneserNey:
    """Log-likelihood ratio, toxic over ordinary, of a word."""

    words: Ratios
    stems: Ratios  # of new words with this longest known beginning
    unknown: float
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    prior: float | None = None

    def __call__(self, word: str) -> float:
        return float(self.ratios([word])[0])

    def ratios(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.unknown)
        known, values = self.words.of(words)
        out[known] = values
        left = np.flatnonzero(~known)
        for length in STEMS:
            known, values = self.stems.of([words[i][:length] for i in left.tolist()])
            out[left[known]] = values
            left = left[~known]
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: mean ratio a word, and the largest mean over each of ``WINDOWS``."""
        parts = [WORD(t.lower()) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        different = list(dict.fromkeys(w for p in parts for w in p))
        known = dict(zip(different, self.ratios(different).tolist()))
        ratio = np.fromiter(
            (r for p in parts for r in map(known.__getitem__, p)), np.float64, int(sizes.sum()))
        out = np.zeros((len(texts), 1 + len(WINDOWS)))
        some = np.flatnonzero(sizes)
        if len(some):
            ends = np.cumsum(sizes)
            sums = np.concatenate([[0.0], np.cumsum(ratio)])
            last = np.repeat(ends, sizes)
            out[some, 0] = (sums[ends] - sums[ends - sizes])[some] / sizes[some]
            for k, width in enumerate(WINDOWS, 1):
                stop = np.minimum(np.arange(len(ratio)) + width, last)
                out[some, k] = np.maximum.reduceat((sums[stop] - sums[:-1]) / width, (ends - sizes)[some])
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(features), self.prior)
        w = np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(features @ w[:-1] + w[-1], -40, 40)))


def kneser_ney(counts: dict[str, tuple[int, int]]) -> KneserNey:
    """The ratio model from each word's counts (ordinary, toxic).

    From the shortest stem up, a level's class probability is its discounted
    continuation count plus the discounted mass times the level below, shared
    out by how many longer stems both classes together have below it.
    """
    words = list(counts)
    n = np.array([counts[w] for w in words], np.float64).reshape(-1, 2)
    # Bottom up: for each level the items, the item below each, and class counts of distinct items.
    items, levels, has = words, [], n
    for length in STEMS:
        below, of = np.unique(np.array([w[:length] for w in items] or [""]), return_inverse=True)
        of = of[: len(items)]
        kinds = np.stack([np.bincount(of, has[:, c] > 0, len(below)) for c in (0, 1)], axis=1)
        levels.append((items, has, of, np.bincount(of, minlength=len(below)).astype(np.float64)))
        items, has = below.tolist(), kinds
    every = max(len(levels[-1][0]), 1)
    floor = DISCOUNT * len(items) / every / (len(items) + 1)
    # The shortest stems fall back on the continuation counts of both classes together.
    shared = (np.maximum(levels[-1][3] - DISCOUNT, 0) / every + floor)[:, None]
    lowest = np.full(2, floor)
    total = np.maximum(has.sum(axis=0), 1)
    rest = DISCOUNT * np.maximum((has > 0).sum(axis=0), 1) / total
    p, lowest = np.maximum(has - DISCOUNT, 0) / total + rest * shared, lowest * rest
    stems: dict[str, float] = {}

    def ratio(q: np.ndarray) -> np.ndarray:
        return np.log(q[..., 1]) - np.log(q[..., 0])

    for longer, has, of, children in reversed(levels):
        total = np.maximum(has.sum(axis=0), 1)
        rest = DISCOUNT * np.maximum((has > 0).sum(axis=0), 1) / total
        new = rest * p / (children + 1)[:, None]
        # A beginning that was seen, with an unseen continuation.
        stems |= dict(zip(items, ratio(new).tolist()))
        p = np.maximum(has - DISCOUNT, 0) / total + new[of]
        lowest, items = lowest * rest, longer
    return KneserNey(Ratios(dict(zip(words, ratio(p).tolist()))), Ratios(stems), float(ratio(lowest)))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps on standardised features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([0.05] * x.shape[1] + [1e-4])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve(
            (z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    a = w[:-1] / scale
    return (*a.tolist(), float(w[-1] - a @ mean))


def training_sample(docs: DataFrame, labels: DataFrame, keep: Column, sample: Sample) -> DataFrame:
    """Bounded labelled documents: (toxic, half, text), the smallest id hashes of each class.

    Texts of over a hundredth of the characters come after all others, and the
    text at the limit is cut to what is left of it: no text, however long,
    takes the place of its class.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & keep)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    chosen = None
    for kind, rows in ((0, sample.ordinary), (1, sample.toxic)):
        part = known.where(F.col("toxic") == kind).orderBy("h", "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("toxic").orderBy("giant", "h", "doc_id", F.xxhash64("text"))
    size = F.length("text")
    # The window is over the bounded sample only.
    return (
        texts.join(chosen, "doc_id").withColumn("giant", size > sample.chars // 100)
        .withColumn("place", F.row_number().over(order))
        .withColumn("left", sample.chars - F.sum(size).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + size)
        .where((F.col("place") <= max(sample.ordinary, sample.toxic)) & (F.col("left") > 0))
        .select("toxic", (F.col("h") % 2 != 0).alias("half"),
                F.substring("text", F.lit(1), F.col("left").cast("int")).alias("text"))
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[tuple, Counter] = {}
        for kind, half, text in zip(*(c.to_pylist() for c in batch.columns)):
            found.setdefault((kind, half), Counter()).update(WORD(text.lower()))
        rows = [(k, h, w, n) for (k, h), c in found.items() for w, n in c.items()]
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int32(), pa.bool_(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["toxic", "half", "word", "n"])


def fit(docs: DataFrame, labels: DataFrame, keep: Column, sample: Sample = Sample()) -> KneserNey:
    """Fit the two models and the curve; ``keep`` says which labelled rows may teach.

    Without labelled rows of both classes the score is the one class seen, 0 if none.
    """
    taught = staged(training_sample(docs, labels, keep, sample))
    seen = {r.toxic for r in taught.select("toxic").distinct().collect()}
    if seen != {0, 1}:
        model = kneser_ney({})
        model.prior = float(max(seen, default=0))
        return model
    counted = (
        taught.mapInArrow(_count, "toxic int, half boolean, word string, n long")
        .groupBy("word").agg(*[
            F.sum(F.when((F.col("toxic") == kind) & (F.col("half") == half), F.col("n")).otherwise(0)).alias(f"n{kind}{int(half)}")
            for half in (False, True) for kind in (0, 1)])
        .toArrow()
    )
    # Words stay in Arrow's memory; one model's at a time become Python's.
    word = counted.column("word")
    n = np.stack([c.to_numpy() for c in counted.columns[1:]], axis=1)
    del counted
    x, y = [], []
    for half in (False, True):
        own = n[:, 2:] if half else n[:, :2]
        some = own.any(axis=1)
        shared = taught.sparkSession.sparkContext.broadcast(
            kneser_ney(dict(zip(word.filter(pa.array(some)).to_pylist(), own[some].tolist()))))

        def features(batches, shared=shared):
            for batch in batches:
                f = sliced_features(shared.value, batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c) for c in f.T)], ["toxic", "f0", "f1", "f2"])

        got = taught.where(F.col("half") != half).select("toxic", "text").mapInArrow(
            features, "toxic int, f0 double, f1 double, f2 double").toPandas()
        x.append(got[["f0", "f1", "f2"]].to_numpy())
        y.append(got.toxic.to_numpy(np.float64))
        shared.destroy()
    model = kneser_ney(dict(zip(word.to_pylist(), (n[:, :2] + n[:, 2:]).tolist())))
    del word, n
    x, y = np.concatenate(x), np.concatenate(y)
    model.weights = logistic(x, y) if len(set(y)) == 2 else (0.0, 0.0, 0.0, math.log(3.0))
    return model


def sliced_features(model: KneserNey, texts: pa.Array) -> np.ndarray:
    """Features of the texts, of which a bounded number of bytes are Python's at a time."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // SLICE_CHARS)) + 1
    parts = [
        model.features([t or "" for t in texts.slice(at, end - at).to_pylist()])
        for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]) if end > at]
    return np.concatenate([np.zeros((0, 1 + len(WINDOWS))), *parts])


def score_texts(model: KneserNey, texts: pa.Array | list[str | None]) -> np.ndarray:
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    return model.score(sliced_features(model, texts))


def score(docs: DataFrame, model: KneserNey, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text).

    A null text counts as empty; an empty text gets the score of no evidence;
    repeated rows and null ids are scored each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            s = score_texts(model, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(
        F.col("doc_id").cast("long"), held_out.alias("held_out"), F.col("text").cast("string")
    ).mapInArrow(run, SCORED)
