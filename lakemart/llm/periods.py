"""Periodic runs of words, by a suffix automaton and access paths over its links.

A run is a stretch of words that repeats with a period at least twice and can't
be extended. A document's words are first cut down to the stretches in which a
run can lie: every word of a run of at least ``shortest`` words belongs to some
``shortest / 2`` words in a row that occur twice in the run.

For each stretch a suffix automaton is built and its words are appended in
order. Appending word i accesses the path from the state of the prefix up to the
root: the path falls into segments of states last seen at the same earlier end
p, and all of it is recoloured to i. A segment of states longer than a and up to
b words, last seen at p = i - d, tells that the last b words before p and i
agree; with a < d <= b, the last 2 d words are a square whose half is no power,
and the run of period d that has it begins at p - b + 1. The run's end is the
last i that tells of it.

The paths are those of link-cut trees. The tree is known once the automaton is
built, so heavy paths take the place of splay trees: an access recolours the
upper part of O(log n) heavy paths, and a stack a path holds its segments. As
with link-cut access, O(n log n) segments are recoloured in all, also in texts
of one repeated word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.terms import texts

SHORTEST = 12
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    last = dict(zip(words, range(len(words))))
    return np.fromiter(map(last.__getitem__, words), np.int64, len(words))


def stretches(ids: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Ranges (start, end) outside which no run of at least ``shortest`` words has a word."""
    width = -(-shortest // 2)
    found = [(0, len(ids))]
    while True:
        kept = [part for a, b in found for part in _repeated(ids[a:b], a, width, shortest)]
        size = sum(b - a for a, b in found)
        # Rounds that take out little cost more than they save.
        if sum(b - a for a, b in kept) > 0.9 * size or not kept:
            return kept
        found = kept


def _repeated(ids: np.ndarray, offset: int, width: int, shortest: int) -> list[tuple[int, int]]:
    n = len(ids)
    if n < shortest:
        return []
    values = ids.astype(np.uint64)
    grams = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        grams = (grams + values[i : n - width + 1 + i]) * _MULTIPLIER
        grams ^= grams >> np.uint64(29)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    steps[at] += 1
    steps[at + width] -= 1
    inside = np.concatenate([[False], np.cumsum(steps[:n]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    edges = edges[edges[:, 1] - edges[:, 0] >= shortest] + offset
    return [tuple(e) for e in edges.tolist()]


def automaton(ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of the states, and the state of each prefix of ``ids``."""
    following: list[dict[int, int]] = [{}]
    link, length, prefix = [-1], [0], []
    last = 0
    for n, w in enumerate(ids, 1):
        new = len(link)
        link.append(0)
        length.append(n)
        following.append({})
        at = last
        while at >= 0 and w not in following[at]:
            following[at][w] = new
            at = link[at]
        if at >= 0:
            there = following[at][w]
            if length[there] != length[at] + 1:
                copy = len(link)
                link.append(link[there])
                length.append(length[at] + 1)
                following.append(following[there].copy())
                while at >= 0 and following[at].get(w) == there:
                    following[at][w] = copy
                    at = link[at]
                link[there] = copy
                there = copy
            link[new] = there
        prefix.append(new)
        last = new
    return link, length, prefix


def heavy_heads(link: list[int], length: list[int]) -> list[int]:
    """Topmost state of the heavy path that each state is on."""
    order = np.argsort(length, kind="stable").tolist()
    size = [1] * len(link)
    for v in reversed(order[1:]):
        size[link[v]] += size[v]
    heavy = [0] * len(link)
    for v in order[1:]:
        best = heavy[link[v]]
        if not best or size[v] > size[best]:
            heavy[link[v]] = v
    head = list(range(len(link)))
    for v in order[1:]:
        if heavy[link[v]] == v:
            head[v] = head[link[v]]
    return head


def all_runs(ids: list[int]) -> dict[tuple[int, int], int]:
    """Last word of each run of ``ids``, of any length, by its start and period."""
    link, length, prefix = automaton(ids)
    head = heavy_heads(link, length)
    # Of each heavy path: (length of the lowest state, last end), the topmost segment last.
    segments: dict[int, list[tuple[int, int]]] = {}
    found: dict[tuple[int, int], int] = {}
    for i, v in enumerate(prefix):
        path: list[tuple[int, int]] = []
        while v > 0:
            depth = length[v]
            stack = segments.setdefault(head[v], [])
            here = []
            while stack and stack[-1][0] <= depth:
                here.append(stack.pop())
            if stack and not (here and here[-1][0] == depth):
                here.append((depth, stack[-1][1]))
            here.reverse()
            path += here
            stack.append((depth, i))
            v = link[head[v]]
        at, n = 0, len(path)
        while at < n:
            deepest, p = path[at]
            at += 1
            while at < n and path[at][1] == p:
                at += 1
            if (path[at][0] if at < n else 0) < i - p <= deepest:
                found[p - deepest + 1, i - p] = i
    return found


def runs_of(words: list[bytes], shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of at least ``shortest`` words, by start, then period."""
    if len(words) < shortest:
        return []
    ids = word_ids(words)
    out = []
    for a, b in stretches(ids, shortest):
        for (start, period), end in all_runs(ids[a:b].tolist()).items():
            if end - start + 1 >= shortest:
                out.append((a + start, end - start + 1, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that any run holds after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def _find(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, left = [], []
            for text in texts(batch.column(1)):
                words = text.split()
                runs = runs_of(words, shortest)
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                left.append(b" ".join(collapsed(words, runs)))
            kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind), pa.array(left, pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Rows (doc_id, runs, collapsed), one for each row of ``docs`` (doc_id, text).

    Words are what blanks, tabs, line ends, vertical tabs and form feeds part.
    ``runs`` holds every run (start, length, period) of at least ``shortest`` words
    and twice its period, by start, then period; ``collapsed`` the words outside
    the repeats, parted by one blank. Null and empty texts have no runs and an
    empty ``collapsed``; repeated rows give a row each; other columns are not
    looked at. A text is held by one task, with about 600 bytes for each word of
    its longest repetitive stretch.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _find(shortest), f"doc_id {kind}, runs {_RUNS}, collapsed string")


def with_planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the tails of a tenth of the texts made periodic.

    With h = crc32 of the decimal doc_id, texts with h % 10 = 0 keep their words up
    to a = g % n and repeat the next p words from there, where n is the number of
    words, g = h div 10 and p = 1 + (n - a) div (3 + g % 8). Their words are then
    parted by one blank. A null id or text stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size("words")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))

    def planted(word: Column, i: Column) -> Column:
        return F.when(i < a, word).otherwise(F.get("words", a + (i - a) % p))

    hit = F.col("words").isNotNull() & (n > 0)
    return (
        docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"))
        .select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"),
                F.when(F.col("h") % 10 == 0, words).alias("words"))
        .select("doc_id", F.when(hit, F.array_join(F.transform("words", planted), " "))
                .otherwise(F.col("text")).alias("text"))
    )


def report(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Number of runs, the longest one and digests for each row of ``docs``."""
    runs = periodic_runs(docs, shortest)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return runs.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256)
        .alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
