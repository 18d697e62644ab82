"""Benchmark passages in documents, by a generalised suffix automaton of the test items.

All runs of words of the items are states of one automaton. A document is
streamed through it word by word; the state holds the longest run of item words
that ends at the present word. Where that run is as long as a window, its words
are hit, and the state's suffix of window length tells the items that have it.

Items are cut into overlapping pieces of bounded length (no window is lost) and
dealt into shards of bounded size; a shard's automaton is built by one task,
kept in the shared folder and sent to the tasks that read the documents. There
is no shuffle of documents, so hot sources or copies cost nothing beyond their
own reading. More shards mean more passes, each staged.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import staged
from lakemart.llm.terms import PATTERN, terms_of, texts

WINDOW = 10
#: Item words of one automaton (about 300 bytes each in a worker) and of one piece of an item.
SHARD_WORDS, PIECE_WORDS = 500_000, 4096

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPANS = "array<struct<start:bigint,end:bigint>>"
_FOUND = f"doc_id {{id}}, text string, n_words long, spans {_SPANS}, items array<string>"


class ItemAutomaton:
    """Generalised suffix automaton of the items' words, with the items of every window.

    ``owners`` lists the items of a state that stands for a run of ``window``
    words, ``short`` the lengths and items of whole items that are shorter.
    """

    def __init__(self, pieces: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.link, self.length = [-1], [0]
        self.next: dict[int, int] = {}
        for _, words in pieces:
            for w in words:
                self.words.setdefault(w, len(self.words))
        self.size = max(1, len(self.words))
        out: list[list[int]] = [[]]
        for _, words in pieces:
            last = 0
            for w in words:
                last = self._append(last, self.words[w], out)
        self._mark(pieces)

    def _append(self, last: int, w: int, out: list[list[int]]) -> int:
        """State of the piece so far and word ``w`` after it; ``out`` has the words that leave each state."""
        size, edges, link, length = self.size, self.next, self.link, self.length
        there = edges.get(last * size + w)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._split(last, w, there, out)
        new, at = len(link), last
        link.append(0)
        length.append(length[last] + 1)
        out.append([])
        while at >= 0 and at * size + w not in edges:
            edges[at * size + w] = new
            out[at].append(w)
            at = link[at]
        if at >= 0:
            there = edges[at * size + w]
            link[new] = there if length[there] == length[at] + 1 else self._split(at, w, there, out)
        return new

    def _split(self, at: int, w: int, there: int, out: list[list[int]]) -> int:
        """A state of its own for the shorter runs of ``there``, which ``at`` and its suffixes lead to."""
        size, edges, link, length = self.size, self.next, self.link, self.length
        copy = len(link)
        link.append(link[there])
        length.append(length[at] + 1)
        out.append(list(out[there]))
        for x in out[there]:
            edges[copy * size + x] = edges[there * size + x]
        while at >= 0 and edges.get(at * size + w) == there:
            edges[at * size + w] = copy
            at = link[at]
        link[there] = copy
        return copy

    def _mark(self, pieces: list[tuple[str | None, list[bytes]]]) -> None:
        k, link, length = self.window, self.link, self.length
        self.run = [0] * len(link)
        for v in np.argsort(length, kind="stable").tolist():
            if length[v] >= k:
                self.run[v] = v if length[link[v]] < k else self.run[link[v]]
        owners: dict[int, set] = {}
        short: dict[int, set] = {}
        for item, words in pieces:
            v = 0
            for n, w in enumerate(words, 1):
                v = self.next[v * self.size + self.words[w]]
                if n >= k:
                    owners.setdefault(self.run[v], set()).add(item)
            if 0 < len(words) < k:
                short.setdefault(v, set()).add((len(words), item))
        self.owners = {v: [x for x in found if x is not None] for v, found in owners.items()}
        self.short = {v: sorted(found, key=lambda x: x[0]) for v, found in short.items()}
        #: Nearest state on the way to the root, the state itself included, that is a whole short item.
        self.near = [-1] * len(link)
        if short:
            for v in np.argsort(length, kind="stable").tolist()[1:]:
                self.near[v] = v if v in short else self.near[link[v]]
        self.least = min([k, *(n for found in self.short.values() for n, _ in found)])

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Stretches of hit words as (start, end), and the items that have a window in ``words``."""
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        known = np.concatenate([[False], ids >= 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1]).reshape(-1, 2)
        runs: set[int] = set()
        items: set[str] = set()
        spans: list[tuple[int, int]] = []
        for start, end in edges[edges[:, 1] - edges[:, 0] >= self.least].tolist():
            self._stream(ids[start:end].tolist(), start, spans, runs, items)
        for run in runs:
            items.update(self.owners[run])
        return spans, items

    def _stream(self, ids: list[int], at: int, spans: list, runs: set[int], items: set[str]) -> None:
        get, link, length, size = self.next.get, self.link, self.length, self.size
        k, run, near = self.window, self.run, self.near if self.short else None
        v = n = 0
        for at, w in enumerate(ids, at + 1):
            to = get(v * size + w)
            while to is None and v:
                v = link[v]
                n = length[v]
                to = get(v * size + w)
            if to is None:
                n = 0
                continue
            v = to
            n += 1
            hit = 0
            if n >= k:
                hit = k
                runs.add(run[v])
            if near:
                s = near[v]
                while s > 0:
                    for words, item in self.short[s]:
                        if words <= n:
                            hit = max(hit, words)
                            if item is not None:
                                items.add(item)
                    s = near[link[s]]
            if hit:
                start = at - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, at))


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str | None, bytes, int]] = []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                words = terms_of(text)
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS) if words else ():
                    piece = words[at : at + PIECE_WORDS + window - 1]
                    out.append((item, b" ".join(piece), len(piece)))
            item, text, n = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.string()), pa.array(text, pa.binary()), pa.array(n, pa.int64())],
                ["item", "words", "n"])

    return run


def automata(items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows (shard, automaton): the items' automata, pickled, in the shared folder."""
    pieces = staged(
        items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
        .mapInArrow(_cut(window), "item string, words binary, n long"))
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_words))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(group["item"], group["words"]), key=lambda x: (x[0] is None, x[0] or "", x[1]))
        made = ItemAutomaton([(item, bytes(words).split()) for item, words in rows], window)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "automaton": [pickle.dumps(made, 5)]})

    return staged(
        pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)))
        .groupBy("shard").applyInPandas(build, "shard long, automaton binary"))


def _scan(shared, first: bool, keep_text: bool):
    cache: list[ItemAutomaton] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            cache.append(pickle.loads(shared.value))
        for batch in batches:
            counts, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            for text, (old, named) in zip(texts(batch.column("text")), before):
                words = terms_of(text)
                hit, found = cache[0].scan(words)
                if not first:
                    hit = _merged([*((s["start"], s["end"]) for s in old), *hit])
                    found.update(named)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in hit])
                items.append(sorted(found))
            text = batch.column("text") if keep_text else pa.nulls(len(counts), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), text, pa.array(counts, pa.int64()),
                 pa.array(spans, batch.schema.field("spans").type), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "spans", "items"])

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    keep_text: bool = False,
) -> DataFrame:
    """Rows (doc_id, text, n_words, spans, items), one for each row of ``docs``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are
    not looked at. Words: ``terms_of``. A window is a run of ``window`` words of
    an item; an item of fewer words, but not none, is one window as a whole.
    ``spans`` are the stretches of words (start, end, from 0, end excluded) inside
    any occurrence of a window, in order and not touching; ``items`` the ids of the
    items with such windows, as text, in order of their code points. ``text`` is
    null unless ``keep_text``.

    A null text has no words; a null item text no window. Items without an id hit
    words but are not listed. Rows that share an item_id are listed once; repeated
    rows of ``docs`` give a row each. Without items every document is clean.
    Runs over any number of words, also of single texts of any length.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    found = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = _FOUND.format(id=kind.simpleString())
    made = automata(items, window, shard_words)
    shards = [r.shard for r in made.select("shard").orderBy("shard").collect()]
    for i, shard in enumerate(shards or [None]):
        # One automaton of bounded size at a time passes through the driver.
        if shard is None:
            blob = pickle.dumps(ItemAutomaton([], window), 5)
        else:
            blob = bytes(made.where(F.col("shard") == shard).select("automaton").first()[0])
        last = i + 1 >= len(shards)
        found = found.mapInArrow(
            _scan(spark.sparkContext.broadcast(blob), i == 0, keep_text or not last), schema)
        if not last:
            found = staged(found)
    return found


def _without(max_words: int, max_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, n, spans in zip(
                texts(batch.column("text")), batch.column("n_words").to_pylist(),
                batch.column("spans").to_pylist(),
            ):
                hit = sum(s["end"] - s["start"] for s in spans)
                out.append(None if n and hit > max_share * n else removed(
                    text, [(s["start"], s["end"]) for s in spans if s["end"] - s["start"] > max_words]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"]
            ).filter(pa.array([t is not None for t in out], pa.bool_()))

    return run


def removed(text: bytes, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans``; what stands between words stays with the word before."""
    if not spans:
        return text.decode()
    starts = [m.start() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : starts[start]])
        at = starts[end] if end < len(starts) else len(text)
    out.append(text[at:])
    return b"".join(out).decode()


def clean(
    docs: DataFrame, items: DataFrame, max_words: int = 0, max_share: float = 0.5, window: int = WINDOW
) -> DataFrame:
    """Rows (doc_id, text) of ``docs`` without benchmark passages.

    Stretches of more than ``max_words`` hit words are taken out; a document of
    which more than the share ``max_share`` is hit goes as a whole. Null texts
    come back empty, all else as in ``matches``.
    """
    found = matches(docs, items, window, keep_text=True).select("doc_id", "text", "n_words", "spans")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string"
    return found.mapInArrow(_without(max_words, max_share), schema)


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row of counts and a digest of the items for each row of ``docs``."""
    return matches(docs, items, window).select(
        "doc_id", "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def oracle(window: int = WINDOW) -> str:
    """The report in DuckDB's SQL, by joining runs of words."""
    fold = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({fold}, '{PATTERN}') AS words FROM documents),
i AS (
  SELECT item_id::VARCHAR AS item, words, least(len(words), {window}) AS k
  FROM (SELECT item_id, regexp_extract_all({fold}, '{PATTERN}') AS words FROM benchmark) WHERE len(words) > 0),
w AS (
  SELECT DISTINCT item, k, array_to_string(words[p : p + k - 1], ' ') AS gram
  FROM (SELECT item, words, k, unnest(range(1, len(words) - k + 2)) AS p FROM i)),
ten AS (
  SELECT rid, p, list(word) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING) AS part
  FROM (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d)),
g AS (
  SELECT rid, p, k, array_to_string(part[1 : k], ' ') AS gram
  FROM ten CROSS JOIN (SELECT DISTINCT k FROM w) WHERE len(part) >= k),
h AS (SELECT rid, p, k, gram FROM g WHERE gram IN (SELECT gram FROM w)),
hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + k)) AS q FROM h) GROUP BY rid),
named AS (
  SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM h JOIN w USING (gram) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""
