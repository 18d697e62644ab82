"""SentencePiece encoding and decoding by a max-plus scan.

Encoding finds the segmentation into pieces with the highest sum of scores. A
document longer than ``CHUNK`` is split into chunks. A chunk's state at a
boundary is how far the piece that crosses it reaches over; its transfer matrix
holds the best score from every state at its start to every state at its end.
Matrices are combined in the max-plus semiring, which is associative: within
blocks of chunks, over the blocks of a document, then back within the blocks.
That fixes the states at every boundary, and each chunk is traced back alone.

Where the vocabulary has no piece over the start of a word, the states there
fall into one, and the words between are looked up in a cache.

Pieces and scores are those of the model file, used as a unigram lattice (the
model type that has a max-plus form); a character without a piece is spelled in
byte pieces. Ties go to the longest last piece.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import staged

CHUNK = 16_384
BLOCK = 64
MARK = "▁"
STOPS = ".,;:!?)\"'»”…"
ENCODED = "doc_id long, ids array<int>, score double"
#: Words of the younger half of the cache; the older half is as large.
_CACHE_WORDS = 150_000
#: Texts or chunks that a task turns into Python objects at a time.
_ROWS = 256
_NONE = float("-inf")


def _in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), _ROWS):
            yield batch.slice(at, _ROWS)


class Lattice(dict):
    """Pieces of a model file; as a dict, the best ids and score of whole words.

    When the cache is full it becomes the older half, from which words that
    come again are taken over, so that frequent words stay.
    """

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.piece = {
            model.id_to_piece(i): (model.get_score(i), i) for i in ids if i not in special and not model.is_byte(i)}
        #: Pieces by their characters: to each one what may follow it, and the score if a piece ends there.
        self.trie: dict[str, tuple[dict, float | None]] = {}
        for p in sorted(self.piece):
            node = self.trie
            for k, ch in enumerate(p, 1):
                if ch not in node:
                    node[ch] = {}, self.piece.get(p[:k], (None,))[0]
                node = node[ch][0]
        self.older: dict[str, tuple[bytes, float]] = {}
        self.longest = max(map(len, self.piece))
        self.unknown = min(s for s, _ in self.piece.values()) - 10.0
        #: No piece runs over the start of a word.
        self.parted = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.piece)
        #: Nor over a line break, if none is in a piece.
        self.lines = not any("\n" in p for p in self.piece)
        # A word may also be parted before a mark, after a letter or digit that no piece has right before that mark.
        line = "\n" if self.lines else ""
        plain = f"[^{MARK}{line}{re.escape(STOPS)}]*"
        joined = [rf"(?<![^\W_])[{re.escape(STOPS)}]"]
        for mark in STOPS:
            before = {x for p in self.piece for x in re.findall(rf"[^\W_](?={re.escape(mark)})", p)}
            if before:
                joined.append(f"(?<=[{re.escape(''.join(sorted(before)))}]){re.escape(mark)}")
        rest = f"{plain}(?:(?:{'|'.join(joined)}){plain})*"
        self.words = re.compile(f"{MARK}+{rest}|[^{MARK}{line}]{rest}" + ("|\n" if self.lines else ""))
        self.cut = re.compile(f"(?<!{MARK})(?={MARK})" + (r"|(?=\n)|(?<=\n)" if self.lines else ""))

    def forward(self, text: str, start: int, until: int) -> tuple[list[float], list[int]]:
        """Best score and last start at every place reached by pieces that start before ``until``."""
        trie, piece, longest = self.trie, self.piece, self.longest
        size = len(text)
        best = [_NONE] * (min(until + longest, size) + 1)
        last = [-1] * len(best)
        best[start] = 0.0
        for at in range(start, until):
            score = best[at]
            if score == _NONE:
                continue
            following, end = trie, at
            for ch in text[at : at + longest]:
                found = following.get(ch)
                if found is None:
                    break
                following, gain = found
                end += 1
                if gain is not None and score + gain > best[end]:
                    best[end], last[end] = score + gain, at
            if text[at] not in piece and score + self.unknown > best[at + 1]:
                best[at + 1], last[at + 1] = score + self.unknown, at
        return best, last

    def trace(self, text: str, start: int, end: int, last: list[int]) -> list[int]:
        """Ids of the pieces on the way from ``start`` to ``end``."""
        out: list[int] = []
        while end > start:
            begin = last[end]
            found = self.piece.get(text[begin:end])
            out += [found[1]] if found else [self.byte_ids[b] for b in reversed(text[begin:end].encode())]
            end = begin
        return out[::-1]

    def __missing__(self, word: str) -> tuple[bytes, float]:
        if len(self) > _CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        value = self.older.get(word)
        if value is None:
            best, last = self.forward(word, 0, len(word))
            ids = self.trace(word, 0, len(word), last)
            value = struct.pack(f"<{len(ids)}i", *ids), best[len(word)]
        self[word] = value
        return value

    def cuts(self, text: str, length: int) -> tuple[int, int] | None:
        """First and last place within ``text[:length]`` that no piece runs over, if there is one."""
        first = self.cut.search(text, 1, length) if self.parted and length > 1 else None
        # A place at the very end of the range is none within it.
        if first is None or first.start() >= length:
            return None
        last = length - 1
        while not self.cut.match(text, last):
            last -= 1
        return first.start(), last

    def whole(self, text: str) -> tuple[bytes, float]:
        """Ids and score of a whole text."""
        if not self.parted:
            return self.__missing__(text)
        found = [self[w] for w in self.words.findall(text)]
        return b"".join(f[0] for f in found), sum(f[1] for f in found)

    def transfer(self, text: str, length: int) -> np.ndarray:
        """Transfer matrix of the chunk ``text[:length]``; the rest of ``text`` is looked ahead."""
        return self.scanned(text, length)[0]

    def scanned(self, text: str, length: int) -> tuple[np.ndarray, int, int, bytes]:
        """Transfer matrix of the chunk ``text[:length]``.

        With it the chunk's first and last cut (-1 if it has none) and the ids between
        them, which hold whatever the states at its ends.
        """
        states = self.longest
        cuts = self.cuts(text, length)
        out = np.full((states, states), _NONE)
        if not cuts:
            for i in range(min(states, length + 1)):
                best, _ = self.forward(text, i, length)
                reach = best[length : length + states]
                out[i, : len(reach)] = reach
            # A piece may also run over the whole of a short chunk.
            for i in range(length + 1, states):
                out[i, i - length] = 0.0
            return out, -1, -1, b""
        first, tail = cuts
        head = [self.forward(text[:first], i, first)[0][first] for i in range(min(states, first + 1))]
        ids, middle = self.whole(text[first:tail]) if tail > first else (b"", 0.0)
        best, _ = self.forward(text[tail:], 0, length - tail)
        reach = best[length - tail : length - tail + states]
        out[: len(head), : len(reach)] = np.array(head)[:, None] + middle + np.array(reach)[None, :]
        return out, first, tail, ids

    def between(self, head: str, middle: bytes, rest: str, first: int, tail: int, length: int, entry: int, exit_: int) -> bytes:
        """Ids of the chunk's pieces, given the states at its ends.

        ``head`` is the text up to the first cut and ``rest`` that from the last one
        on; without cuts ``head`` is the whole. No piece runs over a cut, so the
        entry lies before the first.
        """
        def ids(text: str, start: int, until: int, end: int) -> bytes:
            if start >= end:
                return b""
            _, last = self.forward(text, start, until)
            return np.array(self.trace(text, start, end, last), "<i4").tobytes()

        end = length + exit_
        if first < 0:
            return ids(head, entry, min(length, end), end)
        return ids(head, entry, first, first) + middle + ids(rest, 0, min(length, end) - tail, end - tail)


_LATTICES: dict[str, Lattice] = {}


def lattice(model_file: str) -> Lattice:
    """One per Python worker."""
    if model_file not in _LATTICES:
        _LATTICES[model_file] = Lattice(model_file)
    return _LATTICES[model_file]


_SPELLED: dict[str, list[bytes]] = {}


def spelled(model_file: str) -> list[bytes]:
    """Bytes of every id. Tasks that only decode hold these alone, not the pieces by their characters."""
    if model_file not in _SPELLED:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)

        def spell(i: int) -> bytes:
            if model.is_byte(i):
                return bytes([int(model.id_to_piece(i)[3:5], 16)])
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                return b""
            return model.id_to_piece(i).replace(MARK, " ").encode()

        _SPELLED[model_file] = [spell(i) for i in range(model.get_piece_size())]
    return _SPELLED[model_file]


def normalized(text: str | None) -> str:
    """A space before the text, and every space as the mark; an empty text stays empty."""
    return MARK + text.replace(" ", MARK) if text else ""


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _id_lists(parts: list[bytes]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(p) // 4 for p in parts])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


@dataclass(frozen=True)
class Scan:
    model_file: str
    chunk: int = CHUNK
    block: int = BLOCK

    def short(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(self.model_file)
        for batch in _in_turn(batches):
            found = [own.whole(normalized(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _id_lists([f[0] for f in found]), pa.array([float(f[1]) for f in found], pa.float64())],
                ["doc_id", "ids", "score"])

    def split(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of long texts, each with what its last pieces may run over."""
        more = lattice(self.model_file).longest - 1
        for batch in batches:
            for key, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = normalized(text)
                starts = range(0, len(text), self.chunk)
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * len(starts), pa.int64()), pa.array([doc] * len(starts), pa.int64()),
                    pa.array(range(len(starts)), pa.int32()),
                    pa.array([min(self.chunk, len(text) - s) for s in starts], pa.int32()),
                    pa.array([text[s : s + self.chunk + more] for s in starts], pa.string())],
                    ["key", "doc_id", "chunk", "length", "text"])

    def matrices(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(self.model_file)
        for batch in _in_turn(batches):
            length, text = (c.to_pylist() for c in batch.columns[3:])
            found = [own.scanned(t, n) for t, n in zip(text, length)]
            parts = [(t, "") if first < 0 else (t[:first], t[tail:]) for t, (_, first, tail, _) in zip(text, found)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([f[0].tobytes() for f in found], pa.binary()),
                 pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.int32()),
                 pa.array([f[3] for f in found], pa.binary()),
                 pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.string())],
                ["key", "doc_id", "chunk", "length", "matrix", "first", "tail", "middle", "head", "rest"])

    def _read(self, table: pa.Table, order: str) -> tuple[list[int], list[np.ndarray]]:
        states = lattice(self.model_file).longest
        table = table.sort_by(order)
        return table[order].to_pylist(), [
            np.frombuffer(m, np.float64).reshape(states, states) for m in table["matrix"].to_pylist()]

    def block_product(self, table: pa.Table) -> pa.Table:
        _, found = self._read(table, "chunk")
        product = found[0]
        for m in found[1:]:
            product = times(product, m)
        return pa.table({
            "key": table["key"][:1], "block": table["block"][:1], "matrix": pa.array([product.tobytes()], pa.binary())})

    @staticmethod
    def states(found: list[np.ndarray], entry: int, exit_: int) -> list[int]:
        """The best states at all boundaries of a row of chunks with fixed ends."""
        score = np.full(len(found[0]), _NONE)
        score[entry] = 0.0
        came = []
        for m in found:
            way = score[:, None] + m
            came.append(way.argmax(axis=0))
            score = way.max(axis=0)
        out = [exit_]
        for back in reversed(came):
            out.append(int(back[out[-1]]))
        return out[::-1]

    def block_states(self, table: pa.Table) -> pa.Table:
        numbers, found = self._read(table, "block")
        at = self.states(found, 0, 0)
        product = found[0]
        for m in found[1:]:
            product = times(product, m)
        n = len(numbers)
        return pa.table({
            "key": pa.array([table["key"][0].as_py()] * n, pa.int64()), "block": pa.array(numbers, pa.int32()),
            "entry": pa.array(at[:-1], pa.int32()), "exit": pa.array(at[1:], pa.int32()),
            "score": pa.array([float(product[0, 0])] * n, pa.float64())})

    def chunk_states(self, table: pa.Table) -> pa.Table:
        numbers, found = self._read(table, "chunk")
        at = self.states(found, table["entry"][0].as_py(), table["exit"][0].as_py())
        n = len(numbers)
        return pa.table({
            "key": pa.array([table["key"][0].as_py()] * n, pa.int64()), "chunk": pa.array(numbers, pa.int32()),
            "entry": pa.array(at[:-1], pa.int32()), "exit": pa.array(at[1:], pa.int32()),
            "score": pa.array([table["score"][0].as_py()] * n, pa.float64())})

    def traced(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(self.model_file)
        for batch in _in_turn(batches):
            found = [own.between(*row) for row in zip(*(c.to_pylist() for c in batch.columns[4:]))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], _id_lists(found)], ["key", "doc_id", "chunk", "score", "ids"])


def encode(docs: DataFrame, model_file: str, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """Piece ids of every row of ``docs`` (doc_id, text): doc_id, ids, score.

    Null and empty texts have no ids and score 0; null ids and repeated rows are
    encoded each; other columns are ignored; an empty table gives no rows. The
    mark in a text counts as a space, as in the model's own normalization.
    """
    scan = Scan(model_file, chunk, block)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.length("text") >= chunk, F.lit(False))
    short = base.where(~long).mapInArrow(scan.short, ENCODED)
    # The key names a row only within the table that is written here.
    chunks = staged(
        base.where(long).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
        .mapInArrow(scan.split, "key long, doc_id long, chunk int, length int, text string")
        .repartition("key", "chunk")
        .mapInArrow(scan.matrices, "key long, doc_id long, chunk int, length int, matrix binary, first int, tail int,"
                                   " middle binary, head string, rest string"))
    in_block = F.floor(F.col("chunk") / block).cast("int").alias("block")
    matrices = chunks.select("key", "chunk", "matrix", in_block)
    # A text is less than 2 ** 31 characters long: its blocks are few.
    blocks = matrices.groupBy("key", "block").applyInArrow(
        lambda t: scan.block_product(t), "key long, block int, matrix binary").groupBy("key").applyInArrow(
        lambda t: scan.block_states(t), "key long, block int, entry int, exit int, score double")
    states = matrices.join(blocks, ["key", "block"]).groupBy("key", "block").applyInArrow(
        lambda t: scan.chunk_states(t), "key long, chunk int, entry int, exit int, score double")
    traced = chunks.join(states, ["key", "chunk"]).select(
        "key", "doc_id", "chunk", "score", "head", "middle", "rest", "first", "tail", "length", "entry", "exit").mapInArrow(
        scan.traced, "key long, doc_id long, chunk int, score double, ids array<int>")
    whole = traced.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.max("score").alias("score"),
        F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    return short.union(whole.select(
        "doc_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), "score"))


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """Texts of ``encoded`` (doc_id, ids): doc_id, text; null ids as none, unknown ids as nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = spelled(model_file)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                raw = b"".join([by_id[i] for i in ids or () if i is not None and 0 <= i < len(by_id)])
                texts.append((raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(encoded: DataFrame, model_file: str) -> DataFrame:
    """Per row of ``encoded``: n_tokens, ids_crc32, score, and n_chars and text_crc32 of the decoded text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = spelled(model_file)
        for batch in batches:
            rows = []
            for ids in batch.column(1):
                ids = ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int32)
                raw = b"".join([by_id[i] for i in ids.tolist()])
                text = raw[1:] if raw.startswith(b" ") else raw
                rows.append((len(ids), zlib.crc32(ids.astype("<u4")), len(text.decode("utf-8", "replace")), zlib.crc32(text)))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:2]), batch.column(2),
                 *(pa.array(c, pa.int64()) for c in columns[2:])],
                ["doc_id", "n_tokens", "ids_crc32", "score", "n_chars", "text_crc32"])

    return encoded.select("doc_id", "ids", "score").mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, score double, n_chars long, text_crc32 long")
