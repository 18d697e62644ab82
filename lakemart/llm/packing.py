"""Vector bin packing of examples into training sequences by the dot-product heuristic.

Every sequence has three limits: tokens, segments and loss-bearing tokens. The
open sequence takes the example whose demand vector has the largest dot product
with what is left of the three limits, each dimension weighted by its mean
demand, until nothing fits. ``pack_documents`` may cut: when nothing fits it
fills the gap with the front part of the longest example.

Packing runs inside the tasks that read the rows, over a window of a bounded
number of tokens; what stays in an unfinished sequence moves on to the next
window. No row is shuffled. ``sequence_id`` is the task's partition number
shifted by 33 bits plus a counter, so a repeated task gives the same ids.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long"
)
PLACED = "example_id long, n_tokens long, n_loss long, sequence_id long, offset long, segment int"
END_ID = 1
WINDOW_TOKENS = 2_000_000
WINDOW_ITEMS = 3_000
_CACHE_WORDS = 600_000


class WordIds(dict):
    """Token ids of a word with its leading space, as little-endian 16-bit bytes.

    Byte-level BPE never merges across the start of `` word``, so texts whose
    spaces stand alone are encoded word by word; others are encoded whole.
    """

    def __init__(self, tokenizer_json: str, ranks: str):
        from tokenizers import Tokenizer
        import public_tokenizers
        import re
        import tiktoken

        self.whole = Tokenizer.from_file(tokenizer_json)
        pairs = (line.split() for line in open(ranks, "rb"))
        table = {base64.b64decode(a): int(b) for a, b in pairs}
        self.fast = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.uneven = re.compile(r" \s|\s ").search

    def __missing__(self, word: str) -> bytes:
        if len(self) > _CACHE_WORDS:
            self.clear()
        ids = np.array(self.fast.encode_ordinary(" " + word), "<u2").tobytes()
        self[word] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        """The ids that ``tokenizers`` gives for ``text``, then the end id."""
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids + [END_ID], "<u2")
        if self.uneven(text):
            return np.array(self.fast.encode_ordinary(text) + [END_ID], "<u2")
        words = text.split(" ")
        first = np.array(self.fast.encode_ordinary(words[0]), "<u2").tobytes()
        rest = b"".join(map(self.__getitem__, words[1:]))
        return np.frombuffer(first + rest + END_ID.to_bytes(2, "little"), "<u2")


_WORDS: dict[tuple[str, str], WordIds] = {}


def word_ids(tokenizer_json: str, ranks: str) -> WordIds:
    """One cache per Python worker."""
    key = (tokenizer_json, ranks)
    if key not in _WORDS:
        _WORDS[key] = WordIds(*key)
    return _WORDS[key]


class Bins:
    """Dot-product packing of a pool of demands under three limits."""

    def __init__(self, limits: tuple[int, int, int], cut: bool):
        self.limits = np.array(limits, np.float64)
        self.cut = cut

    def fill(self, demand: np.ndarray, last: bool) -> tuple[list[list[tuple[int, int, int]]], list]:
        """Sequences of (item, start, tokens), and items left for the next window.

        ``demand``: rows of tokens, segments, loss-bearing tokens; every row
        fits an empty sequence. Only the sequence open when the pool runs dry
        is handed back, unless ``last``.
        """
        demand = demand.astype(np.float64)
        starts = np.zeros(len(demand), np.int64)
        alive = np.ones(len(demand), bool)
        left = len(demand)
        share = demand / self.limits
        weight = share.mean(axis=0) if left else np.ones(3)
        done, over = [], []
        while left:
            room, members = self.limits.copy(), []
            while left:
                fits = alive & (demand <= room).all(axis=1)
                score = np.where(fits, share @ (weight * room / self.limits), -1.0)
                best = int(score.argmax())
                if not fits[best]:
                    break
                members.append((best, int(starts[best]), int(demand[best, 0])))
                room -= demand[best]
                alive[best] = False
                left -= 1
            size = int(min(room[0], room[2]))
            if self.cut and left and size > 0 and room[1] > 0:
                longest = int(np.where(alive, demand[:, 0], -1.0).argmax())
                members.append((longest, int(starts[longest]), size))
                starts[longest] += size
                demand[longest, 0] -= size
                demand[longest, 2] = min(demand[longest, 2], demand[longest, 0])
                share[longest] = demand[longest] / self.limits
                room[0] -= size
            if left or last or room[0] <= 0:
                done.append(members)
            else:
                over = members
        return done, over


def _document_pieces(window_tokens: int, limits: tuple[int, int, int], files: tuple[str, str]):
    capacity = min(limits[0], limits[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(*files)
        base, count = TaskContext.get().partitionId() << 33, 0
        bins = Bins(limits, cut=True)
        out: list[tuple] = []
        pool: list[list] = []  # doc id, ids, start, end
        held = 0

        def emit(members: list[tuple[int, int, int]], items: list[list]) -> None:
            nonlocal count
            offset = 0
            for item, skip, size in members:
                doc, ids, start, _ = items[item]
                part = ids[start + skip:start + skip + size].astype("<u4")
                out.append((doc, start + skip, size, zlib.crc32(part), len(ids), base + count, offset))
                offset += size
            count += 1

        def pack(last: bool) -> None:
            nonlocal pool, held
            demand = np.array([(e - s, 1, e - s) for _, _, s, e in pool], np.int64).reshape(-1, 3)
            done, over = bins.fill(demand, last=False)
            for members in done:
                emit(members, pool)
            rest = [[pool[i][0], pool[i][1], pool[i][2] + s, pool[i][2] + s + n] for i, s, n in over]
            if last:
                _powers(rest, emit)
                rest = []
            pool, held = rest, sum(e - s for _, _, s, e in rest)

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            out.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.ids(text or "")
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    emit([(0, 0, capacity)], [[doc, ids, start, start + capacity]])
                if whole < len(ids):
                    pool.append([doc, ids, whole, len(ids)])
                    held += len(ids) - whole
                if held >= window_tokens or len(pool) >= WINDOW_ITEMS:
                    pack(last=False)
            if len(out) > 20_000:
                yield flush()
        pack(last=True)
        yield flush()

    return run


def _powers(rest: list[list], emit) -> None:
    """Close what is left as sequences whose sizes are powers of two: no padding."""
    total = sum(e - s for _, _, s, e in rest)
    k = 0
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        members = []
        while size:
            doc, ids, start, end = rest[k]
            take = min(size, end - start)
            members.append((k, 0, take))
            size -= take
            if take == end - start:
                k += 1
            else:  # the sequence ends inside this item
                rest.append([doc, ids, start + take, end])
        emit(members, rest)
        if members and members[-1][2] < rest[members[-1][0]][3] - rest[members[-1][0]][2]:
            rest[k] = rest.pop()


def pack_documents(
    docs: DataFrame,
    tokenizer_json: str,
    ranks: str,
    max_tokens: int = 2048,
    max_segments: int = 512,
    max_loss: int = 2048,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) and pack them, cutting where it fills a gap.

    Null and empty texts are the end id alone; repeated rows are packed once
    each; a null doc_id is kept; other columns are ignored; an empty table gives
    no rows. Each token bears loss. Per piece: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _document_pieces(window_tokens, (max_tokens, max_segments, max_loss), (tokenizer_json, ranks)),
        PIECES,
    )


def pack_examples(
    examples: DataFrame, max_tokens: int, max_segments: int, max_loss: int,
    window_items: int = WINDOW_ITEMS,
) -> DataFrame:
    """Pack whole ``examples`` (example_id, n_tokens, n_loss) without cutting.

    Null counts are 0. An example over a limit by itself gets a sequence of its
    own. Per example: its counts, sequence_id, offset and place in the sequence.
    """
    limits = (max_tokens, max_segments, max_loss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 33, 0
        bins, pool, out = Bins(limits, cut=False), [], []

        def emit(members: list[tuple]) -> None:
            nonlocal count
            offset = 0
            for place, (key, tokens, loss) in enumerate(members):
                out.append((key, tokens, loss, base + count, offset, place))
                offset += tokens
            count += 1

        def pack(last: bool) -> None:
            nonlocal pool
            demand = np.array([(t, 1, n) for _, t, n in pool], np.int64).reshape(-1, 3)
            done, over = bins.fill(demand, last)
            for members in done:
                emit([pool[i] for i, _, _ in members])
            pool = [pool[i] for i, _, _ in over]

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.int32()]
            names = [c.split()[0] for c in PLACED.split(",")]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names)
            out.clear()
            return batch

        for batch in batches:
            for key, tokens, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if tokens > max_tokens or loss > max_loss:
                    emit([(key, tokens, loss)])
                    continue
                pool.append((key, tokens, loss))
                if len(pool) >= window_items:
                    pack(last=False)
            if len(out) > 20_000:
                yield flush()
        pack(last=True)
        yield flush()

    count = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("n_tokens", "n_loss")]
    return examples.select(F.col("example_id").cast("long"), *count).mapInArrow(run, PLACED)
