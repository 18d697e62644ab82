"""Language-model scores by prediction by partial matching over bytes.

Pretrained byte contexts predict every byte of a document. The text that is
predicted is the token sequence: each word and the space that ends it, at last a
line feed for the end. The longest context is the word so far where that has
``LONG`` bytes or more (up to ``DEPTH``), else the last ``LONG`` bytes of the
sequence, whatever words they belong to. Below these are the last five and four
bytes, the last three by 32 classes (letters, space, kinds of others), two, one,
none, and at last all bytes alike; the word so far goes on with the last three. A
context leaves an escape probability to the next shorter one, estimated from all
contexts of its order with about as many occurrences N and different symbols D
by leaving one occurrence out, and shares the rest among its symbols by n - 1/2.
Symbols that a longer context ruled out are excluded from the shorter ones;
these count every edge of the next longer ones once (update exclusion). The code
lengths of a document's bytes add up to its score.

Documents are dealt out to chunks. The first pass counts each chunk's words and
its grams: ``LONG`` bytes of the sequence and the one after them. The
corpus vocabulary is dealt out by its first bytes; sorted, each part is a
subtrie whose levels are runs of rows. The grams are dealt out by the four bytes
before their last one, so that a bucket has all contexts that lead to these.
Every chunk is sent the counts and code lengths of its own words, and those of
its grams in the order it sent them; the second pass adds them up a document. A task
holds one chunk and its vocabulary, one part of the trie or a bucket of grams. Bytes
of a word below ``DEPTH``, such as those of a text without white space, are
learned and predicted by their grams, too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import concat_ranges, staged, tidy
from lakemart.llm.shingles import mix, slices

DEPTH, HEAD, LONG = 24, 3, 6
END, SPACE = b"\n", b" "
CHUNK_CHARS = 16_000_000
#: Bytes of one word below the deepest level, or of the token sequence, that are worked on at a time.
TAIL_BYTES = 1_000_000
#: Characters whose grams fall into one bucket, and the least number of buckets as a power of two.
_BUCKET_CHARS = 8_000_000
_BUCKET_BITS = 10
#: Words of several heads that are worked on at a time.
_HEAD_WORDS = 20_000
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, score double"


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; ASCII white space parts them."""
    return (text or "").encode("utf-8", "replace").lower().split()


def grams(docs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of documents, given as words, and whose they are; a block of the sequence at a time.

    Bytes of a word from its ``LONG``-th to its ``DEPTH``-th have longer contexts
    in the trie and no gram. Before a document's first byte stand spaces.
    """
    pieces = [SPACE * LONG + SPACE.join([*d, END]) for d in docs]
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    raw = b"".join([b"\0" * 7, *pieces])
    eight = np.ndarray(len(raw) - 7, ">u8", raw, strides=(1,))  # up to and with every byte
    before = -1
    for lo in range(0, len(eight), TAIL_BYTES):
        gram = eight[lo : lo + TAIL_BYTES].astype(np.uint64) & _low(LONG + 1)
        at = np.arange(len(gram), dtype=np.int32)
        # The last space before each byte, and with it the byte's place in its word.
        spaces = np.maximum.accumulate(np.where(np.r_[True, gram & _low(1) == ord(SPACE)], np.r_[0, at + 1], 0))
        place = at - spaces[:-1]
        place[spaces[:-1] == 0] += lo - 1 - before
        before = lo + int(spaces[-1]) - 1 if spaces[-1] else before
        first, last = np.searchsorted(ends, [lo, lo + len(gram) - 1], side="right")
        cuts = np.clip(np.r_[0, ends[first:last] - lo, len(gram)], 0, len(gram))
        doc = np.repeat(np.arange(first, last + 1, dtype=np.int32), np.diff(cuts))
        own = (place < LONG) | (place >= DEPTH)
        for begin in (ends - sizes)[first : last + 1].tolist():
            own[max(begin - lo, 0) : max(begin - lo + LONG, 0)] = False
        yield gram[own], doc[own]


def _low(size: int) -> np.uint64:
    return np.uint64((1 << 8 * size) - 1)


def _bucket(gram: np.ndarray, bits: int) -> np.ndarray:
    """Grams with the same four bytes before the last one fall into one bucket."""
    bucket = mix((gram >> np.uint64(8)) & _low(4)) >> np.uint64(64 - bits)
    return bucket.astype(np.uint16 if bits <= 16 else np.int32)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])


def _told(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order, and how often they occur."""
    values = np.concatenate(parts)
    values.sort()
    starts = _runs(values)
    return values[starts], np.diff(np.r_[starts, len(values)])


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order, and the sums of their counts."""
    values, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(values, kind="stable")
    values = values[order]
    starts = _runs(values)
    return values[starts], np.add.reduceat(counts[order], starts)


def _dealt(gram: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of grams by bucket and turned value, and the buckets in it."""
    order = np.argsort(_turned(gram))
    bucket = _bucket(gram[order], bits)
    by_bucket = np.argsort(bucket, kind="stable")
    return order[by_bucket], bucket[by_bucket]


def _turned(gram: np.ndarray) -> np.ndarray:
    """The four bytes before the last one first, which a bucket's grams have in common."""
    near = (gram >> np.uint64(8)) & _low(4)
    return near << np.uint64(8 * (LONG - 3)) | gram >> np.uint64(40) << np.uint64(8) | gram & _low(1)


def packed(gram: np.ndarray, n: np.ndarray) -> bytes:
    """Grams in the order of turned values, as steps of these, and their counts; bytes of one weight together, compressed."""
    rows = np.stack([np.diff(_turned(gram), prepend=np.uint64(0)), n.astype(np.uint64)]).astype("<u8")
    planes = rows.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes()
    return len(gram).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(rows: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(rows[:8], "little")
    planes = np.frombuffer(pa.decompress(rows[8:], 16 * size, "zstd"), np.uint8).reshape(2, 8, size)
    step, n = planes.transpose(0, 2, 1).copy().view("<u8").reshape(2, size)
    turned = np.cumsum(step, dtype=np.uint64)
    far = (turned >> np.uint64(8)) & _low(LONG - 4)
    return far << np.uint64(40) | turned >> np.uint64(8 * (LONG - 3)) << np.uint64(8) | turned & _low(1), n.astype(np.int64)


_COUNTED = "chunk long, word binary, n long, bucket int, grams binary"


def _count(bits: int):
    """Words and grams of every chunk and how often they occur in texts to learn from, from rows sorted by chunk.

    The end is an empty word. A word or gram of other texts alone has the count 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        seen: set[bytes] = set()
        fresh: list[np.ndarray] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        current = None

        def flush() -> Iterator[pa.RecordBatch]:
            names = [*words, *(w for w in seen if w not in words)]
            yield _counted(current, len(names), word=names, n=[words[w] for w in names])
            # The last bit tells texts to learn from.
            marked, n = _summed([*held, _told(fresh)] if fresh else held)
            gram = marked >> np.uint64(1)
            new = _runs(gram)
            gram, n = gram[new], np.add.reduceat(n * (marked & np.uint64(1)).astype(np.int64), new)
            order, bucket = _dealt(gram, bits)
            gram, n = gram[order], n[order]
            starts = _runs(bucket)
            rows = [packed(gram[a:b], n[a:b]) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(gram)])]
            yield _counted(current, len(rows), bucket=bucket[starts], grams=rows)
            words.clear()
            seen.clear()
            fresh.clear()
            held.clear()

        for batch in batches:
            chunks = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]]) if len(chunks) else ():
                hi = lo + int(np.argmax(np.r_[chunks[lo:] != chunks[lo], True]))
                if current is not None and current != chunks[lo]:
                    yield from flush()
                current = chunks[lo]
                taught = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(bool)
                texts = [t or "" for t in batch.column(2).slice(lo, hi - lo).to_pylist()]
                for at, end in slices(texts):
                    docs = [words_of(t) for t in texts[at:end]]
                    for teaches, doc in zip(taught[at:end].tolist(), docs):
                        if teaches:
                            words.update(doc)
                            words[b""] += 1
                        else:
                            seen.update(doc)
                            seen.add(b"")
                    for gram, doc in grams(docs):
                        fresh.append(gram << np.uint64(1) | taught[at:end][doc].astype(np.uint64))
                        if sum(map(len, fresh)) > 3 * TAIL_BYTES:
                            held.append(_told(fresh))
                            fresh.clear()
                            # Merged by size, so that a value is moved a few times only.
                            while len(held) > 1 and 2 * len(held[-1][0]) > len(held[-2][0]) > 3 * TAIL_BYTES:
                                held[-2:] = [_summed(held[-2:])]
        if current is not None:
            yield from flush()

    return run


def _counted(chunk: int, size: int, **columns) -> pa.RecordBatch:
    kinds = {"word": pa.binary(), "n": pa.int64(), "bucket": pa.int32(), "grams": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, chunk, np.int64)),
         *(pa.array(columns[c], k) if c in columns else pa.nulls(size, k) for c, k in kinds.items())],
        ["chunk", *kinds])


def _bins(n: np.ndarray) -> np.ndarray:
    """Small counts as they are, larger ones by quarters of their binary logarithm."""
    n = np.maximum(n, 0)
    return np.where(n <= 8, n, np.floor(4 * np.log2(np.maximum(n, 1))) - 4).astype(np.int64)


_BINS = 256
WORD_ORDER = 4
#: Class of a byte: 26 letters, space, lead bytes, three kinds of continuation, the rest.
_CLASSES = np.array([
    b - 97 if 97 <= b <= 122 else 26 if b == 32 else 27 if b >= 192 else 28 + b % 3 if b >= 128 else 31
    for b in range(256)])


def _three(context: np.ndarray) -> np.ndarray:
    """Classes of the last three bytes as one number below 32 ** 3."""
    return (_CLASSES[context >> 16] * 32 + _CLASSES[(context >> 8) & 255]) * 32 + _CLASSES[context & 255]


class EscapeCounts:
    """Per order, N and D of a context: occurrences left out, and those the rest had to escape for."""

    def __init__(self, orders: int = WORD_ORDER + 1):
        self.draws = np.zeros((orders, _BINS, _BINS))
        self.out = np.zeros((orders, _BINS, _BINS))

    def add(self, order: int, total: np.ndarray, kinds: np.ndarray, once: np.ndarray) -> None:
        some = total > 1
        total, kinds, once = total[some], kinds[some], once[some]
        n = _bins(total - 1)
        np.add.at(self.draws, (order, n, _bins(kinds)), total - once)
        np.add.at(self.draws, (order, n, _bins(kinds - 1)), once)
        np.add.at(self.out, (order, n, _bins(kinds - 1)), once)

    def rate(self, order: int, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Escape probability, drawn to D / 2N where little was counted."""
        at = (order, _bins(total), _bins(kinds))
        plain = kinds / (2 * np.maximum(total, 1))
        return (self.out[at] + 2 * plain) / (self.draws[at] + 2)


@dataclass
class Contexts:
    """Orders 3 to 0, at most 256 ** 3 counts each, and the escape estimates."""

    three: dict[int, np.ndarray]  # classes of the last three bytes: 256 counts
    two: dict[int, np.ndarray]
    escape: EscapeCounts

    def __post_init__(self):
        self.one = np.zeros((256, 256), np.float32)
        for context, n in self.two.items():
            self.one[context & 255] += n > 0
        self.none = (self.one > 0).sum(axis=0).astype(np.float32)
        for order, level in ((3, [*self.three.values()]), (2, [*self.two.values()]), (1, self.one), (0, self.none)):
            level = np.array(level).reshape(-1, 256).astype(np.int64)
            self.escape.add(order, level.sum(axis=1), (level > 0).sum(axis=1), (level == 1).sum(axis=1))

    def log(self, context: np.ndarray, symbol: np.ndarray, excluded: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of ``symbol`` after the three bytes of ``context``."""
        if excluded is None:
            pairs, back = np.unique(context * 256 + symbol, return_inverse=True)
            return self._log(pairs >> 8, pairs & 255, np.zeros((len(pairs), 256), bool))[back]
        return self._log(context, symbol, excluded)

    def _log(self, context: np.ndarray, symbol: np.ndarray, excluded: np.ndarray) -> np.ndarray:
        out = np.zeros(len(context))
        if len(context) > 4096:
            parts = [slice(i, i + 4096) for i in range(0, len(context), 4096)]
            return np.concatenate([self._log(context[p], symbol[p], excluded[p]) for p in parts])
        nothing = np.zeros(256, np.float32)
        live, excluded = np.ones(len(context), bool), excluded.copy()
        for order in (3, 2, 1, 0):
            if order > 1:
                held = self.three if order == 3 else self.two
                keys = _three(context) if order == 3 else context & 0xFFFF
                n = np.array([held.get(c, nothing) for c in keys.tolist()]).reshape(-1, 256)
            else:
                n = self.one[context & 255] if order else np.broadcast_to(self.none, (len(context), 256))
            self.step(order, n, symbol, out, live, excluded)
        left = np.maximum(256 - excluded.sum(axis=1), 1)
        return out - np.where(live, np.log10(left), 0)

    def step(self, order: int, n: np.ndarray, symbol: np.ndarray, out: np.ndarray, live: np.ndarray,
             excluded: np.ndarray) -> None:
        """Add what contexts with counts ``n`` say to ``out``; rows that find their symbol are ``live`` no longer."""
        n = np.where(excluded, 0, n)
        total, kinds = n.sum(axis=1, dtype=np.float64), (n > 0).sum(axis=1)
        escape = self.escape.rate(order, total, kinds)
        # With every byte known there is nothing to escape for.
        escape = np.where(kinds + excluded.sum(axis=1) >= 256, 0.0, escape)
        own = n[np.arange(len(symbol)), symbol]
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = np.log10((1 - escape) * (own - 0.5) / (total - kinds / 2))
            miss = np.log10(escape)
        open_ = live & (total > 0)
        out += np.where(open_ & (own > 0), hit, 0) + np.where(open_ & (own <= 0), miss, 0)
        live &= ~(open_ & (own > 0))
        excluded |= n > 0


def _after(word: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """The three bytes before each byte of ``word`` from ``lo`` to ``hi``, and that byte."""
    b = word[lo - 3 : hi].astype(np.int64)
    return (b[:-3] * 256 + b[1:-2]) * 256 + b[2:-1], b[3:]


def _put(context: np.ndarray, symbol: np.ndarray, three: dict, two: dict) -> None:
    """Count edges in the short contexts."""
    for held, keys in ((three, _three(context)), (two, context & 0xFFFF)):
        for key, m in zip(*(x.tolist() for x in np.unique(keys * 256 + symbol, return_counts=True))):
            held.setdefault(key >> 8, np.zeros(256, np.float32))[key & 255] += m


class Subtrie:
    """Levels of the trie under one head, from its sorted words and their counts."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        spelled = [w + SPACE if w else END for w in words]
        order = sorted(range(len(words)), key=spelled.__getitem__)
        self.order = np.array(order, np.int64)
        self.counts = counts[self.order]
        self.lengths = np.array([len(spelled[i]) for i in order], np.int64)
        flat = b"".join(spelled[i][:DEPTH].ljust(DEPTH, b"\0") for i in order)
        self.symbols = np.frombuffer(flat, np.uint8).reshape(-1, DEPTH).astype(np.int64)
        self.long = {k: spelled[i] for k, i in enumerate(order) if len(spelled[i]) > DEPTH}

    def levels(self, first: int) -> Iterator[tuple]:
        """From depth ``first``: depth, rows, context pair, symbol, and each row's n, N, D; edges and nodes."""
        n_rows = len(self.lengths)
        new = np.zeros(n_rows, bool)
        if n_rows:
            new[0] = True
        for depth in range(DEPTH):
            if depth:
                new[1:] |= self.symbols[1:, depth - 1] != self.symbols[:-1, depth - 1]
            rows = np.flatnonzero(self.lengths > depth)
            if depth < first or not len(rows):
                continue
            node, symbol = np.cumsum(new)[rows], self.symbols[rows, depth]
            edge = np.r_[True, (node[1:] != node[:-1]) | (symbol[1:] != symbol[:-1])]
            starts = np.flatnonzero(edge)
            n = np.add.reduceat(self.counts[rows], starts)
            at = np.r_[True, node[starts][1:] != node[starts][:-1]]
            nodes = np.flatnonzero(at)
            total, kinds = np.add.reduceat(n, nodes), np.add.reduceat((n > 0).astype(np.int64), nodes)
            once = np.add.reduceat((n == 1).astype(np.int64), nodes)
            of_edge = np.cumsum(edge) - 1
            of_node = np.cumsum(at) - 1
            yield depth, rows, self.context(rows, depth), symbol, n, of_edge, of_node, starts, total, kinds, once

    def context(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """The last three bytes; before a word's first byte stand spaces."""
        context = np.zeros(len(rows), np.int64)
        for back in (3, 2, 1):
            context = context * 256 + (self.symbols[rows, depth - back] if depth >= back else 32)
        return context

    def teach(self, first: int, escape: EscapeCounts, three: dict, two: dict) -> None:
        """Add the subtrie's edges, each once, to the short contexts, and its nodes to the escapes."""
        for _, _, context, symbol, n, _, _, starts, total, kinds, once in self.levels(first):
            escape.add(WORD_ORDER, total, kinds, once)
            _put(context[starts][n > 0], symbol[starts][n > 0], three, two)
        for context, symbol in self.tails():
            _put(context, symbol, three, two)

    def tails(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Contexts and symbols of the edges of learned words below the deepest level, each edge once."""
        before, found, size = np.zeros(0, np.uint8), [], 0
        for row, word in self.long.items():
            if self.counts[row] <= 0:
                continue
            own = np.frombuffer(word, np.uint8)
            # In order, a word shares with all words before it at most what it shares with the last one.
            n = min(len(before), len(own))
            unlike = np.flatnonzero(before[:n] != own[:n])
            at, before = max(DEPTH, int(unlike[0]) if len(unlike) else n), own
            for lo in range(at, len(own), TAIL_BYTES):
                found.append(_after(own, lo, min(lo + TAIL_BYTES, len(own))))
                size += len(found[-1][1])
                if size >= TAIL_BYTES:
                    yield tuple(map(np.concatenate, zip(*found)))
                    found, size = [], 0
        if found:
            yield tuple(map(np.concatenate, zip(*found)))

    def logs(self, first: int, model: Contexts, known: np.ndarray, before: np.ndarray, since: int | None = None) -> np.ndarray:
        """log10 probabilities of the words, given each word's state after ``first`` bytes.

        With ``since``, those of the bytes from there to the deepest level alone.
        """
        live, out = known[self.order], before[self.order]
        for depth, rows, context, symbol, n, of_edge, of_node, starts, total, kinds, _ in self.levels(first):
            own, node = n[of_edge], of_node[of_edge]
            on = live[rows] & (total[node] > 0)
            if since is not None and depth < since:
                live[rows] = on & (own > 0)
                continue
            escape = model.escape.rate(WORD_ORDER, total[node], kinds[node])
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = np.log10((1 - escape) * (own - 0.5) / (total[node] - kinds[node] / 2))
            step = np.where(on & (own > 0), hit, 0.0)
            missed = np.flatnonzero(on & (own <= 0))
            for part in (missed[i : i + 4096] for i in range(0, len(missed), 4096)):
                # The symbols of the context that was left are excluded below.
                places, of = np.unique(node[part], return_inverse=True)
                gone = np.zeros((len(places), 256), bool)
                inside = np.isin(of_node, places) & (n > 0)
                gone[np.searchsorted(places, of_node[inside]), symbol[starts][inside]] = True
                step[part] = np.log10(escape[part]) + model.log(context[part], symbol[part], gone[of])
            off = np.flatnonzero(~on)
            if len(off):
                step[off] = model.log(context[off], symbol[off])
            live[rows] = on & (own > 0)
            out[rows] += step
        for row, word in self.long.items() if since is None else ():
            own = np.frombuffer(word, np.uint8)
            for lo in range(DEPTH, len(own), TAIL_BYTES):
                out[row] += model.log(*_after(own, lo, min(lo + TAIL_BYTES, len(own)))).sum()
        back = np.empty_like(out)
        back[self.order] = out
        return back


def _heads(vocabulary: DataFrame) -> DataFrame:
    """Vocabulary with its head: the first bytes, the closing space included."""
    spelled = F.when(F.octet_length("word") == 0, F.lit(END)).otherwise(F.concat("word", F.lit(SPACE)))
    return vocabulary.select("word", "n", F.substring(spelled, 1, HEAD).alias("head"))


def _by_head(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[bytes], np.ndarray]]:
    """Words of one head or more, all there are, each with its head and count, from rows sorted by head."""
    heads, words, counts = [], [], []
    for batch in batches:
        for w, n, h in zip(*(c.to_pylist() for c in batch.columns)):
            if len(words) >= _HEAD_WORDS and h != heads[-1]:
                yield heads, words, np.array(counts, np.int64)
                heads, words, counts = [], [], []
            heads.append(h)
            words.append(w)
            counts.append(n)
    if words:
        yield heads, words, np.array(counts, np.int64)


def _teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the short contexts and of the escapes, from the part of the trie below the heads."""
    escape, three, two = EscapeCounts(), {}, {}
    for _, words, n in _by_head(batches):
        Subtrie(words, n).teach(HEAD, escape, three, two)
    yield _learned(escape, three, two)


_LEARNED = "kind int, key long, a double, b double"


def _learned(escape: EscapeCounts, three: dict, two: dict) -> pa.RecordBatch:
    rows = [
        (order, c * 256 + s, n, 0)
        for order, held in ((3, three), (2, two)) for c, row in held.items() for s, n in enumerate(row.tolist()) if n]
    kept = np.flatnonzero(escape.draws)
    rows += [(WORD_ORDER, k, d, o) for k, d, o in zip(
        kept.tolist(), escape.draws.ravel()[kept].tolist(), escape.out.ravel()[kept].tolist())]
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "key", "a", "b"])


def _gathered(parts: DataFrame, escape: EscapeCounts) -> tuple[dict, dict]:
    """Short contexts from the rows of all parts; ``escape`` gets their sums, too."""
    with tidy(parts.sparkSession):
        learned = parts.groupBy("kind", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toPandas()
    three, two = {}, {}
    escapes = learned[learned.kind == WORD_ORDER]
    escape.draws.ravel()[escapes.key], escape.out.ravel()[escapes.key] = escapes.a, escapes.b
    for order, held in ((3, three), (2, two)):
        own = learned[learned.kind == order]
        for key, n in zip(own.key.tolist(), own.a.tolist()):
            held.setdefault(key >> 8, np.zeros(256, np.float32))[key & 255] = n
    return three, two


def trie(vocabulary: DataFrame) -> tuple[Contexts, dict[bytes, tuple[bool, float]], DataFrame]:
    """Short contexts, the state after every head, and the vocabulary sorted by head.

    The two first are at most 256 ** 3 numbers each, whatever the corpus.
    """
    headed = _heads(vocabulary)
    parts = headed.repartition("head").sortWithinPartitions("head")
    with tidy(vocabulary.sparkSession):
        tops = headed.groupBy("head").agg(F.sum("n").alias("n")).toPandas()
    escape = EscapeCounts()
    three, two = _gathered(parts.mapInArrow(_teach, _LEARNED), escape)
    # The levels above the heads: heads stand for words here.
    names = [bytes(h) for h in tops["head"]]
    top = Subtrie(names, tops.n.to_numpy(np.int64))
    top.lengths = np.minimum(top.lengths - 1, HEAD)  # without the space put after a head
    top.teach(0, escape, three, two)
    model = Contexts(three, two, escape)
    logs = top.logs(0, model, np.ones(len(names), bool), np.zeros(len(names)))
    return model, {h: (n > 0, float(x)) for h, n, x in zip(names, tops.n, logs)}, parts


def code_lengths(vocabulary: DataFrame, since: int | None = None) -> DataFrame:
    """log10 probability of every word of the vocabulary (word, n), or of its bytes from ``since`` on: rows (word, n, log)."""
    model, heads, parts = trie(vocabulary)
    shared = vocabulary.sparkSession.sparkContext.broadcast((model, heads))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, heads = shared.value
        for own, words, n in _by_head(batches):
            known, before = (np.array(c) for c in zip(*map(heads.__getitem__, own)))
            logs = Subtrie(words, n).logs(HEAD, model, known, before if since is None else np.zeros(len(words)), since)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(n), pa.array(logs)], ["word", "n", "log"])

    return parts.mapInArrow(run, "word binary, n long, log double")


class Stream:
    """Contexts of four to ``LONG`` bytes of a bucket's grams, given all different ones in order and their counts."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        self.gram, self.n = gram, n
        self.levels = []
        gram, n = gram[n > 0], n[n > 0]
        for order in range(LONG, 3, -1):
            if order < LONG:
                gram, n = np.unique(gram & _low(order + 1), return_counts=True)
            context = gram >> np.uint64(8)
            starts = _runs(context)
            sizes = np.diff(np.r_[starts, len(gram)])
            self.levels.append((order, context[starts], starts, sizes, (gram & _low(1)).astype(np.int64), n))

    def teach(self, escape: EscapeCounts, three: dict, two: dict) -> None:
        for order, context, starts, sizes, symbol, n in self.levels:
            if len(n):
                escape.add(order, np.add.reduceat(n, starts), sizes, np.add.reduceat((n == 1).astype(np.int64), starts))
        # Each edge of the shortest contexts here counts once below them.
        _put(np.repeat(context, sizes).astype(np.int64) & 0xFFFFFF, symbol, three, two)

    def logs(self, model: Contexts) -> np.ndarray:
        """log10 probabilities of the grams' last bytes."""
        out = np.zeros(len(self.gram))
        order, _, starts, sizes, _, n = self.levels[0]
        if len(n):
            total = np.add.reduceat(n, starts)
            escape = np.where(sizes >= 256, 0.0, model.escape.rate(order, total, sizes))
            own = (1 - escape) / (total - sizes / 2)
            out[self.n > 0] = np.log10(np.repeat(own, sizes) * (n - 0.5))
        new = np.flatnonzero(self.n == 0)
        for part in (new[i : i + 4096] for i in range(0, len(new), 4096)):
            out[part] = self._new(self.gram[part], model)
        return out

    def _new(self, gram: np.ndarray, model: Contexts) -> np.ndarray:
        """The same of grams that were not learned."""
        symbol = (gram & _low(1)).astype(np.int64)
        out, live, excluded = np.zeros(len(gram)), np.ones(len(gram), bool), np.zeros((len(gram), 256), bool)
        for order, context, starts, sizes, symbols, n in self.levels:
            key = (gram >> np.uint64(8)) & _low(order)
            at = np.searchsorted(context, key)
            known = np.flatnonzero(at < len(context))
            known = known[context[at[known]] == key[known]]
            if not len(known):
                continue
            rows = concat_ranges(starts[at[known]], sizes[at[known]])
            counts = np.zeros((len(gram), 256), np.float32)
            counts[np.repeat(known, sizes[at[known]]), symbols[rows]] = n[rows]
            model.step(order, counts, symbol, out, live, excluded)
        left = np.flatnonzero(live)
        short = (gram[left] >> np.uint64(8)).astype(np.int64) & 0xFFFFFF
        out[left] += model.log(short, symbol[left], excluded[left])
        return out


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[tuple], np.ndarray, Stream]]:
    """Of rows sorted by bucket: a bucket's rows, their grams' places among all different ones, and these."""

    def met(held: list) -> tuple:
        parts = [unpacked(r[2]) for r in held]
        gram, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        n = np.bincount(back, np.concatenate([n for _, n in parts]), len(gram)).astype(np.int64)
        return held, [len(g) for g, _ in parts], back, Stream(gram, n)

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][1] != row[1]:
                yield met(held)
                held = []
            held.append(row)
    if held:
        yield met(held)


def _teach_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the short contexts and of the escapes, from the grams."""
    escape, three, two = EscapeCounts(LONG + 1), {}, {}
    for _, _, _, stream in _by_bucket(batches):
        stream.teach(escape, three, two)
    yield _learned(escape, three, two)


def gram_logs(counted: DataFrame) -> DataFrame:
    """log10 probabilities of the grams' last bytes, in the order of the rows (chunk, bucket, grams): 32-bit numbers."""
    parts = counted.repartition("bucket").sortWithinPartitions("bucket")
    escape = EscapeCounts(LONG + 1)
    shared = counted.sparkSession.sparkContext.broadcast(
        Contexts(*_gathered(parts.mapInArrow(_teach_stream, _LEARNED), escape), escape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sizes, back, stream in _by_bucket(batches):
            logs = np.split(stream.logs(shared.value).astype("<f4")[back], np.cumsum(sizes)[:-1])
            chunk, bucket, _ = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk, pa.int64()), pa.array(bucket, pa.int32()), pa.array([x.tobytes() for x in logs], pa.binary())],
                ["chunk", "bucket", "logs"])

    return parts.mapInArrow(run, "chunk long, bucket int, logs binary")


def _score(bits: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = right.filter(pc.is_valid(right["word"]))
        place = {w: i for i, w in enumerate(told["word"].to_pylist())}
        n, log = (told[c].to_numpy() for c in ("n", "log"))
        known, logs_n = n > 0, np.log10(n + 1.0)
        sent = right.filter(pc.is_valid(right["bucket"])).sort_by("bucket")["logs"].to_pylist()
        texts = left["text"].to_pylist()
        found: list[list[np.ndarray]] = []
        blocks: list[tuple] = []
        for at, end in slices([t or "" for t in texts]):
            docs = [words_of(t) for t in texts[at:end]]
            sizes = np.array([len(d) + 1 for d in docs], np.int64)
            flat = np.fromiter((place[w] for d in docs for w in [*d, b""]), np.int64, int(sizes.sum()))
            first = np.cumsum(sizes) - sizes
            found.append([
                sizes, np.add.reduceat(known[flat].astype(np.int64), first),
                np.add.reduceat(logs_n[flat], first), np.add.reduceat(log[flat], first)])
            for gram, doc in grams(docs):
                own, back = np.unique(gram, return_inverse=True)
                starts = _runs(doc)
                blocks.append((own, back.astype(np.int32), starts, doc[starts] + at))
        n_tokens, n_known, known_log, score = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0)] * 4
        if blocks:
            # The chunk's grams in the order in which their values come: by bucket.
            gram, _ = _told([b[0] for b in blocks])
            logs = np.empty(len(gram))
            logs[_dealt(gram, bits)[0]] = np.frombuffer(b"".join(sent), "<f4")
            for own, back, starts, doc in blocks:
                if len(starts):
                    score[doc] += np.add.reduceat(logs[np.searchsorted(gram, own)][back], starts)
        return pa.table({
            "doc_id": left["doc_id"], "held_out": left["held_out"],
            "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "known_log": pa.array(known_log, pa.float64()), "score": pa.array(score, pa.float64())})

    return run


def score(docs: DataFrame, held_out: Column, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text), learning from rows that are not ``held_out``.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (the
    add-one unigram model), score.

    A null text counts as empty: its tokens are the end alone. Null ids and
    repeated rows are scored each. Other columns are ignored; an empty table
    gives no rows. Without any row to learn from all bytes are equally likely.
    """
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    chunks = max(int(chars) // chunk_chars, 1)
    # Rows of one id, such as a repeated one, are parted by their text.
    chunk = F.pmod(F.hash("doc_id", "text"), F.lit(chunks)).cast("long")
    base = docs.select(
        chunk.alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    bits = max(_BUCKET_BITS, (int(chars) // _BUCKET_CHARS).bit_length())
    counted = staged(
        base.select("chunk", ~F.col("held_out"), "text").repartition(chunks, "chunk").sortWithinPartitions("chunk")
        .mapInArrow(_count(bits), _COUNTED))
    words = counted.where("word IS NOT NULL").select("chunk", "word", "n")
    vocabulary = staged(words.groupBy("word").agg(F.sum("n").alias("n")))
    total = vocabulary.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    n, v = int(total.n or 0), int(total.v or 0)
    sent = staged(words.select("chunk", "word").join(code_lengths(vocabulary, LONG), "word")).unionByName(
        staged(gram_logs(counted.where("bucket IS NOT NULL").select("chunk", "bucket", "grams"))), allowMissingColumns=True)
    scored = base.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(_score(bits), SCORED)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("known_log") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"), "score")
