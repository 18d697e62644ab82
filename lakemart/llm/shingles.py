"""Word-shingle fingerprints computed on whole slices of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from lakemart.llm.common import concat_ranges

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CACHE_WORDS = 200_000
SLICE_CHARS = 1_500_000
#: Words whose bytes are hashed at a time.
_BLOCK_WORDS = 1 << 17
#: ASCII bytes that ``str.split`` parts words at.
_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class WordHash(dict):
    """64-bit hash of a word, kept for the worker's lifetime up to a bounded number."""

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHash()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded number of characters, or one longer text."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end]) <= limit):
            chars += len(texts[end])
            end += 1
        yield at, end
        at = end


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number in each."""
    parts = [t.lower().split() for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = np.fromiter(
        (h for p in parts for h in map(_HASHES.__getitem__, p)), np.uint64, int(sizes.sum()))
    return flat, sizes


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Polynomials of ``width`` words from every place on, zeros after the last, from those of half as many."""
    rolled, done = words.copy(), 1
    for bit in f"{width:b}"[1:]:
        twice = rolled * np.uint64(pow(int(_MULTIPLIER), done, 1 << 64))
        twice[: max(len(words) - done, 0)] += rolled[done:]
        rolled, done = twice, 2 * done
        if bit == "1":
            rolled *= _MULTIPLIER
            rolled[: max(len(words) - done, 0)] += words[done:]
            done += 1
    return rolled


def word_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the lower-cased words of all texts, made from their bytes, and the number in each.

    As ``word_hashes``, with other values: no word becomes a Python object, so a
    text of words that are seen once costs no more than any other.
    """
    low = (t.lower() for t in texts)
    plain = [(t if t.isascii() else " ".join(t.split())).encode() for t in low]
    raw = b" ".join([*plain, b" " * 8])
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    edges = np.r_[0, edges] if not space[0] else edges
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(p) + 1 for p in plain], dtype=np.int64)
    sizes = np.diff(np.searchsorted(starts, ends), prepend=0)
    # The eight bytes from every place on.
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    codes = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _BLOCK_WORDS):
        n = lengths[at : at + _BLOCK_WORDS]
        parts = (n + 7) >> 3
        first = np.cumsum(parts) - parts
        step = concat_ranges(np.zeros(len(parts), np.int64), parts)
        value = eight[np.repeat(starts[at : at + _BLOCK_WORDS], parts) + 8 * step]
        value &= _LOW_BYTES[np.minimum(np.repeat(n, parts) - 8 * step, 8)]
        value = mix(value + (step + 1).astype(np.uint64) * _MULTIPLIER)
        codes[at : at + len(n)] = mix(np.add.reduceat(value, first) + n.astype(np.uint64))
    return codes, sizes


def shingle_hashes(words: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``width`` words, and their number in each text.

    A shorter text that has words counts as one shingle of all its words.
    """
    rolled = _rolled(words, width)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(words))
    whole = left >= width
    counts = np.maximum(sizes - width + 1, 0)
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        first = (ends - sizes)[short]
        for at, size in zip(first.tolist(), sizes[short].tolist()):
            value = np.uint64(size)
            for w in words[at : at + size]:
                value = np.multiply(value, _MULTIPLIER) + w
            rolled[at] = value
        whole[first] = True
        counts[short] = 1
    return mix(rolled[whole]), counts
