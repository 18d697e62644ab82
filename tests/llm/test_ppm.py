import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import ppm
from lakemart.llm.common import table
from lakemart.llm.queries import op2_ppm

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = Counter(w for i, t in texts.items() if not held[i] for w in tokens(t))
    n, v = sum(count.values()), len(count)
    rows = {r.doc_id: r for r in op2_ppm(spark, SF).collect()}
    assert set(rows) == set(texts)
    for i, t in texts.items():
        own, r = tokens(t), rows[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(own), n)
        assert r.n_known == sum(count[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
        assert r.score < 0


def teach(words):
    counts = Counter(words)
    names = list(counts)
    escape, three, two = ppm.EscapeCounts(), {}, {}
    trie = ppm.Subtrie(names, np.array([counts[w] for w in names]))
    trie.teach(0, escape, three, two)
    return counts, ppm.Contexts(three, two, escape)


def word_log(word, counts, model):
    names = [*counts, *([] if word in counts else [word])]
    trie = ppm.Subtrie(names, np.array([counts.get(w, 0) for w in names]))
    logs = trie.logs(0, model, np.ones(len(names), bool), np.zeros(len(names)))
    return logs[names.index(word)]


def test_next_bytes_sum_to_one():
    """After any beginning the probabilities of all 256 next bytes sum to 1."""
    counts, model = teach([b"the", b"the", b"then", b"than", b"a", b"", b"cat", b"cat"])
    for context, gone in ((b"  t", b""), (b"the", b"n"), (b"zzz", b""), (b"at ", b"ab")):
        c = int.from_bytes(context, "big")
        excluded = np.zeros((256, 256), bool)
        excluded[:, list(gone)] = True
        p = 10 ** model.log(np.full(256, c), np.arange(256), excluded)
        assert p[[b for b in range(256) if b not in gone]].sum() == pytest.approx(1, rel=1e-9)
    # Through the word trie: all one-byte words, longer words by their first byte, and the end.
    first = sum(10 ** word_log(bytes([b]), counts, model) for b in range(97, 123)) + 10 ** word_log(b"", counts, model)
    assert 0 < first < 1


def test_heads_agree_with_one_trie(spark):
    words = [b"the", b"them", b"theme", b"a", b"ab", b"", b"abcd" * 12, b"zebra", "ñandú".encode()] * 2 + [b"the"] * 5
    counts, model = teach(words)
    unseen = {b"thek": 0, b"q": 0, b"abce": 0}
    vocabulary = spark.createDataFrame([(bytearray(w), n) for w, n in (dict(counts) | unseen).items()], "word binary, n long")
    got = {bytes(r.word): r.log for r in ppm.code_lengths(vocabulary).collect()}
    for w in got:
        assert got[w] == pytest.approx(word_log(w, dict(counts) | unseen, model), rel=1e-9)


def test_learning_and_corner_cases(spark):
    schema = "doc_id long, text string, score double, chunk int"
    rows = [(1, "same words here", 0.0, 1), (1, "same words here", 0.0, 1), (None, None, 1.0, 2), (2, "", 0.0, 1),
            (3, "x" * 5000, 0.0, 1), (4, " \t\n\x0b", 0.0, 1), (5, "Ümlaut ÄB same", 0.0, 1)]
    docs = spark.createDataFrame(rows, schema)
    got = ppm.score(docs, F.col("doc_id") == 3, chunk_chars=1000).collect()
    assert len(got) == 7 and all(math.isfinite(r.score) for r in got)
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 2, 4, 4, 4]
    nothing = ppm.score(docs, F.lit(True)).collect()
    one = next(r for r in nothing if r.doc_id == 2)
    assert one.train_tokens == 0 and one.score == pytest.approx(-math.log10(256)) and one.base_score == 0
    assert ppm.score(docs.limit(0), F.lit(False)).count() == 0


def test_words_are_learned_beyond_the_deepest_level(spark):
    """What a text without white space teaches does not end with its first bytes."""
    begin, asked = "q" * (ppm.DEPTH + 3), "abcab" * 12
    logs = []
    for tail in ("abcab" * 40, "xyzzy" * 40):
        docs = spark.createDataFrame([(1, begin + tail), (2, asked)], "doc_id long, text string")
        logs.append({r.doc_id: r.score for r in ppm.score(docs, F.col("doc_id") == 2).collect()}[2])
    assert logs[0] > logs[1] + 20


def test_edges_beyond_the_deepest_level_count_once(monkeypatch):
    stem = b"s" * 30
    words = [stem + b"one", stem + b"onto", stem + b"unseen", b"short"]
    for size in (10**6, 2):
        monkeypatch.setattr(ppm, "TAIL_BYTES", size)
        trie = ppm.Subtrie(words, np.array([3, 1, 0, 9]))
        edges = Counter(s for _, symbols in trie.tails() for s in symbols.tolist())
        assert edges == Counter(b"s" * 6 + b"one " + b"to ")


def test_words_before_a_word_count(spark):
    """Two held-out texts of the same words: the one in the learned order is predicted better."""
    rows = [(i, "anna said nothing then bob said plenty") for i in range(20)]
    rows += [(100, "anna said nothing then bob said plenty"), (101, "bob plenty then said nothing said anna")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.score(docs, F.col("doc_id") >= 100).collect()}
    assert got[100].n_tokens == got[101].n_tokens and got[100].base_score == pytest.approx(got[101].base_score)
    assert got[100].score > got[101].score + 5


def plain_scores(learn, ask):
    """Byte contexts of 6 to none in dictionaries, for words that are shorter than the longest context."""
    def stream(text):
        return b" " * ppm.LONG + b"".join(w + b" " for w in ppm.words_of(text)) + b"\n"

    def key(order, context):
        own = context[len(context) - min(order, 3) :] if order < 4 else context[len(context) - order :]
        return tuple(int(ppm._CLASSES[b]) for b in own) if order == 3 else own

    levels = {ppm.LONG: {}}
    for text in learn:
        s = stream(text)
        for i in range(ppm.LONG, len(s)):
            counts = levels[ppm.LONG].setdefault(s[i - ppm.LONG : i], Counter())
            counts[s[i]] += 1
    edges = {}
    for order in range(ppm.LONG - 1, -1, -1):
        # Contexts of two and of three count each different edge of four, those of one and none the edges of the next.
        longer = edges[4] if order in (3, 2) else {(c, b) for c, n in levels[order + 1].items() for b in n}
        levels[order] = {}
        for context, b in longer:
            levels[order].setdefault(key(order, context), Counter())[b] += 1
        edges[order] = {(c, b) for c, n in levels[order].items() for b in n}
        if order == 4:
            edges[4] = {(c, b) for c, n in levels[4].items() for b in n}
    escape = ppm.EscapeCounts(ppm.LONG + 1)
    for order, held in levels.items():
        for n in held.values():
            values = np.array([*n.values()])
            escape.add(order, np.array([values.sum()]), np.array([len(values)]), np.array([(values == 1).sum()]))
    for text in ask:
        s, total = stream(text), 0.0
        for i in range(ppm.LONG, len(s)):
            gone = set()
            for order in range(ppm.LONG, -1, -1):
                n = {b: m for b, m in levels[order].get(key(order, s[i - ppm.LONG : i]), {}).items() if b not in gone}
                if not n:
                    continue
                e = escape.rate(order, np.array([sum(n.values())]), np.array([len(n)]))[0]
                if s[i] in n:
                    total += math.log10((1 - e) * (n[s[i]] - 0.5) / (sum(n.values()) - len(n) / 2))
                    break
                total += math.log10(e)
                gone |= set(n)
            else:
                total -= math.log10(256 - len(gone))
        yield total


def test_score_against_plain_contexts(spark):
    rng = np.random.default_rng(7)
    names = ["a", "of", "the", "then", "there", "ñu", "été", "xyz", "I"]
    texts = [" ".join(rng.choice(names, rng.integers(0, 30))) for _ in range(60)] + ["zq the b", "é", None, "the q\x01 of"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in ppm.score(docs, F.col("doc_id") >= 50, chunk_chars=500).collect()}
    for i, score in enumerate(plain_scores(texts[:50], texts)):
        assert got[i] == pytest.approx(score, rel=1e-5)


def test_grams_of_a_sequence_cut_in_blocks(monkeypatch):
    docs = [[b"ab", b"q" * 40, b"c"], [], [b"word"] * 9]
    whole = [np.concatenate(c) for c in zip(*ppm.grams(docs))]
    # Bytes 6 to 23 of the long word are the trie's.
    assert len(whole[0]) == (3 + 41 - 18 + 2 + 1) + 1 + 46
    assert bytes(int(g) & 255 for g in whole[0][whole[1] == 2]) == b"word " * 9 + b"\n"
    for size in (1, 5, 7, 30):
        monkeypatch.setattr(ppm, "TAIL_BYTES", size)
        cut = [np.concatenate(c) for c in zip(*ppm.grams(docs))]
        assert all(len(a) == len(b) and (a == b).all() for a, b in zip(whole, cut))
    gram, n = np.unique(whole[0], return_counts=True)
    order, bucket = ppm._dealt(gram, 2)
    gram, n = gram[order][bucket == bucket[0]], n[order][bucket == bucket[0]]
    assert all((a == b).all() for a, b in zip(ppm.unpacked(ppm.packed(gram, n)), (gram, n)))
