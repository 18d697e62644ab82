import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import periods
from lakemart.llm.queries import op12_periods


def plain_runs(words, shortest):
    """Every run by trying each period and stretching each agreement."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            start, length = at, end - at + q
            if end > at and length >= max(shortest, 2 * q):
                part = words[start : start + length]
                if not any(all(part[i] == part[i + p] for i in range(length - p)) for p in range(1, q)):
                    out.append((start, length, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 12)
    drop = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(2, 12))
def test_runs_against_trying_all_periods(words, shortest):
    assert periods.runs_of(words, shortest) == plain_runs(words, shortest)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"e"]), min_size=1, max_size=7),
                          st.integers(1, 6)), max_size=12))
def test_runs_of_repeated_blocks(blocks):
    words = [w for block, times in blocks for w in block * times]
    assert periods.runs_of(words) == plain_runs(words, 12)


def test_texts_of_one_word_take_linear_steps():
    assert periods.runs_of([b"a"] * 200_000) == [(0, 200_000, 1)]
    words = [b"x%d" % (i % 7) for i in range(100_000)] + [b"y"] * 30
    assert periods.runs_of(words) == [(0, 100_000, 7), (100_000, 30, 1)]


def test_whole_query_against_plain_search(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in op12_periods(spark, path).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    short = [r for r in docs if len(r.text or "") < 12_000]
    assert len(short) > 0.8 * len(docs) and len(got) == len(docs)
    by_id = {r[0]: r for r in got}
    assert [by_id[r.doc_id] for r in short] == [plain_row(r.doc_id, r.text) for r in short]
    assert sum(r[1] > 0 for r in got) >= 10


def test_corner_cases(spark, tmp_path):
    long = " ".join(["one two three"] * 30_000)
    rows = [(1, None, 0), (2, "", 0), (3, " \t\x0b\x0c\r\n", 0), (4, "a " * 11, 0), (5, "a " * 12, 0), (5, "a " * 12, 0),
            (None, "b c " * 9, 0), (7, long, 0), (8, "ä\xa0b " * 12, 0), (9, "a " * 5000 + "b", 0), (10, "x y z", 0)]
    rows += [(i, "p q r s t u v w x y " * 3 + str(i), 0) for i in range(11, 60)]
    spark.createDataFrame(rows, "doc_id long, text string, runs int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op12_periods(spark, str(tmp_path)).collect()), key=str)
    small = sorted((plain_row(d, t) for d, t, _ in rows if len(t or "") < 50_000), key=str)
    assert [r for r in got if r[0] != 7] == small
    assert [r for r in got if r[0] == 7][0][1:6] == (1, 0, 90_000, 3, 30_000_000)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periods.report(periods.with_planted(empty)).count() == 0


def test_real_outputs(spark):
    docs = spark.createDataFrame([(1, "so it is " * 5 + "then")], "doc_id long, text string")
    row = periods.periodic_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(0, 15, 3)] and row.collapsed == "so it is then"
