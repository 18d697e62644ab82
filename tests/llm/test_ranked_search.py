import math
import re
from collections import Counter

import duckdb
import pytest

from lakemart.llm import ranked_search
from lakemart.llm.queries import ORACLE, op13_search

COLUMNS = ["item_id", "rank", "doc_id", "score"]


def by_sql(path):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet{'/*.parquet' if not path.startswith('/root') else ''}')")
    return sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op13_search']})").fetchall(), key=str)


def plain(docs, items, top=10):
    """The ranking document by document."""
    terms = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(
        r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    by_item = {}
    for i, t in items:
        if i is not None:
            by_item.setdefault(i, set()).update(terms(t))
    out = []
    for i, words in by_item.items():
        rows = []
        for d, b in bags:
            m = 10 + 90 * sum(b.values()) * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                        (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t in words if b[t])
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(i, k, r[3], -r[0]) for k, r in enumerate(sorted(rows, key=lambda r: r[:3])[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    got = sorted((tuple(r) for r in op13_search(spark, path).select(*COLUMNS).collect()), key=str)
    assert got == by_sql(path) and got


ITEMS = [("a", "Quick brown fox", 0), ("b", "the fox", 0), ("c", "", 0), ("d", None, 0), ("e", "nowhere-found", 0),
         ("b", "lazy DOG", 0), ("f", "É été x9", 0), ("g", "the the the", 0)]
DOCS = [(1, "the quick brown fox", 0), (2, None, 0), (3, "", 0), (4, "Fox fox FOX " * 5, 0), (None, "the quick brown fox", 0),
        (5, "été X9", 0), (6, "É", 0), (7, "the lazy dog", 0), (7, "the lazy dog", 0), (8, "fox " + "other " * 60_000, 0)]
DOCS += [(i, "brown cow of the field", 0) for i in range(100, 140)]


def tables(spark):
    return (spark.createDataFrame(DOCS, "doc_id long, text string, score int"),
            spark.createDataFrame(ITEMS, "item_id string, text string, score int"))


def test_corner_cases(spark, tmp_path):
    docs, items = tables(spark)
    got = sorted((tuple(r) for r in ranked_search.search(docs, items).collect()), key=str)
    assert got == plain([d[:2] for d in DOCS], [i[:2] for i in ITEMS])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert got == by_sql(str(tmp_path))


def test_shards_blocks_and_partitions_change_nothing(spark, monkeypatch):
    docs, items = tables(spark)
    want = sorted((tuple(r) for r in ranked_search.search(docs, items).collect()), key=str)
    got = ranked_search.search(docs.repartition(7), items.repartition(3), shard_pairs=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    some = [r for r in want if r[1] <= 3]
    got = ranked_search.search(docs, items, top=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == some


def test_empty_tables_and_ids(spark):
    docs, items = tables(spark)
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    assert ranked_search.search(docs, items.selectExpr("cast(null as long) item_id", "text")).count() == 0
    numbered = spark.createDataFrame([(12, "fox")], "item_id long, text string")
    assert ranked_search.search(docs, numbered).schema["item_id"].dataType.simpleString() == "bigint"


def test_class_of_copies_is_sent_once_a_task(spark):
    docs = spark.range(0, 20_000, 1, 16).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'same words here' ELSE 'else' END AS text")
    items = spark.createDataFrame([("i", "words here")], "item_id string, text string")
    got = ranked_search.search(docs, items)
    assert [r.doc_id for r in got.orderBy("rank").collect()] == list(range(0, 20, 2))
