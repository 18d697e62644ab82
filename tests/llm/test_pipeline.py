import corpus_pipeline as pipeline
import pytest
from lakemart.llm.common import staged, table
from lakemart.llm.queries import op1_toxicity

from tests.llm.test_chaining import exact_repeats
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import check_pieces

SF = "/root/testdata/sf0.001"


def test_stages_in_order_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "substring_dedup", "packing"]
    steps = []
    for _, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF))
        steps.append(docs)
    clean, single, cut, packed = ({r.doc_id: r for r in d.collect()} for d in steps)
    for d in steps[:3]:
        assert d.columns == pipeline.COLUMNS
    scores = {r.doc_id: r.score for r in op1_toxicity(spark, SF).collect()}
    assert clean == {i: r for i, r in before.items() if scores[i] < pipeline.REJECT}
    near = brute({i: r.text for i, r in clean.items()})
    assert single == {i: r for i, r in clean.items() if near[i][1] == i}
    need = exact_repeats({i: r.text for i, r in single.items()})
    assert set(cut) <= set(single)
    assert exact_repeats({i: r.text for i, r in cut.items()}) == {}
    for i, r in cut.items():
        assert r.n_chars == len(r.text) and (i in need or r.text == single[i].text or len(r.text) < len(single[i].text))
    assert check_pieces(steps[3].collect(), {i: r.text for i, r in cut.items()}) == 0


@pytest.mark.parametrize("text, spans, left", [
    ("a b  c d e", [(1, 3)], "a d e"), ("a b c", [(0, 3)], ""), (" a b c d e f", [(0, 1), (2, 4)], "b e f"),
    ("x y", [], "x y"), ("a b c d", [(1, 3), (2, 4)], "a"), ("a b c d", [(2, 9)], "a b"), ("a b c d e", [(0, 2), (1, 2), (3, 4)], "c e"),
])
def test_spans_are_cut(text, spans, left):
    assert pipeline.without_spans(text, spans) == left


def test_empty_null_and_repeated_rows(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (-1, None, "en", None, 0), (-2, "", "en", "s", 0), (-3, "a b c", "en", "s", 5),
         (-3, "a b c", "en", "s", 5)], docs.schema)
    for rows, least in ((odd, 4), (docs.limit(0), 0)):
        for _, stage in pipeline.STAGES[:3]:
            rows = staged(stage(spark, rows, SF))
            assert rows.count() == least or rows.count() == 5
        assert pipeline.pack(spark, rows, SF).count() == least
