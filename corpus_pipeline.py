"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
each stage's result as Parquet to the shared scratch folder and gives it, read
again, to the next. All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import chaining, jaccard, packing, toxicity
from lakemart.llm.common import staged, table
from lakemart.llm.queries import BYTE_BPE, BYTE_BPE_RANKS, toxicity_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes when op1 predicts it toxic.
REJECT = toxicity.THRESHOLD
_WORD = re.compile(r"\S+")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, fitted on the labelled ones, don't reject."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    plain = docs.select(*COLUMNS)
    return plain.mapInArrow(_below(spark, model), plain.schema)


def _below(spark: SparkSession, model: toxicity.KneserNey):
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = toxicity.score_texts(shared.value, batch.column(1))
            yield batch.filter(pa.array(scores < REJECT))

    return run


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every group of near-duplicates; rows without an id stay."""
    kept = jaccard.join(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.union(docs.select(*COLUMNS).where("doc_id IS NULL"))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; texts left without words go."""
    spans = chaining.passages(docs).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    schema = docs.select(*COLUMNS).schema
    cut = docs.select(*COLUMNS).join(spans, "doc_id")
    rest = docs.select(*COLUMNS).join(spans, "doc_id", "left_anti")
    return rest.union(cut.select(*COLUMNS, "spans").mapInArrow(_cut, schema))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given ranges of words."""
    words = [m.start() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in sorted(spans):
        start, end = max(start, at), min(end, len(words))
        if start < end:
            out.append(text[words[at] if at else 0 : words[start]] if start > at or not at else "")
            at = end
    if at < len(words):
        out.append(text[words[at] if at else 0 :])
    return "".join(out).strip() if at else text


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, text, lang, source, _, spans = batch.columns
        left = [
            without_spans(t or "", [(s["start"], s["end"]) for s in p])
            for t, p in zip(text.to_pylist(), spans.to_pylist())
        ]
        n_chars = pa.array([len(t) for t in left], pa.int64()).cast(batch.schema.field("n_chars").type)
        yield pa.RecordBatch.from_arrays(
            [doc, pa.array(left, pa.string()), lang, source, n_chars], COLUMNS
        ).filter(pa.array([bool(t) for t in left], pa.bool_()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences."""
    return packing.pack_documents(docs, BYTE_BPE, BYTE_BPE_RANKS)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", cut_passages),
    ("packing", pack),
]
#: Models, MinHash and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
