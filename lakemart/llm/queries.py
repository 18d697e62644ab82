"""Registered queries of the corpus operators: each runs over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    chaining,
    decontaminate,
    graph_dedup,
    html_text,
    jaccard,
    license_scan,
    packing,
    periods,
    pieces,
    ppm,
    ranked_search,
    toxicity,
    tree_search,
)
from lakemart.llm.common import remainder, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.KneserNey:
    """The models as op1 and the pipeline fit them: every fourth id is held out."""
    return toxicity.fit(docs, labels, keep=remainder(F.col("doc_id"), 4) != 2)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, held_out=remainder(F.col("doc_id"), 4) == 2)


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ppm.score(docs, held_out=remainder(F.col("doc_id"), 7) == 2)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), PIECES)
    return pieces.digests(encoded, PIECES)


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_dedup.link(table(spark, sf_dir, "embeddings"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, BYTE_BPE_RANKS)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(periods.with_planted(table(spark, sf_dir, "documents")))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


REGISTRY = {
    "op1_toxicity": op1_toxicity,
    "op2_ppm": op2_ppm,
    "op3_html": op3_html,
    "op4_pieces": op4_pieces,
    "op5_passages": op5_passages,
    "op6_near_vectors": op6_near_vectors,
    "op7_licenses": op7_licenses,
    "op8_packing": op8_packing,
    "op9_ann": op9_ann,
    "op10_jaccard": op10_jaccard,
    "op11_decontaminate": op11_decontaminate,
    "op12_periods": op12_periods,
    "op13_search": op13_search,
}
#: Queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op7_licenses": license_scan.oracle(),
    "op11_decontaminate": decontaminate.oracle(),
    "op13_search": ranked_search.oracle(),
}
