import numpy as np
from pyspark.sql import functions as F

from lakemart.llm import toxicity
from lakemart.llm.common import remainder, table
from lakemart.llm.queries import op1_toxicity

SF = "/root/testdata/sf0.001"


def test_query_scores_every_row(spark):
    rows = op1_toxicity(spark, SF).toPandas()
    docs = table(spark, SF, "documents").select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("h")).toPandas()
    assert sorted(rows.doc_id) == sorted(docs.doc_id)
    assert dict(zip(rows.doc_id, rows.held_out)) == dict(zip(docs.doc_id, docs.h))
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.3) == (rows.predicted == 1)).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op1_toxicity(spark, sf).toPandas().merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    own = rows[rows.held_out & rows.toxic.notna()].sort_values("score", kind="stable")
    place = np.arange(1, len(own) + 1)
    ones = (own.toxic == 1).to_numpy()
    area = (place[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert area > 0.9
    assert own[own.predicted == 1].toxic.mean() > 0.8


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, "bad awful" if i % 2 else "good fine") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    keep = remainder(F.col("doc_id"), 4) != 2
    other = labels.withColumn("toxic", F.when(keep, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.fit(docs, x, keep) for x in (labels, other))
    assert a.words == b.words and a.weights == b.weights


def test_rare_inflections_follow_their_stem():
    counts = {f"vile{x}": (0, 3) for x in ("a", "en", "ung", "o")} | {f"word{i}": (5, 5) for i in range(50)}
    model = toxicity.kneser_ney(counts)
    assert model("vilexyz") > 1 > abs(model("word7")) and abs(model("qqqq")) < 1


def test_corner_cases(spark):
    schema = "doc_id long, text string, score double, label int"
    docs = spark.createDataFrame([(1, None, 0.0, 1), (1, None, 0.0, 1), (None, "", 1.0, 0), (3, "bad " * 40_000, 1.0, 1)], schema)
    labels = spark.createDataFrame([(None, 1), (3, None), (1, 7)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    rows = toxicity.score(docs, model, F.lit(False)).collect()
    assert len(rows) == 4 and {r.score for r in rows} == {0.0}
    taught = spark.createDataFrame([(1, 0), (1, 0), (3, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.fit(docs, taught, F.lit(True)), F.lit(False)).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(docs.limit(0), model, F.lit(False)).count() == 0


def test_giant_texts_take_no_class_away(spark):
    """Whichever of a class's texts are giants, the others teach; a class of one giant teaches by its beginning."""
    sample = toxicity.Sample(toxic=50, ordinary=50, chars=20_000)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    first = labels.orderBy(F.xxhash64("doc_id")).select("doc_id").collect()
    giants = {r.doc_id for r in first[:4]}
    rows = [(i, ("bad awful " if i % 2 else "good fine ") * (5_000 if i in giants else 3)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    taught = toxicity.training_sample(docs, labels, F.lit(True), sample).toPandas()
    short = taught[taught.text.str.len() < 100]
    assert len(short) == 40 - len(giants) and set(short.toxic) == {0, 1}
    assert taught.groupby("toxic").text.apply(lambda t: t.str.len().sum()).max() <= sample.chars
    model = toxicity.fit(docs, labels, F.lit(True), sample)
    assert model.prior is None
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model, F.lit(False)).collect()}
    assert min(s for i, s in scores.items() if i % 2) > max(s for i, s in scores.items() if not i % 2)
    one = docs.where(F.col("doc_id").isin(*giants) | (F.col("doc_id") % 2 == 0))
    assert set(toxicity.training_sample(one, labels, F.lit(True), sample).toPandas().toxic) == {0, 1}


def test_one_threshold_for_the_pipeline():
    import corpus_pipeline

    assert corpus_pipeline.REJECT == toxicity.THRESHOLD
