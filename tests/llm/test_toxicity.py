"""Operator 7: held-out accuracy, and what must not reach the model."""

import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm.toxicity import FEATURES, _features, _WordMarks, fit, held_out, op7_toxicity, score

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in op7_toxicity(spark, SF).collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_rows(spark, scored):
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(scored) == sorted(ids)
    for r in scored.values():
        assert 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_accuracy(scored, labels):
    rows = [(scored[i].score, y) for i, y in labels.items() if scored[i].held_out]
    toxic, other = ([s for s, y in rows if y == label] for label in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in other) / (len(toxic) * len(other))
    right = sum((s >= 0.5) == y for s, y in rows) / len(rows)
    assert auc > 0.97
    assert right > 0.97


def test_calibration(scored, labels):
    rows = [(scored[i].score, y) for i, y in labels.items() if scored[i].held_out]
    assert abs(sum(s for s, _ in rows) / len(rows) - sum(y for _, y in rows) / len(rows)) < 0.03


def test_held_out_labels_and_other_columns_change_nothing(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    plain = score(docs, fit(docs, labels))
    flipped = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.select("doc_id", "text", F.lit("zz").alias("lang"), F.lit("zz").alias("source"), F.lit(1).alias("features"), F.lit(2.0).alias("raw"))
    again = score(other, fit(other, flipped))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, again.collect()))


def test_awkward(spark, awkward, empty):
    docs, rows = awkward
    labels = spark.createDataFrame([(i, k) for i, k in [(1, 1), (2, None), (None, 1), (9, 0), (9, 1), (999, 0)]], "doc_id long, toxic int")
    model = fit(docs, labels)
    assert model.trees is None
    assert {r.score for r in score(docs, model).collect()} == {model.prior}
    trained = fit(*(spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")))
    found = score(docs, trained).collect()
    assert len(found) == len(rows)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1
    assert score(empty, trained).collect() == []
    assert fit(empty, labels.limit(0)).prior == 0


def test_features():
    marks = _WordMarks({"idiot": 4.0, "lowe~": 3.0})
    rows = [None, "", "you IDIOT!", "an 1d1ot", "idiiiot lowered", "plain words"]
    found = [dict(zip(FEATURES, row, strict=True)) for row in _features(rows, marks)]
    assert found[0] == found[1] == dict.fromkeys(FEATURES, 0.0)
    assert found[2]["lexicon_sum"] == 4 and found[2]["lexicon_near_second_person"] == 1 and found[2]["capital_words"] == 0.5
    assert found[3]["obfuscated_rate"] == 0.5 and found[3]["undone_lexicon_sum"] == 4 and found[3]["lexicon_sum"] == 0
    assert found[4]["undone_lexicon_sum"] == 4 and found[4]["lexicon_sum"] == 3
    assert found[5]["lexicon_sum"] == 0
