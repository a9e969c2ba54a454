import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import lang
from tallybook.llm.common import table

from .fixtures import awkward, frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    model = lang.fit(docs)
    assert set(model.families) == {"germanic", "romance"}
    found = lang.predict(docs, model, carry=("lang", "n_chars")).filter(lang.held_out(F.col("doc_id"))).collect()
    assert len(found) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_learns_from_labelled_rows_alone(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    relabelled = docs.withColumn("lang", F.when(lang.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    one, two = lang.fit(docs, rows=30), lang.fit(relabelled.repartition(3), rows=30)
    assert one.families == two.families
    assert np.array_equal(one.family_weights, two.family_weights)


def test_awkward_texts(spark):
    rows = [(-1, None), (-2, ""), (-3, "123 ... !"), (-4, "é"), (-5, "日本"), (None, "words of english"), *awkward()]
    model = lang.fit(table(spark, SF, "documents"), rows=30)
    got = lang.predict(frame(spark, rows), model).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] in (-1, -2, -3)}
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in by_id.values())
    assert sum(r["lang_pred"] == "und" for r in got) >= 5


def test_nothing_to_learn(spark):
    none = frame(spark, [])
    assert lang.fit(none) is None
    got = lang.predict(frame(spark, [(1, "some text")]), None).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    assert lang.predict(none, None).count() == 0
    one = spark.createDataFrame([(i, "only words", "zz") for i in range(20)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in lang.predict(one, lang.fit(one)).collect()} == {"zz"}


def test_machine_separates():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(80, 6))
    y = np.where(x[:, 0] + 0.5 > 0, 1, -1)
    w = lang.fit_svm(x, y, cost=100.0, turns=300)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


@pytest.mark.parametrize("text", ["", "a", "ab  cd", "Ab!!Cd"])
def test_vectors(text):
    data = np.frombuffer(text.encode(), np.uint8)
    x = lang.vectors(data, np.array([0, len(data)]))
    assert x.shape == (1, lang.DIMENSIONS)
    assert np.isclose((x * x).sum(), 1.0 if text else 0.0)
