import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import ann
from tallybook.llm.common import table

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    """Per query (id, score) of the k best."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if _fine(i, v)]
    out = {}
    for q, y in good:
        if q % every == 0:
            scored = [(-(x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())), i) for i, x in good if i != q]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def _fine(i, v):
    return i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return out


def test_recall(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    got = found(ann.nearest(vectors, F.col("vec_id") % 50 == 0))
    expected = brute([(r[0], r[1]) for r in vectors.collect()], 50, 5)
    assert set(got) == set(expected)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 5 for q in expected]
    assert np.mean(hits) >= 0.9
    assert all(len(x) == 5 for x in got.values())


def test_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(10, 40)]
    rows += [(0, [2.0, 0.0, 1.0]), (50, [1.0, 0.0, 0.5]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0])]
    rows += [(6, [float("nan"), 1.0, 1.0]), (7, [float("inf"), 1.0, 1.0]), (8, [1.0]), (None, [1.0, 1.0, 1.0]), (9, [])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("bucket", F.lit("x"))
    got = found(ann.nearest(df, F.col("vec_id") % 50 == 0))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {0: [10, 11, 12, 13, 14], 50: [0, 10, 11, 12, 13]}


def test_few_vectors_are_all_found(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, 1.0]), (3, [0.3, -1.0])]
    got = found(ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    expected = brute(rows, 50, 5)
    assert [i for i, _ in got[0]] == [i for i, _ in expected[0]]
    assert [s for _, s in got[0]] == pytest.approx([s for _, s in expected[0]])
    one = spark.createDataFrame([(0, [1.0, 0.0])], SCHEMA)
    assert ann.nearest(one, F.col("vec_id") % 50 == 0).count() == 0
    assert ann.nearest(one.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_large_buckets_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET_ROWS", 7)
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.normal(size=4) + (8 if i % 3 else 0)]) for i in range(300)]
    got = found(ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    expected = brute(rows, 50, 5)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 5 for q in expected]) >= 0.9


def test_probes_come_in_order_of_cost():
    below = np.array([0.1, 0.45, 0.7])
    steps = ann.perturbations(below, 20)
    cost = [sum((below[j] if s < 0 else 1 - below[j]) ** 2 for j, s in enumerate(row) if s) for row in steps.tolist()]
    assert cost == sorted(cost)
    assert len({tuple(r) for r in steps.tolist()}) == len(steps) == 20
