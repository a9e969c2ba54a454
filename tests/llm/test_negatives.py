import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import negatives
from tallybook.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=50, k=5, n=3):
    good = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, x, label in {(i, tuple(v), label) for i, v, label in good if i % every == 0}:
        scored = [(-sum(p * q for p, q in zip(x, y)), i, other) for i, y, other in good if i != a and len(x) == len(y)]
        for score, positive, _ in sorted(s for s in scored if s[2] == label)[:k]:
            fits = sorted(s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score)
            out += [(a, positive, r + 1, i, -score, -s) for r, (s, i, _) in enumerate(fits[:n])]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in OUT) for r in df.collect())


def mined(df, every=50):
    return negatives.hard_negatives(df, F.col("vec_id") % every == 0)


def clustered(n, seed=0, dim=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, dim)) * 2
    return [(i, [float(x) for x in centres[i % 8] + draw.normal(size=dim) * 0.3], int(draw.integers(4))) for i in range(n)]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(negatives, "STEP", 7)
    monkeypatch.setattr(negatives, "CODE_ROWS", 25)


@pytest.mark.parametrize("seed", [0, 1])
def test_against_brute_force(spark, small_blocks, seed):
    rows = clustered(300, seed)
    got = found(mined(spark.createDataFrame(rows, SCHEMA), 10))
    assert got and got == brute(rows, 10)


def test_random_directions(spark, small_blocks):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.normal(size=16)], i % 3) for i in range(250)]
    assert found(mined(spark.createDataFrame(rows, SCHEMA), 10)) == brute(rows, 10)


def test_one_vector_and_one_label_hold_most_rows(spark, small_blocks):
    draw = random.Random(4)
    rows = [(i, [1.0, 0.5, 0.25], 1) for i in range(150)]
    rows += [(i, [draw.random(), draw.random(), draw.random()], draw.randrange(3)) for i in range(150, 260)]
    got = found(mined(spark.createDataFrame(rows, SCHEMA), 10))
    assert got and got == brute(rows, 10)


def test_awkward_rows(spark, small_blocks):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.0, 1.0], 2), (50, [0.0, 0.0], 1), (100, [-1.0, -1.0], 1)]
    rows += [(150, [1.0, 0.5], None), (200, None, 1), (250, [1.0, None], 1), (300, [nan, 1.0], 1), (350, [inf, 1.0], 2)]
    rows += [(None, [1.0, 1.0], 1), (400, [], 1), (401, [], 1), (402, [], 2), (450, [1.0, 1.0, 1.0], 1), (451, [1.0, 1.0, 1.0], 1)]
    rows += [(452, [0.8, 0.8, 0.8], 2), (3, [0.0, 0.0], 2), (4, [0.0, 0.0], 1)]
    rows += [(i, [0.9 - i / 100, 0.1], i % 3) for i in range(5, 40)] * 2  # repeated rows and ties
    got = found(mined(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert any(r[0] == 400 for r in got) and any(r[0] == 450 for r in got) and any(r[0] == 50 for r in got)


def test_few_rows_empty_table_and_clashing_columns(spark):
    schema = "vec_id long, embedding array<float>, label int, q string, code int, anchor string, rank int, dim int, deal int"
    assert mined(spark.createDataFrame([], schema)).count() == 0
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 0.0], 2), (7, [0.5, 0.5], 3)]
    df = spark.createDataFrame([(*r, "x", 1, "y", 2, 3, 4) for r in rows], schema)
    assert found(mined(df)) == brute(rows) == [(0, 1, 1, 2, 65536, 49152), (0, 1, 2, 7, 65536, 32768)]
    assert mined(df.filter("vec_id > 0")).count() == 0
    assert mined(df.filter("label = 1")).count() == 0


def test_large_components(spark):
    big = float(1 << 22)  # products beyond 2**53, within 63 bits
    rows = [(i, [big + i / 256, -big / 3, 1.0], i % 2) for i in range(12)] + [(20, [big * 0.8, 1.0, 2.0], 1)]
    assert found(mined(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    huge = spark.createDataFrame([(0, [1e300], 1), (1, [1e300], 1), (2, [1e300], 2)], SCHEMA)
    with pytest.raises(Exception, match="63 bits"):
        mined(huge).collect()


def test_walks_end_early_on_clustered_vectors():
    """Far fewer scores than candidates times members, and the same result."""
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 16)) * 200
    x = np.round(centres[np.arange(4000) % 20] + draw.normal(size=(4000, 16)) * 5).astype(np.int64)
    members = x[:200:20]
    ids, labels = np.arange(4000), np.arange(4000) % 3
    of = labels[:200:20]
    windows = [[(-negatives.MOST, negatives.MOST)]] * len(members)
    found, scored = negatives.walk(x, ids, lambda i: labels == of[i], members, ids[:200:20], windows, 5, 64)
    assert scored < 0.2 * len(x) * len(members)
    for i in range(len(members)):
        scores = members[i] @ x.T
        fine = [j for j in np.lexsort((ids, -scores)) if labels[j] == of[i] and j != 20 * i][:5]
        assert sorted(r[2] for r in found if r[0] == i) == sorted(fine)


def test_codes_that_cannot_qualify_are_not_asked(spark, small_blocks):
    rows = clustered(400, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    placed = df.select("vec_id", "label", negatives.scaled(F.col("embedding")).alias("q")).withColumns(
        {"is_anchor": F.lit(True), "dim": F.size("q")}
    )
    q = np.array([r["q"] for r in placed.select("q").collect()])
    books = {6: negatives.codebook(q, 8)}
    placed = negatives._placed(placed, books)
    cones = np.array([tuple(r)[1:] for r in placed.groupBy("code").agg(F.max("norm"), F.max("angle")).orderBy("code").collect()])
    asking = placed.select(
        F.col("vec_id").alias("anchor"), "vec_id", "label", "q", "dim", "code",
        F.array(F.lit(0)).cast("array<long>").alias("low"), F.array(F.lit(0)).cast("array<long>").alias("high"),
        (0.5 * F.col("norm") * F.col("norm")).alias("need"), F.lit(False).alias("skip_own"),
    )
    visits = negatives._visits(asking, books, {6: cones})
    assert visits.count() < 0.6 * 400 * len(cones)


def test_given_vectors(spark):
    vectors = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in vectors.collect()]
    assert found(mined(vectors)) == brute(rows)
