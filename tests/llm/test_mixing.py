import random

import pytest

from tallybook.llm import mixing

from .fixtures import SCHEMA, awkward, frame, sentence, words_of


def shares(sizes, most=3):
    """Targets by sharing out again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > most * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def corpus(seed=2, n=600):
    draw = random.Random(seed)
    names = ["a", "b", "Z", "é", None, "tiny", "empty"]
    rows = []
    for i in range(n):
        source = draw.choices(names, [9, 3, 2, 1, 1, 0.1, 0.5])[0]
        text = None if source == "empty" else sentence(draw, draw.randrange(0, 80))
        rows.append((i, text, "en", source, 0))
    return rows


def test_targets_and_sums(spark):
    rows = corpus()
    got = mixing.mix(frame(spark, rows)).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(by_id) == len(rows)
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    target = shares(sizes)
    for source in sizes:
        own = [by_id[r[0]] for r in rows if r[3] == source]
        assert {r["source_size"] for r in own} == {sizes[source]}
        assert {round(r["target"], 6) for r in own} == {round(target[source], 6)}
        assert abs(sum(r["taken"] for r in own) - target[source]) <= max(r["size"] for r in own)
        assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in own)
    for i, text, *_ in rows:
        assert by_id[i]["size"] == len(words_of(text))


def test_several_levels_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rows = corpus(3)
    docs = frame(spark, rows)
    one = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    two = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(5, "text")).collect()}
    assert one == two
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    for source, goal in shares(sizes).items():
        taken = sum(one[r[0]] for r in rows if r[3] == source)
        assert abs(taken - goal) <= 80


def test_draws_are_fair():
    import numpy as np

    size = np.array([3.0, 5.0, 7.0, 2.0, 9.0])
    part = np.array([0.3, 0.6, 0.5, 0.9, 0.2])
    runs = np.array([mixing._trade(size, part, s) for s in range(4000)])
    assert np.allclose((runs * size).sum(axis=1), (part * size).sum())
    assert (((runs > 0) & (runs < 1)).sum(axis=1) <= 1).all()
    assert np.allclose(runs.mean(axis=0), part, atol=0.03)


def test_repeat_and_awkward_rows(spark):
    docs = frame(spark, corpus(4, 80)).withColumnRenamed("n_chars", "cell")
    mixed = mixing.mix(docs)
    again = mixing.repeat(docs, mixed)
    assert again.columns == docs.columns
    assert again.count() == sum(r["copies"] for r in mixed.collect())
    rows = awkward()
    assert mixing.mix(frame(spark, rows)).count() == len(rows)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    lonely = mixing.mix(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in lonely] == [(0, 0.0, 0)]


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10}, {"a": 1, "b": 1000, "c": 3}, {"x": 5, None: 100, "y": 1}])
def test_levels(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(shares(sizes))
