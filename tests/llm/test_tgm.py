import random
import re
from pathlib import Path

import numpy as np
import pytest

from tallybook.llm import graph, tgm
from tallybook.llm.common import written

from tests.fixtures import rows_of

from .fixtures import awkward, frame, sentence


def find(parent, a):
    while parent[a] != a:
        parent[a] = parent[parent[a]]
        a = parent[a]
    return a


def brute(rows, percent=90, shingle=3):
    sets = []
    for _, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        own = re.findall(r"[^\x20\x09-\x0D]+", lower)
        grams = {tuple(own[i : i + shingle]) for i in range(len(own) - shingle + 1)}
        sets.append(grams or ({tuple(own)} if own else set()))
    parent = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * len(a | sets[j]):
                parent[find(parent, i)] = find(parent, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            root = find(parent, i)
            least[root] = min(least.get(root, doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        # without shingles a document is its own component
        out.append((doc, len(sets[i]), least.get(find(parent, i)) if sets[i] else doc))
    return out


def compare(spark, rows, **more):
    got = tgm.jaccard_components(frame(spark, rows), **more).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, **more), key=key)


def family(draw, n, size, edits):
    base = sentence(draw, size, 100_000).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(draw.randrange(edits + 1)):
            own[draw.randrange(len(own))] = f"e{draw.randrange(10_000)}"
        out.append(" ".join(own))
    return out


def test_awkward(spark):
    compare(spark, awkward())


@pytest.mark.parametrize(("seed", "percent"), [(1, 90), (2, 80)])
def test_families_around_the_threshold(spark, seed, percent):
    draw = random.Random(seed)
    passage = sentence(draw, 40, 100_000)
    texts = []
    for _ in range(12):
        texts += family(draw, draw.randrange(2, 12), draw.randrange(30, 150), 6)
    texts += family(draw, 150, 90, 8)  # more than a group holds
    texts += [sentence(draw, 60, 100_000) + " " + passage for _ in range(30)]
    texts += [sentence(draw, draw.randrange(1, 6), 4) for _ in range(60)]
    draw.shuffle(texts)
    compare(spark, [(i + 10, t) for i, t in enumerate(texts)], percent=percent)


def test_chain_of_links(spark):
    """Each text is linked with the next only."""
    draw = random.Random(6)
    own = sentence(draw, 400, 100_000).split()
    rows = [(100 - i, " ".join(own[i * 8 : i * 8 + 200])) for i in range(20)]
    compare(spark, rows)


def test_empty(spark):
    assert tgm.jaccard_components(frame(spark, [])).count() == 0
    compare(spark, [(1, None), (1, ""), (2, "  ")])


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(120), draw.randrange(120)) for _ in range(70)]
    links += [(500 + i, 501 + i) for i in range(40)] + [(900, 900 + i) for i in range(30)]
    parent = {x: x for link in links for x in link}
    for a, b in links:
        parent[find(parent, a)] = find(parent, b)
    got = {r["node"]: r["comp"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got) == {x for a, b in links if a != b for x in (a, b)}
    for a in got:
        for b in got:
            assert (got[a] == got[b]) == (find(parent, a) == find(parent, b))


def test_intermediate_tables_are_removed(spark):
    """What is left of the work is what the result reads; it can be read again and again."""
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.iterdir())
    rows = awkward()
    found = tgm.jaccard_components(frame(spark, rows))
    left = {p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - before}
    assert left == {"named", "least"}
    assert rows_of(found) == rows_of(found) and found.count() == len(rows)


def test_hosts_and_visitors_share_the_exchange_of_sets(spark):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        tokens = [np.arange(a, a + 20, dtype=np.uint64).tobytes() for a in (0, 1, 40)]
        names = [bytes([i]) for i in range(3)]
        sets = written(spark.createDataFrame(list(zip(names, tokens, strict=True)), "print binary, tokens binary"), "sets")
        members = [(names[0], names[0], names[0], 0), (names[2], names[2], names[2], 0)]
        visits = [(names[1], names[1], names[0], 0), (names[1], names[1], names[2], 0)]
        columns = "print binary, comp binary, lead binary, part int"
        links = tgm._opened(spark.createDataFrame(visits, columns), spark.createDataFrame(members, columns), sets, 90)
        assert "ReusedExchange" in links._jdf.queryExecution().executedPlan().toString()
        assert [(bytes(a), bytes(b)) for a, b in links.collect()] == [(names[1], names[0])]
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
