import random
from collections import Counter

import numpy as np
import pytest

from tallybook.llm import rlz

from .fixtures import awkward, frame, sentence


def brute(rows, width):
    """(words, kept) by counting every window."""
    count = Counter()
    split = [(t or "").encode().split() for _, t in rows]
    for own in split:
        for i in range(len(own) - width + 1):
            count[tuple(own[i : i + width])] += 1
    out = []
    for own in split:
        gone = [False] * len(own)
        for i in range(len(own) - width + 1):
            if count[tuple(own[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(own), sum(gone), b" ".join(w for w, g in zip(own, gone, strict=True) if not g).decode()))
    return out


def result(docs, **more):
    got = rlz.drop_repeats(docs, **more).collect()
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept"]) for r in got)


def expected(rows, width):
    found = brute(rows, width)
    return sorted((d is None, d or 0, *x) for (d, _), x in zip(rows, found, strict=True))


@pytest.mark.parametrize("width", [3, 8, 35])
def test_awkward(spark, width):
    rows = awkward()
    assert result(frame(spark, rows), width=width) == expected(rows, width)


def test_repeats_within_a_document_and_across_boundaries(spark):
    draw = random.Random(9)
    parts = [sentence(draw, 30, 10_000) for _ in range(6)]
    texts = [" ".join(draw.choice(parts) for _ in range(draw.randrange(1, 9))) for _ in range(40)]
    rows = list(enumerate(texts))
    assert result(frame(spark, rows)) == expected(rows, 35)


def test_few_distinct_words(spark):
    draw = random.Random(4)
    rows = [(i, sentence(draw, 120, 2)) for i in range(30)]
    assert result(frame(spark, rows), width=12) == expected(rows, 12)


def test_factors():
    starts, ends = rlz.factors(np.array([2, 3, 4, 9, 20]), 5)
    assert starts.tolist() == [2, 9, 20]
    assert ends.tolist() == [9, 14, 25]
    assert np.flatnonzero(rlz.covered(starts, ends, 30)).tolist() == [*range(2, 14), *range(20, 25)]


def test_empty(spark):
    assert rlz.drop_repeats(frame(spark, [])).count() == 0
