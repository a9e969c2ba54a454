import random
import zlib

import numpy as np
import pytest

from tallybook.llm import packing, tokens

from .fixtures import awkward, frame


def fill(counts, limit):
    """Best fit decreasing, piece by piece."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(limit - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    draw = random.Random(seed)
    limit = draw.choice([1, 7, 50, 64])
    counts = {draw.randrange(1, limit + 1): draw.randrange(1, 60) for _ in range(20)}
    slots, made = packing.best_fit(counts, limit)
    used = {}
    for length in counts:
        own = slots[slots[:, 0] == length]
        assert own[:, 2].sum() == counts[length]
        assert own[:, 1].tolist() == (np.cumsum(own[:, 2]) - own[:, 2]).tolist()
    for length, _, n, first, offset in slots.tolist():
        for s in range(first, first + n):
            used.setdefault(s, []).append((offset, length))
    assert sorted(used) == list(range(made))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    assert made == fill(counts, limit)


def test_pack_round_trip(spark):
    encoder = tokens.encoder(tokens.vocabulary_path())
    rows = [r for r in awkward() if r[0] is not None]
    cut = packing.pieces(frame(spark, rows), limit=64, with_ids=True)
    packed = packing.pack(cut, limit=64)
    got = packed.collect()
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    ids = [[*encoder.library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows]
    assert len(got) == sum(-(-len(x) // 64) for x in ids)
    assert max(map(len, whole.values())) <= 64
    assert sum(map(len, whole.values())) == sum(map(len, ids))
    by_doc = {}
    for (doc, _), own in zip(rows, ids, strict=True):
        by_doc.setdefault(doc, own)
    for r in got:
        own = np.array(by_doc[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert len(own) == r["length"] == min(64, len(by_doc[r["doc_id"]]) - r["start"])
        assert r["start"] == 64 * r["piece"]
        assert r["ids_crc32"] == zlib.crc32(own.tobytes())
        placed = whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert placed == own.tolist()


def test_hot_length_is_ranked_in_cells(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, id % 7 + 1, 5) as length")
    got = packing.ranked(rows, "length", ["id"], 16).collect()
    for length in {r["length"] for r in got}:
        ranks = sorted(r["rank"] for r in got if r["length"] == length)
        assert ranks == list(range(len(ranks)))


def test_empty_and_bad(spark):
    assert packing.pack(packing.pieces(frame(spark, []))).count() == 0
    bad = spark.createDataFrame([(1, 0, 0, 0, 0)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    with pytest.raises(ValueError):
        packing.pack(bad)
