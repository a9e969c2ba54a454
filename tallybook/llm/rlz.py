"""Substring deduplication by relative Lempel-Ziv parsing.

The reference is the whole corpus, indexed in blocks by the content of its windows of ``width``
words. A document is parsed greedily from its first word on: a factor is the longest run of words
all of whose windows the blocks have seen elsewhere, what lies between factors is literal. Every
block is asked about every window it could hold: a window's place in a block follows from its
content alone. As windows are asked one by one, those across the boundary of two factors are
checked like the others. Words under a factor are removed.

Only windows near repeated anchors are asked. An anchor is the least of a window's shorter runs
of ``ANCHOR`` words; equal windows have equal anchors, so a window whose anchor occurs once in
the corpus occurs once itself. Anchors are compared by 32 bits beside their block, which can let
windows through but lose none; windows by 64 bits.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import (
    CELL,
    cells_table,
    first_least,
    grouped,
    pack,
    partitions,
    prefix,
    repeated,
    text_runs,
    unpacked,
    up_to_twice,
    windows,
    word_bounds,
    word_keys,
)

WIDTH = 35
ANCHOR = 8


def _block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)


def _low(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _hashed(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums over the words' hashes, and the first word of each text."""
    starts, ends, bounds = word_bounds(text, offsets)
    return prefix(word_keys(text, starts, ends)), bounds


def _whole(bounds: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which windows lie within one text."""
    start = np.arange(max(n - width + 1, 0))
    last = np.repeat(bounds[1:], np.diff(bounds))[: len(start)]
    return start + width <= last


def _anchored(text: np.ndarray, offsets: np.ndarray, width: int, anchor: int) -> tuple:
    sums, bounds = _hashed(text, offsets)
    keys = windows(sums, anchor)
    pick = first_least(keys, width - anchor + 1)
    return sums, keys, pick, _whole(bounds, width, len(sums) - 1)


def _in(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among the known ones, which are in order."""
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys


def factors(hits: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the factors whose windows begin at ``hits``, which are in order."""
    if not len(hits):
        return hits, hits
    new = np.ones(len(hits), bool)
    new[1:] = hits[1:] != hits[:-1] + 1
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(hits)] - 1
    return hits[first], hits[last] + width


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie within any of the spans."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def drop_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """(id, n_words, n_removed, n_factors, kept) of every document.

    ``kept`` holds the words left, joined by one space. A word is removed if any window of
    ``width`` words that covers it occurs elsewhere, in another document or in the same one; all
    copies go, and windows are judged on the input. Texts that are null, empty or shorter than
    a window lose nothing (null: no words, kept empty). Repeated rows are documents of their
    own, so they lose all their windows. A null identifier is a value like any other.

    Each document crosses the network once; anchors and windows go to their blocks packed, at
    most twice from any group of documents, however many copies there are.
    """
    anchor = min(ANCHOR, width)
    spark = docs.sparkSession
    groups, blocks = 3 * partitions(spark), partitions(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    dealt = grouped(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), "doc", groups)

    def anchors(group: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for _, text, offsets in text_runs(group["text"]):
            _, keys, pick, whole = _anchored(text, offsets, width, anchor)
            found.append(keys[np.unique(pick[whole])])
        keys = up_to_twice(np.concatenate(found))
        return cells_table(pack(_low(keys), _block_of(keys, blocks), group["grp"][0].as_py(), blocks))

    def asked(group: pa.Table, reply: pa.Table) -> pa.Table:
        known = np.sort(unpacked(reply["keys"], np.uint32))
        found = [np.zeros(0, np.uint64)]
        if len(known):
            for _, text, offsets in text_runs(group["text"]):
                sums, keys, pick, whole = _anchored(text, offsets, width, anchor)
                places = np.unique(pick[whole])
                seen = np.zeros(len(keys), bool)
                seen[places] = _in(_low(keys[places]), known)
                found.append(windows(sums, width)[whole & seen[pick]])
        keys = up_to_twice(np.concatenate(found))
        grp = group["grp"][0].as_py() if len(group) else 0
        return cells_table(pack(keys, _block_of(keys, blocks), grp, blocks))

    def parsed(group: pa.Table, reply: pa.Table) -> pa.Table:
        known = np.sort(unpacked(reply["keys"], np.uint64))
        n_words, n_removed, n_factors, kept = [], [], [], []
        for _, text, offsets in text_runs(group["text"]):
            sums, bounds = _hashed(text, offsets)
            hits = np.zeros(0, np.int64)
            if len(known):
                whole = np.flatnonzero(_whole(bounds, width, len(sums) - 1))
                hits = whole[_in(windows(sums, width)[whole], known)]
            # a factor ends with its text
            cut = np.searchsorted(hits, bounds)
            gone = np.zeros(len(sums) - 1, bool)
            data = text.tobytes()
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                starts, ends = factors(hits[cut[i] : cut[i + 1]], width)
                own = data[offsets[i] : offsets[i + 1]].split()
                if len(starts):
                    gone[a:b] = covered(starts - a, ends - a, b - a)
                    own = list(compress(own, (~gone[a:b]).tolist()))
                n_words.append(b - a)
                n_removed.append(b - a - len(own))
                n_factors.append(len(starts))
                kept.append(b" ".join(own).decode())
        return pa.table(
            {
                "doc": group["doc"],
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "n_factors": pa.array(n_factors, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )

    near = repeated(dealt.groupBy("grp").applyInArrow(anchors, CELL), np.uint32)
    by_group = dealt.groupBy("grp")
    windows_asked = by_group.cogroup(near.groupBy("grp")).applyInArrow(asked, CELL)
    elsewhere = repeated(windows_asked, np.uint64)
    return by_group.cogroup(elsewhere.groupBy("grp")).applyInArrow(
        parsed, f"doc {kind}, n_words long, n_removed long, n_factors long, kept string"
    ).withColumnRenamed("doc", id_col)
