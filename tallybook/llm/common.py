"""What the operators share: readers, shared tables, hashing of texts in numpy, packed keys.

A *group* is a bounded share of the documents, dealt by a hash of the identifier; a *block* is a
bounded share of a key space. Groups and blocks exchange keys as packed arrays, one row for each
(group, block), so that a key costs its own bytes and no row of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.sources.shared import shared_folder

# The bytes that part words: space and 0x09 to 0x0D.
BREAKS = np.zeros(256, bool)
BREAKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BREAK_CLASS = r"[\x20\x09-\x0D]+"

# Texts are hashed in runs of about this many bytes, which bounds a task's arrays.
RUN_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}
_BYTE = np.random.default_rng(20_240_501).integers(0, 2**64, 256, dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SCRATCH: list[list[tuple[str, str]]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the cluster's shared folder and read again: cuts the lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    if _SCRATCH:
        _SCRATCH[-1].append((name, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, keep: tuple[str, ...]) -> Iterator[None]:
    """Tables ``written`` within are removed at the end, but for those whose names start with one
    of ``keep``: what comes out may read no others, except through tables written from them."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        made = _SCRATCH.pop()
        kept = [x for x in made if x[0].startswith(keep)]
        if _SCRATCH:
            _SCRATCH[-1].extend(kept)
        jvm = spark.sparkContext._jvm
        for _, path in made:
            if not any(path == other for _, other in kept):
                folder = jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def words(text: Column) -> Column:
    """The words of a text: runs of anything but space and 0x09 to 0x0D. Null: none."""
    found = F.filter(F.split(text, BREAK_CLASS), lambda x: x != F.lit(""))
    return F.coalesce(found, F.array().cast("array<string>"))


def grouped(docs: DataFrame, id_col: str, groups: int) -> DataFrame:
    return docs.withColumn("grp", F.pmod(F.xxhash64(F.col(id_col)), F.lit(groups)).cast("int"))


def _powers(kind: str, n: int) -> np.ndarray:
    """Powers of the base (or of its inverse) modulo 2**64."""
    have = _POWERS.get(kind)
    if have is None or len(have) < n:
        step = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        size = max(n, 2 * RUN_BYTES)
        line = np.full(size, step, np.uint64)
        line[0] = 1
        have = _POWERS[kind] = np.multiply.accumulate(line)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of the base, from which any span is hashed."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers("up", len(values))[: len(values)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the values from start to end, by content and length alone."""
    back = _powers("down", len(sums))
    lengths = (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix((sums[end] - sums[start]) * back[start] + lengths)


def windows(sums: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all spans of one width."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    back = _powers("down", len(sums))[:n]
    return mix((sums[width:] - sums[:n]) * back + np.uint64(width * 0xD6E8FEB86659FD93 % 2**64))


def text_runs(texts: pa.ChunkedArray | pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple]:
    """Slices of the texts as (first row, bytes, offsets), of about ``limit`` bytes each.

    A null text counts as an empty one. A longer text makes a slice of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, raw_offsets, data = texts.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[texts.offset : texts.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield first, whole[own[0] : own[-1]], own - own[0]
        first = last


# Words of more bytes are digested one by one; a slice of texts has few of them.
LONG_WORD = 512


def word_keys(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of words by their bytes and length.

    Eight bytes at a time go through ``mix``, which is not linear: unlike sums of powers, no words
    of special form share a key whatever the constants.
    """
    sizes = ends - starts
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(text) + 1,), np.uint64, padded.data, strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    keys = mix(sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(_BASE))
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        told = hashlib.blake2b(text[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        keys[i] ^= np.uint64(int.from_bytes(told, "little"))
    which = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD))
    at, left = starts[which], sizes[which]
    while len(which):
        chunk = eight[at] & masks[np.minimum(left, 8)]
        keys[which] = mix((keys[which] ^ chunk) + np.uint64(_BASE))
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    return keys


def byte_values(text: np.ndarray) -> np.ndarray:
    return _BYTE[text]


def word_bounds(
    text: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = BREAKS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of its first word."""
    n = len(text)
    inside = ~breaks[text]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each item between the bounds the number of its interval."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def first_least(keys: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` keys the place of its first least key.

    Keys are compared by their high 40 bits and then by place, so the choice depends on the
    window's content alone: equal windows choose the same place within them.
    """
    n = len(keys)
    if n < width:
        return np.zeros(0, np.int64)
    if n >= 1 << 24:  # a run of one very long text: in parts that overlap
        part = 1 << 23
        return np.concatenate(
            [
                first_least(keys[i : i + part + width - 1], width) + i
                for i in range(0, n - width + 1, part)
            ]
        )
    low = np.uint64((1 << 24) - 1)
    least = (keys & ~low) | np.arange(n, dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: n - width + 1], least[width - span :])
    return (least & low).astype(np.int64)


def up_to_twice(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order, those that occur more than once given twice."""
    if not len(keys):
        return keys
    keys = np.sort(keys)
    same = np.zeros(len(keys), bool)
    same[1:] = keys[1:] == keys[:-1]
    third = same.copy()
    third[1:] &= same[:-1]
    third[:1] = False
    return keys[~third]


def pack(keys: np.ndarray, block_of: np.ndarray, grp: int, blocks: int) -> list[tuple]:
    """Keys as (block, grp, packed keys), one for each block that gets any. In order stays in order."""
    order = np.argsort(block_of, kind="stable")
    keys, block_of = keys[order], block_of[order]
    cuts = np.searchsorted(block_of, np.arange(blocks + 1))
    return [
        (b, grp, keys[cuts[b] : cuts[b + 1]].tobytes())
        for b in range(blocks)
        if cuts[b] < cuts[b + 1]
    ]


CELL = "block int, grp int, keys binary"
CELL_ARROW = pa.schema([("block", pa.int32()), ("grp", pa.int32()), ("keys", pa.binary())])
REPLY = "grp int, keys binary"
REPLY_ARROW = pa.schema([("grp", pa.int32()), ("keys", pa.binary())])


def cells_table(cells: list[tuple]) -> pa.Table:
    columns = list(zip(*cells, strict=True)) if cells else [(), (), ()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, CELL_ARROW.types, strict=True)], CELL_ARROW)


def unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """All packed keys of a column, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def repeated(cells: DataFrame, kind: type) -> DataFrame:
    """(grp, keys): for each cell those of its keys that its block has seen twice or more.

    A block sees each key of a group at most twice, however many rows have it, so a frequent
    key is no hot task.
    """

    def judge(cell: pa.Table) -> pa.Table:
        packed = [np.frombuffer(x, kind) for x in cell["keys"].to_pylist()]
        keys = np.concatenate(packed)
        distinct, place, count = np.unique(keys, return_inverse=True, return_counts=True)
        hit = (count > 1)[place]
        # within a cell keys are in order: a key given twice is replied once
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        bounds = np.cumsum([0, *map(len, packed)])
        first[bounds[:-1]] = True
        hit &= first
        out = [keys[a:b][hit[a:b]].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        some = [bool(x) for x in out]
        return pa.table(
            [cell["grp"].combine_chunks().cast(pa.int32()), pa.array(out, pa.binary())], REPLY_ARROW
        ).filter(pa.array(some, pa.bool_()))

    return cells.groupBy("block").applyInArrow(judge, REPLY)
