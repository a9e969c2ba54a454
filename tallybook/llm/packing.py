"""Best-fit packing planned over the histogram of piece lengths.

Documents are encoded once; only piece lengths and digests leave that pass. Best fit runs over
the counts of at most ``limit`` lengths, on the driver, and gives each length's pieces a list of
slots. Pieces then take slots by their rank within their length. The plan has a bounded size:
it depends on the limit, not on the number of documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import partitions, written
from tallybook.llm.tokens import encoded_runs, encoder, vocabulary_path

LIMIT = 2048
END_ID = 0


def _cut(ids: np.ndarray, bounds: np.ndarray, limit: int) -> Iterator[tuple]:
    """(text, piece, start, ids) of each piece, every text closed by the end id."""
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        own = np.append(ids[a:b], np.uint32(END_ID)).astype("<u4")
        for piece, start in enumerate(range(0, len(own), limit)):
            yield i, piece, start, own[start : start + limit]


def pieces(
    docs: DataFrame,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document's pieces.

    A null text counts as empty: its one piece is the end id. Only texts of more than ``limit``
    ids are cut. Repeated rows give repeated pieces.
    """
    path = path or vocabulary_path()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, bounds in encoded_runs(batch, 1, path):
                rows = [
                    (i, piece, start, len(own), zlib.crc32(own.tobytes()), own)
                    for i, piece, start, own in _cut(ids, bounds, limit)
                ]
                i, piece, start, length, crc, own = zip(*rows, strict=True)
                columns = [
                    batch.column(0).slice(first, len(bounds) - 1).take(pa.array(i, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names)
        encoder(path).forget()  # a worker outlives its tasks

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def best_fit(counts: dict[int, int], limit: int = LIMIT) -> tuple[np.ndarray, int]:
    """Best-fit decreasing over counts: slots and the number of sequences.

    A slot row (length, rank, n, sequence, offset) puts the pieces of that length with ranks
    from ``rank`` to ``rank + n - 1`` at ``offset`` of the sequences from ``sequence`` on, one
    each. Sequences with equal room are handled together, so the work depends on the number of
    lengths alone.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    rooms: list[int] = []  # rooms in order, those of open sequences
    open_runs: dict[int, list[tuple[int, int]]] = {}  # room: runs (first sequence, n)
    made = 0

    def keep(room: int, first: int, n: int) -> None:
        if room <= 0 or not n:
            return
        if not open_runs.get(room):
            open_runs[room] = []
            insort(rooms, room)
        open_runs[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_runs[room].pop()
                if not open_runs[room]:
                    rooms.pop(at)
            else:
                room, first = limit, made
                n = -(-left // (limit // length))
                made += n
            each = room // length  # the fullest sequence that fits takes pieces till it is full
            full = min(n, left // each)
            for k in range(each if full else 0):
                slots.append((length, rank, full, first, limit - room + k * length))
                rank += full
            left -= full * each
            keep(room - each * length, first, full)
            first, n = first + full, n - full
            if left and n:
                for k in range(left):
                    slots.append((length, rank, 1, first, limit - room + k * length))
                    rank += 1
                keep(room - left * length, first, 1)
                first, n, left = first + 1, n - 1, 0
            keep(room, first, n)
    return np.array(sorted(slots), np.int64).reshape(-1, 5), made


def ranked(rows: DataFrame, length_col: str, order: list[str], cells: int) -> DataFrame:
    """Rows with ``rank``, from 0 within their length, without gaps.

    A length that many rows have is dealt over cells; a cell's rows are numbered on their own
    and raised by the number of rows in the cells before it.
    """
    dealt = rows.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    sizes = dealt.groupBy(F.col(length_col).alias("of_length"), F.col("cell").alias("of_cell")).agg(
        F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy("of_length").orderBy("of_cell")
    sizes = sizes.select("of_length", "of_cell", (F.sum("n").over(before) - F.col("n")).alias("n"))
    own = Window.partitionBy(length_col, "cell").orderBy(*order)
    numbered = dealt.withColumn("rank", F.row_number().over(own))
    on = (F.col(length_col) == F.col("of_length")) & (F.col("cell") == F.col("of_cell"))
    return numbered.join(sizes, on).withColumn("rank", F.col("rank") + F.col("n") - 1).drop(
        "cell", "of_length", "of_cell", "n"
    )


def pack(cut: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: sequences of at most ``limit`` tokens.

    Every piece gets one place; a sequence is filled from 0 without gaps. The pieces are written
    to the shared folder first, as both the histogram and the placing read them. Pieces of no
    length or a null one are no pieces and raise an error. No pieces: no rows.
    """
    spark = cut.sparkSession
    cut = written(cut, "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    if any(x is None or not 0 < x <= limit for x in counts):
        raise ValueError(f"pieces need lengths from 1 to {limit}")
    plan, _ = best_fit(counts, limit)
    order = [c for c, kind in cut.dtypes if c != "length" and kind != "array<int>"]
    rows = ranked(cut, "length", order, 4 * partitions(spark))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    names = cut.columns
    share = spark.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = share.value
        keys = slots[:, 0] << 40 | slots[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length << 40 | rank, "right") - 1
            slot = slots[at]
            sequence = slot[:, 3] + rank - slot[:, 1]
            columns = [batch.column(c) for c in names]
            columns += [pa.array(sequence, pa.int64()), pa.array(slot[:, 4], pa.int64())]
            yield pa.record_batch(columns, [*names, "sequence_id", "offset"])

    return rows.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences themselves, of pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
