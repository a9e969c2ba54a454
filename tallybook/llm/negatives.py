"""Hard negatives: rows of other labels that score high, but well below an anchor's positives.

Exact search by shared lists. A codebook of directions, fitted on a bounded sample, parts rows and
anchors into cones. An anchor asks only codes whose cone can hold a score it still needs. There a
cluster's anchors share one list: the candidates by falling bound |x| cos(max(0, angle(x, centre) -
radius)), which no member's score per length of its vector can exceed. Every member walks the list
until what is left is certified: below the worst of the scores it keeps, or below its window. The
codebook decides how far they walk and never what is found.

Scores are integer inner products. They are taken in double precision where that is exact, and else
in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative's score lies from 50 to 95 percent of the positive's.
LEAST_PERCENT, MOST_PERCENT = 50, 95

# The codebook is fitted on at most this many rows, chosen by hash. It has a code for every
# CODE_ROWS rows, up to CODES.
SAMPLE_ROWS = 8192
CODES = 64
CODE_ROWS = 4096
ROUNDS = 8
# Candidates and anchors that meet in one task, and candidates that are scored at once.
BLOCK_ROWS = 32_768
BLOCK_ANCHORS = 8_192
STEP = 1024
# Bounds are widened by this share against rounding (an angle near 0 is known to some 1e-8).
SLACK = 1e-7
MOST = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def scaled(vector: Column) -> Column:
    """Components as whole numbers: floor(256 x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a zero vector has the direction zero."""
    x = x.astype(np.float64)
    norms = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norms > 0, norms, 1.0)[:, None], norms


def codebook(sample: np.ndarray, codes: int = CODES, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of direction, by spherical k-means from evenly chosen rows."""
    unit, norms = _unit(sample)
    unit = unit[norms > 0]
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    centres = unit[np.linspace(0, len(unit) - 1, min(codes, len(unit))).astype(int)]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        moved, lengths = _unit(sums)
        centres = np.where(lengths[:, None] > 0, moved, centres)
    return np.unique(centres, axis=0)


_PLACED = "vec_id long, label int, q array<long>, is_anchor boolean, dim int, code int, norm double, angle double"


def _angles(unit: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centre, -1.0, 1.0))


def _placed(rows: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """Rows with their code, length and angle to the code's centre."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            code, norm, angle = np.zeros(n, np.int32), np.zeros(n), np.zeros(n)
            dims = batch.column(4).to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                unit, norm[at] = _unit(_matrix(batch.column(2).take(pa.array(at)), dim))
                likeness = unit @ books[dim].T
                code[at] = likeness.argmax(axis=1)
                angle[at] = np.arccos(np.clip(likeness.max(axis=1), -1.0, 1.0))
            columns = [*batch.columns, pa.array(code), pa.array(norm), pa.array(angle)]
            yield pa.record_batch(columns, [*batch.schema.names, "code", "norm", "angle"])

    return rows.mapInArrow(place, _PLACED)


def _visits(anchors: DataFrame, books: dict[int, np.ndarray], cones: dict[int, np.ndarray]) -> DataFrame:
    """The anchors once for each code whose cone may hold a score of ``need`` or more.

    ``cones`` has a row (greatest length, greatest angle) for each code of a dimension, with a
    negative length where a code has no rows.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                dims, own = batch["dim"].to_numpy(), batch["code"].to_numpy()
                need = batch["need"].to_numpy(zero_copy_only=False)
                skip = batch["skip_own"].to_numpy(zero_copy_only=False)
                rows, codes = [], []
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    unit, norms = _unit(_matrix(batch["q"].take(pa.array(at)), dim))
                    longest, widest = cones[dim].T
                    apart = np.maximum(0.0, np.arccos(np.clip(unit @ books[dim].T, -1.0, 1.0)) - widest)
                    bound = norms[:, None] * longest * np.cos(apart)
                    bound += SLACK * norms[:, None] * np.abs(longest) + SLACK
                    open_ = (bound >= need[at][:, None]) & (longest >= 0)
                    open_[skip[at], own[at][skip[at]]] = False
                    i, c = np.nonzero(open_)
                    rows.append(at[i])
                    codes.append(c)
                i = np.concatenate(rows)
                taken = batch.select(_ANCHOR_NAMES).take(pa.array(i))
                yield taken.append_column("visit", pa.array(np.concatenate(codes), pa.int32()))

    return anchors.select(*_ANCHOR_NAMES, "need", "skip_own").mapInArrow(spread, f"{_ANCHOR}, visit int")


_ANCHOR = "anchor long, vec_id long, label int, q array<long>, dim int, code int, low array<long>, high array<long>"
_ANCHOR_NAMES = ["anchor", "vec_id", "label", "q", "dim", "code", "low", "high"]
_FOUND = "anchor long, slot int, vec_id long, score long"


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` with all of ``b``."""
    if not len(a) or not len(b) or not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    most = max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min())) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    raise ValueError("a score would exceed 63 bits")


def walk(
    x: np.ndarray,
    ids: np.ndarray,
    fits: Callable[[int], np.ndarray],
    members: np.ndarray,
    own: np.ndarray,
    windows: list[list[tuple[int, int]]],
    keep: int,
    step: int = STEP,
) -> tuple[list[tuple[int, int, int, int]], int]:
    """(member, slot, id, score): for each member and window of scores the ``keep`` best of ``x``.

    ``x`` are the candidates' vectors, ``members`` those of a cluster's anchors and ``own`` their
    identifiers; ``fits(i)`` says which candidates suit member i. The second result is the number
    of scores that were taken.
    """
    unit, norms = _unit(x)
    towards, lengths = _unit(members)
    centre, size = _unit(towards.sum(axis=0)[None])
    radius = _angles(towards, centre[0])[lengths > 0].max(initial=0.0) if size[0] > 0 else np.pi
    bound = norms * np.cos(np.maximum(0.0, _angles(unit, centre[0]) - radius - SLACK))
    bound += SLACK * norms
    order = np.argsort(-bound, kind="stable")
    bound = np.append(bound[order], -np.inf)
    best: dict[tuple[int, int], list[tuple[int, int]]] = {}
    active = list(range(len(members)))
    scored = 0
    for at in range(0, len(order), step):
        going = []
        for i in active:
            limit = float(bound[at] * lengths[i] + SLACK * abs(bound[at]) * lengths[i] + SLACK)
            if any(not _settled(best.get((i, s), []), low, limit, keep) for s, (low, _) in enumerate(windows[i])):
                going.append(i)
        active = going
        if not active:
            break
        part = order[at : at + step]
        scores = exact_products(members[active], x[part])
        scored += scores.size
        for i, row in zip(active, scores, strict=True):
            fine = fits(i)[part] & (ids[part] != own[i])
            for s, (low, high) in enumerate(windows[i]):
                hits = np.flatnonzero(fine & (row >= low) & (row <= high))
                if not len(hits):
                    continue
                held = best.get((i, s), [])
                if len(hits) > keep:
                    cut = np.partition(row[hits], len(hits) - keep)[len(hits) - keep]
                    hits = hits[row[hits] >= cut]
                held = held + [(-int(row[j]), int(ids[part[j]])) for j in hits]
                best[i, s] = sorted(held)[:keep]
    return [(i, s, name, -score) for (i, s), held in best.items() for score, name in held], scored


def _settled(held: list[tuple[int, int]], low: int, limit: float, keep: int) -> bool:
    """Nothing of at most ``limit`` can join what is held: it is too low, or worse than all kept."""
    return limit < low or (len(held) == keep and limit < -held[-1][0])


def _searched(rows: DataFrame, visits: DataFrame, keep: int, same_label: bool) -> DataFrame:
    """(anchor, slot, vec_id, score): each anchor's best of the codes it visits, for each window.

    Codes are dealt out in blocks of some ``BLOCK_ROWS`` rows, and their visitors in chunks of
    ``BLOCK_ANCHORS``, so that neither side of a task grows with a busy code.
    """
    held = rows.groupBy("dim", "code").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    asked = visits.groupBy("dim", F.col("visit").alias("code")).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ANCHORS).alias("chunks"))
    plan = written(held.join(asked, ["dim", "code"]), "plan")

    def numbers(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))

    left = (
        rows.join(plan, ["dim", "code"])
        .withColumn("block", F.pmod("deal", "blocks"))
        .withColumn("chunk", numbers("chunks"))
        .select("dim", "code", "block", "chunk", "vec_id", "label", "q")
    )
    named = plan.withColumnRenamed("code", "visit")
    right = (
        visits.join(named, ["dim", "visit"])
        .withColumn("chunk", F.pmod(F.xxhash64("anchor"), "chunks"))
        .withColumn("block", numbers("blocks"))
    )

    def meet(asking: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(asking) and len(candidates):
            dim = asking["dim"][0].as_py()
            asking = asking.combine_chunks()
            x = _matrix(candidates["q"].combine_chunks(), dim)
            ids, labels = candidates["vec_id"].to_numpy(), candidates["label"].to_numpy()
            anchors = asking["anchor"].to_numpy()
            codes = asking["code"].to_numpy()
            for code in np.unique(codes).tolist():
                at = np.flatnonzero(codes == code)
                cluster = asking.take(pa.array(at))
                members = _matrix(cluster["q"].combine_chunks(), dim)
                windows = [
                    list(zip(a, b, strict=True))
                    for a, b in zip(cluster["low"].to_pylist(), cluster["high"].to_pylist(), strict=True)
                ]
                of = cluster["label"].to_numpy()
                masks = {label: labels == label for label in np.unique(of).tolist()}
                fits = (lambda i: masks[int(of[i])]) if same_label else (lambda i: ~masks[int(of[i])])
                found, _ = walk(x, ids, fits, members, cluster["vec_id"].to_numpy(), windows, keep)
                out += [(int(anchors[at[i]]), s, name, score) for i, s, name, score in found]
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ["anchor", "slot", "vec_id", "score"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    keys = ("block", "chunk")
    found = (
        right.groupBy("dim", "visit", *keys).cogroup(left.groupBy("dim", "code", *keys)).applyInArrow(meet, _FOUND)
    )
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


_OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: tuple[int, int] = (LEAST_PERCENT, MOST_PERCENT),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor its ``positives`` best rows of the same label, and for each of those its
    ``negatives`` best rows of other labels whose score is from the lower to the upper ``percent``
    of the positive's; ranks count from 1, ties go to the smaller identifier. A pair without such
    rows has no row here.

    Rows with a null identifier, label or vector, or null or non-finite components, take no part;
    zero vectors do, with scores of 0. Rows meet rows of their own dimension only. Repeated rows
    are rows of their own, but none is a partner of an anchor with its identifier; anchors that are
    equal in everything are one. No row, or no anchor, gives no row. Other columns play no part,
    whatever their names. A score beyond 63 bits fails the query.
    """
    spark = vectors.sparkSession
    good = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("int").alias("label"),
        F.col(vector_col).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    rows = good.select(
        "vec_id", "label", scaled(F.col("vector")).alias("q"), "is_anchor", F.size("vector").alias("dim")
    )
    books: dict = {}
    picked = rows.filter(F.size("q") > 0).orderBy(F.xxhash64("vec_id"), "vec_id", "q").limit(SAMPLE_ROWS)
    for r in picked.select("q").collect():
        books.setdefault(len(r["q"]), []).append(r["q"])
    codes = min(CODES, 1 + rows.count() // CODE_ROWS)
    books = {dim: codebook(np.array(own, np.int64), codes) for dim, own in books.items()}
    for dim in [r[0] for r in rows.select("dim").distinct().collect()]:
        books.setdefault(dim, np.zeros((1, dim)))

    placed = _placed(rows, books).withColumn("deal", F.monotonically_increasing_id())
    placed = written(placed, "placed")
    cones: dict[int, np.ndarray] = {dim: np.tile([-1.0, 0.0], (len(b), 1)) for dim, b in books.items()}
    widest = placed.groupBy("dim", "code").agg(F.max("norm").alias("norm"), F.max("angle").alias("angle"))
    for r in widest.collect():
        cones[r["dim"]][r["code"]] = r["norm"], r["angle"] + SLACK

    anchors = placed.filter("is_anchor").dropDuplicates(["vec_id", "label", "q"]).select(
        F.monotonically_increasing_id().alias("anchor"),
        *["vec_id", "label", "q", "dim", "code"],
        F.array(F.lit(-MOST)).alias("low"),
        F.array(F.lit(MOST)).alias("high"),
    )
    anchors = written(anchors, "anchors")

    # positives: first in the anchor's own code, then in the others that may still have better
    home = anchors.withColumn("visit", F.col("code"))
    near = written(_searched(placed, home, positives, True), "near")
    worst = near.groupBy("anchor").agg(
        F.when(F.count(F.lit(1)) == positives, F.min("score")).cast("double").alias("need")
    )
    asking = anchors.join(worst, "anchor", "left").withColumns(
        {"need": F.coalesce("need", F.lit(float("-inf"))), "skip_own": F.lit(True)}
    )
    far = _searched(placed, written(_visits(asking, books, cones), "visits"), positives, True)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    both = near.drop("rank").unionByName(far.drop("rank"))
    chosen = both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
    chosen = written(chosen.select("anchor", "rank", "vec_id", "score"), "positives")

    # negatives: one window of scores for each positive
    least, most = percent
    low = F.ceil(F.expr(f"cast({least} * cast(score as decimal(20,0)) as decimal(30,0)) / 100"))
    high = F.floor(F.expr(f"cast({most} * cast(score as decimal(20,0)) as decimal(30,0)) / 100"))
    # the window of a negative score is empty
    low = F.when(F.col("score") < 0, F.lit(MOST)).otherwise(low.cast("long"))
    windows = chosen.select(
        "anchor", F.struct("rank", low.alias("low"), high.cast("long").alias("high")).alias("w")
    ).groupBy("anchor").agg(F.array_sort(F.collect_list("w")).alias("w"))
    asking = anchors.drop("low", "high").join(windows, "anchor").select(
        "*",
        F.col("w.low").alias("low"),
        F.col("w.high").alias("high"),
        F.array_min("w.low").cast("double").alias("need"),
        F.lit(False).alias("skip_own"),
    )
    found = _searched(placed, written(_visits(asking, books, cones), "visits"), negatives, False)
    named = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    positive = chosen.select(
        "anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        found.join(positive, ["anchor", "slot"])
        .join(named, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
