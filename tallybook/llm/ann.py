"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Vectors are scaled to length one, where the nearest by cosine are the nearest by distance. Each of
``TABLES`` tables hashes a vector by ``FUNCTIONS`` random projections, cut into cells of width
``WIDTH``. A query visits its own bucket of every table and ``PROBES`` perturbed ones, in the
order of their estimated success: that of the squared distances from the query's projections to
the cell borders that the perturbation crosses. What the buckets hold is ranked by the cosine of
the original vectors, and the tables' best are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import written

TABLES = 5
FUNCTIONS = 5
WIDTH = 1.6
PROBES = 60
SEED = 7
NEIGHBOURS = 5
# Vectors of a bucket that one task compares with the bucket's queries.
BUCKET_ROWS = 512


def usable(vector: Column) -> Column:
    """Neither null, nor zero, nor with null or non-finite components."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def perturbations(below: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` best sets of steps to neighbouring cells, one row of -1, 0 and 1 for each.

    ``below`` has the distance to the lower border of each function's cell, as a share of its
    width. Sets are made in rising order of cost, each from one of less cost.
    """
    k = len(below)
    cost = np.concatenate([below, 1 - below]) ** 2
    order = np.argsort(cost, kind="stable")
    cost = cost[order]
    out: list[np.ndarray] = []
    heap: list[tuple[float, tuple[int, ...]]] = [(float(cost[0]), (0,))]
    while heap and len(out) < n:
        total, places = heapq.heappop(heap)
        functions = [int(order[i]) % k for i in places]
        if len(set(functions)) == len(functions):
            step = np.zeros(k, np.int64)
            step[functions] = [-1 if order[i] < k else 1 for i in places]
            out.append(step)
        last = places[-1]
        if last + 1 < 2 * k:
            longer = total + float(cost[last + 1])
            heapq.heappush(heap, (longer - float(cost[last]), (*places[:-1], last + 1)))
            heapq.heappush(heap, (longer, (*places, last + 1)))
    return np.array(out, np.int64).reshape(-1, k)


def _hashes(dim: int, tables: int, functions: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([SEED, dim])
    return draw.normal(size=(dim, tables * functions)), draw.random(tables * functions) * width


def _codes(cells: np.ndarray) -> np.ndarray:
    """One 64-bit number for each row of cells."""
    code = np.zeros(cells.shape[:-1], np.uint64)
    for j in range(cells.shape[-1]):
        code = (code ^ cells[..., j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code.view(np.int64)


_ROWS = "table int, bucket long, id long, vector binary"


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _bucketed(rows: DataFrame, dim: int, tables: int, functions: int, width: float, probes: int) -> DataFrame:
    """(table, bucket, id, vector): one row for each table, or table and probe."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, shifts = _hashes(dim, tables, functions, width)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                x = _matrix(batch.column(1), dim)
                unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
                where = ((unit @ lines + shifts) / width).reshape(len(x), tables, functions)
                cells = np.floor(where).astype(np.int64)
                raw = [v.tobytes() for v in x]
                ids = batch.column(0).to_pylist()
                out: list[tuple] = []
                for t in range(tables):
                    if not probes:
                        codes = _codes(cells[:, t])
                        out += zip([t] * len(x), codes.tolist(), ids, raw, strict=True)
                        continue
                    for i in range(len(x)):
                        steps = perturbations(where[i, t] - cells[i, t], probes)
                        visited = np.vstack([cells[i, t][None], cells[i, t] + steps])
                        out += [(t, c, ids[i], raw[i]) for c in _codes(visited).tolist()]
                t, b, i, v = zip(*out, strict=True)
                yield pa.record_batch(
                    [pa.array(t, pa.int32()), pa.array(b, pa.int64()), pa.array(i, pa.int64()), pa.array(v, pa.binary())],
                    ["table", "bucket", "id", "vector"],
                )

    return rows.mapInArrow(place, _ROWS)


def _ranked(queries: DataFrame, held: DataFrame, keys: list[str], dim: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query within each group of the keys."""

    def rank(query: pa.Table, member: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if len(query) and len(member):
            ids = member["id"].to_numpy()
            x = np.frombuffer(b"".join(member["vector"].to_pylist()), np.float64).reshape(-1, dim)
            norms = np.sqrt((x * x).sum(axis=1))
            for q, raw in zip(query["query_id"].to_pylist(), query["query"].to_pylist(), strict=True):
                y = np.frombuffer(raw, np.float64)
                # row sums, not a matrix product: equal vectors get equal scores wherever they lie
                score = (x * y).sum(axis=1) / (norms * np.sqrt((y * y).sum()))
                best = np.lexsort((ids, -score))
                best = best[ids[best] != q][:k]
                out.append((np.full(len(best), q), ids[best], score[best]))
        q, v, s = (np.concatenate(c) for c in zip(*out, strict=True)) if out else ((), (), ())
        return pa.table(
            [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
            names=["query_id", "vec_id", "score"],
        )

    named = queries.select(
        *[F.col(c).alias(f"q_{c}") for c in keys], F.col("id").alias("query_id"), F.col("vector").alias("query")
    )
    return (
        named.groupBy(*[f"q_{c}" for c in keys])
        .cogroup(held.groupBy(*keys))
        .applyInArrow(rank, "query_id long, vec_id long, score double")
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    tables: int = TABLES,
    functions: int = FUNCTIONS,
    width: float = WIDTH,
    probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, ties to the smaller id.

    Queries are the rows that ``is_query`` holds for; every row but those with the query's own
    identifier is a candidate. Vectors that are null, zero or hold null or non-finite components
    take no part, nor do those with a null identifier or of another dimension than most. Every
    other vector is indexed. The score is the cosine in double precision. A query whose buckets
    hold fewer than k others is compared with all vectors, in blocks; if there are fewer than k
    in all, it gets them all. Of rows with the same identifier the best scored counts.

    A bucket with many vectors is dealt out in parts of some ``BUCKET_ROWS``, and its queries
    visit each part.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("is_query")
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim"))
    first = sizes.first()
    if first is None:
        empty = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], empty)
    dim = first["dim"]
    rows = rows.filter(F.size("vector") == dim)
    asked = rows.filter("is_query").select("id", "vector")

    index = _bucketed(rows.select("id", "vector"), dim, tables, functions, width, 0)
    index = written(index, "buckets")
    visits = _bucketed(asked, dim, tables, functions, width, probes)
    parts = index.groupBy(F.col("table").alias("t"), F.col("bucket").alias("b")).agg(
        F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).alias("parts")
    )
    parts = written(parts, "parts")
    on = (F.col("table") == F.col("t")) & (F.col("bucket") == F.col("b"))
    held = index.join(parts, on).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    visits = visits.join(parts, on).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    )
    found = _ranked(visits, held, ["table", "bucket", "part"], dim, k)
    best = written(_best(found, k), "found")

    # the exact way for queries whose buckets held too few
    enough = best.groupBy("query_id").count().filter(F.col("count") >= k)
    few = asked.join(enough, F.col("id") == F.col("query_id"), "left_anti")
    packed = "transform(vector, x -> cast(x as double))"
    blocks = max(1, -(-rows.count() // BUCKET_ROWS))
    all_rows = rows.select("id", F.expr(packed).alias("vector")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.lit(blocks))
    )
    few = few.select("id", F.expr(packed).alias("vector")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )
    rest = _best(_ranked(_raw(few, dim), _raw(all_rows, dim), ["block"], dim, k), k)
    kept = best.join(enough.select("query_id"), "query_id", "left_semi")
    return kept.unionByName(rest).select("query_id", "rank", "vec_id", "score")


def _raw(rows: DataFrame, dim: int) -> DataFrame:
    """Vectors as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [v.tobytes() for v in _matrix(batch.column(1), dim)]
            columns = [batch.column(0), pa.array(raw, pa.binary()), batch.column(2)]
            yield pa.record_batch(columns, ["id", "vector", "block"])

    return rows.mapInArrow(pack, "id long, vector binary, block long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of what the buckets found, each vector once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
