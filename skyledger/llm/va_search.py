"""Exact top-k inner products by vector-approximation files.

Components become whole numbers. A vector's approximation is one byte for each: the number of its cell, ``CELL`` whole numbers wide, or as much wider
as the vector's largest component asks for. The search has three steps, and only the last reads exact vectors:

1. One scan of the approximations bounds every inner product from both sides; the k-th largest lower bound of each query, over all vectors, dismisses
   all vectors whose upper bound is below it.
2. A second scan names the vectors that are left.
3. Their exact vectors are read in the order of the upper bounds, in two waves: the k first of each query give its k-th result so far, and of the rest only
   those are read whose upper bound reaches that. So the k-th result is certain.

Approximations and queries are dealt into blocks by hash, and every query block meets every block of approximations (the stated query set
against all rows). A meeting yields k bounds a query, or the vectors left.

Vectors that are null, empty or hold null or non-finite components, or have no id, take no part, nor do those of another length than the query's.
A query's own id is not its result; other rows that repeat an id are, and of query rows with one id the first is asked. Ties go to the smaller id.
Products are exact up to 2**53. An empty table gives no rows. Other columns are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

CELL = 2
VECTORS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024
ROUNDING = 1e-12  # of the largest product possible, beyond 2**53


def cells_of(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Cell numbers of whole numbers as bytes, and the cells' width, a power of two."""
    width = float(CELL)
    while np.abs(x).max(initial=0) + 1 > 127 * width:
        width *= 2
    return np.floor(x / width).astype(np.int8), width


def bounds(queries: np.ndarray, cells: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products (query x vector) of whole numbers in these cells."""
    small = np.abs(queries).max(initial=0) * 128 * queries.shape[1] < 1 << 24  # then 32 bits are exact
    kind = np.float32 if small else np.float64
    least = (queries.astype(kind) @ cells.astype(kind).T).astype(np.float64) * widths
    spread = np.abs(queries).sum(axis=1)[:, None]
    slack = ROUNDING * 128 * widths * spread
    up, down = np.maximum(queries, 0).sum(axis=1)[:, None], np.minimum(queries, 0).sum(axis=1)[:, None]
    return least + (widths - 1) * down - slack, least + (widths - 1) * up + slack


def _whole(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, cells, widths = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = None if not v.is_valid or v.values.null_count else np.asarray(v.values, np.float64)
                if i is not None and x is not None and len(x) and np.isfinite(x := np.floor(scale * x)).all():
                    cell, width = cells_of(x)
                    ids.append(i)
                    rows.append(x)
                    cells.append(cell.tobytes())
                    widths.append(width)
            cut = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            exact = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(rows) if rows else np.zeros(0)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.diff(cut), pa.int32()), exact, pa.array(cells, pa.binary()), pa.array(widths, pa.float64())], names=["id", "dim", "exact", "cells", "width"])

    return run


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _meeting(v: pa.Table, q: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(place of the query, lower bounds, upper bounds, own id) of each query of a block; the query's own id has bounds of minus infinity."""
    dim = q["dim"][0].as_py()
    cells = np.frombuffer(b"".join(v["cells"].to_pylist()), np.int8).reshape(-1, dim)
    ids, own, widths = np.asarray(v["id"]), np.asarray(q["id"]), np.asarray(v["width"])
    queries = _matrix(q["exact"], dim)
    for low in range(0, len(own), 128):
        lower, upper = bounds(queries[low : low + 128], cells, widths)
        for i in range(len(lower)):
            out = ids == own[low + i]
            lower[i, out] = upper[i, out] = -np.inf
            yield low + i, lower[i], upper[i], int(own[low + i])


def _table(parts: list[list[np.ndarray]], names: list[str], kinds: list[type]) -> pa.Table:
    return pa.table([pa.array(np.concatenate([np.zeros(0, kind), *part])) for part, kind in zip(parts, kinds, strict=True)], names=names)


def _product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.zeros(batch.num_rows, np.int64)
        sizes = np.diff(np.asarray(batch.column(3).offsets)) if batch.num_rows else np.zeros(0, np.int64)
        for dim in np.unique(sizes):
            own = np.flatnonzero(sizes == dim)
            x, y = (_matrix(batch.column(j).take(pa.array(own)), int(dim)) for j in (2, 3))
            scores[own] = np.einsum("ij,ij->i", x, y).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(scores)], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (vec_id, embedding) that ``is_query`` (a column of vec_id) picks."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_whole(scale), "id long, dim int, exact array<double>, cells binary, width double")
    rows = scratch.save(rows.withColumn("s", F.monotonically_increasing_id()))
    queries = scratch.save(rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min_by(F.struct("dim", "exact"), "s").alias("x")).select("id", "x.dim", "x.exact"))
    v_blocks, q_blocks = -(-rows.count() // VECTORS_PER_BLOCK) or 1, -(-queries.count() // QUERIES_PER_BLOCK) or 1
    part = lambda c, blocks: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.select(part("s", v_blocks).alias("v"), each(q_blocks).alias("q"), "dim", "s", "id", "width", "cells").groupBy("v", "q", "dim")
    right = lambda asked: asked.select(each(v_blocks).alias("v"), part("id", q_blocks).alias("q"), "dim", "id", "exact", *(["least"] if "least" in asked.columns else [])).groupBy("v", "q", "dim")

    def lower_bounds(v: pa.Table, q: pa.Table) -> pa.Table:
        ids, found = [], []
        for _, lower, _, own in _meeting(v, q) if len(v) and len(q) else ():
            best = lower if len(lower) <= k else np.partition(lower, -k)[-k:]
            best = best[np.isfinite(best)]
            ids.append(np.full(len(best), own))
            found.append(best)
        return _table([ids, found], ["id", "lower"], [np.int64, np.float64])

    def survivors(v: pa.Table, q: pa.Table) -> pa.Table:
        ids, places, found = [], [], []
        if len(v) and len(q):
            s, least = np.asarray(v["s"]), np.asarray(q["least"])
            for i, _, upper, own in _meeting(v, q):
                at = np.flatnonzero((upper >= least[i]) & np.isfinite(upper))
                ids.append(np.full(len(at), own))
                places.append(s[at])
                found.append(upper[at])
        return _table([ids, places, found], ["query_id", "s", "upper"], [np.int64, np.int64, np.float64])

    best = left.cogroup(right(queries)).applyInArrow(lower_bounds, "id long, lower double")
    order = Window.partitionBy("id").orderBy(F.desc("lower"))
    kth = best.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select(F.col("id").alias("own"), F.col("lower").alias("least"))
    asked = scratch.save(queries.join(kth, F.col("id") == F.col("own"), "left").select("id", "dim", "exact", F.coalesce("least", F.lit(float("-inf"))).alias("least")))
    left_over = scratch.save(left.cogroup(right(asked)).applyInArrow(survivors, "query_id long, s long, upper double"))

    exact = rows.select("s", F.col("id").alias("vec_id"), F.col("exact").alias("x"))
    own = queries.select(F.col("id").alias("query_id"), F.col("exact").alias("y"))

    def read(wave: DataFrame) -> DataFrame:
        both = wave.select("query_id", "s").join(exact, "s").join(own, "query_id").select("query_id", "vec_id", "x", "y")
        return scratch.save(both.mapInArrow(_product, "query_id long, vec_id long, score long"))

    turn = left_over.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("upper"), "s")))
    first = scratch.save(turn.where(F.col("r") <= k).select("query_id", "s"))
    found = read(first)
    so_far = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select("query_id", "least")
    rest = left_over.join(so_far, "query_id").where("upper >= least").join(first, ["query_id", "s"], "left_anti")
    ranked = found.unionByName(read(rest)).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    result = scratch.save(ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
    scratch.keep(result)
    return result
