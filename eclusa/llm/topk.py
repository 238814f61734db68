"""Exact top-k search by inner product over vector-approximation files.

Vectors are integer vectors. Each component is cut into cells of equal width, the same
for all rows; the cells' numbers, a byte each, are a vector's approximation. They are written
to a file of their own, and only they meet the queries: the middles of the cells and half
their width bound a query's score with each vector from below and above. Vectors whose
upper bound is under the k-th largest lower bound, first of a block and then of all, are out.
Of the rest the exact vectors are read in the order of their upper bounds: the first ones, and
then only those whose bound reaches the k-th exact score of these. Scores are exact whole
numbers, whatever the components' size; one that has no room in a long is its greatest or
smallest value.

Equal vectors are searched as one: each distinct vector keeps its k + 1 smallest ids,
which is all that a list of k (without the query's own row) can show. A very common
vector is cut down so before and after the shuffle, never gathered.

Queries and approximations are packed into blocks of a fixed number of rows; each
block of queries meets each block of approximations once, in a task of its own. Only one block
of either side is in memory.

Vectors that are null or hold null or non-finite components take no part. Vectors of
different lengths never meet. Ties go to the smaller id; rows that repeat an id and
vector count as one. Fewer than k candidates give all of them; no queries, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eclusa.llm.frames import map_batches, on_workers, staged

# Cells of a component, and distinct vectors and queries in a block.
CELLS = 256
VECTOR_BLOCK = 16_384
QUERY_BLOCK = 4_096
# Queries whose bounds are worked out together.
STRIPE = 256


def integers(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, as double."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(embedding: Column) -> Column:
    """True for a vector without null and non-finite components."""
    bad = F.exists(
        embedding,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return F.coalesce(embedding.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.lit(False))


def _n_blocks(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


def _block(n: int, *key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``vector`` and ``ids``: each distinct vector with its k + 1 smallest ids."""
    ids = Window.partitionBy("vector").orderBy("vec_id")
    # Spark keeps k + 1 rows of a vector in each task before it shuffles.
    first = rows.distinct().withColumn("at", F.row_number().over(ids)).filter(F.col("at") <= k + 1)
    return first.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _approximated(vectors: DataFrame, low: int, width: int) -> DataFrame:
    """``v``, ``size`` and ``cells``, a byte for each component, of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lists = rows.column("vector")
            values = lists.flatten().to_numpy()
            # Differences of whole numbers that have no room in 64 signed bits have in unsigned ones.
            cells = (values.view(np.uint64) - np.uint64(low % 2**64)) // np.uint64(width)
            ends = np.concatenate([[0], np.cumsum(rows.column("size").to_numpy())])
            raw = cells.astype(np.uint8).tobytes()
            packed = [raw[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("v"), rows.column("size"), pa.array(packed, pa.binary())], names=["v", "size", "cells"]
            )

    rows = vectors.select("v", F.size("vector").alias("size"), "vector")
    return map_batches(rows, run, "v long, size int, cells binary")


def bounds(cells: np.ndarray, q: np.ndarray, low: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of each query's score with each approximated vector."""
    # The whole numbers of cell c are low + c * width and the width - 1 that follow.
    middle = cells.astype(np.float64) * width + (low + (width - 1) / 2)
    about = q @ middle.T
    most = max(abs(low), abs(low + CELLS * width))
    # Half a cell, and what rounding may have lost.
    slack = np.abs(q).sum(axis=1) * ((width - 1) / 2 + 8 * (q.shape[1] + 1) * 2.0**-52 * most)
    return about - slack[:, None], about + slack[:, None]


def _survivors(cells: DataFrame, asked: DataFrame, need: int, low: int, width: int) -> DataFrame:
    """``q``, ``v``, ``lower`` and ``upper`` of all pairs that a block's bounds can't rule out."""
    n, m = _n_blocks(cells, VECTOR_BLOCK), _n_blocks(asked, QUERY_BLOCK)
    # Every block of one side meets every block of the other: a stated query set, in blocks.
    left = cells.select("size", _block(n, "v").alias("block"), _every(m).alias("query_block"), "v", "cells")
    right = asked.select(
        F.size("vector").alias("size"), _every(n).alias("block"), _block(m, "q").alias("query_block"), "q", "vector"
    )
    keys = ["size", "block", "query_block"]

    def meet(v: pa.Table, q: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2]
        if v.num_rows and q.num_rows:
            n = v["size"][0].as_py()
            raw = b"".join(v["cells"].to_pylist())
            approx = np.frombuffer(raw, np.uint8).reshape(v.num_rows, n)
            whole = q["vector"].combine_chunks().flatten().to_numpy().reshape(q.num_rows, n).astype(np.float64)
            v_id, q_id = v["v"].to_numpy(), q["q"].to_numpy()
            least = min(need, len(v_id))
            for start in range(0, len(whole), STRIPE):
                lower, upper = bounds(approx, whole[start : start + STRIPE], low, width)
                certain = -np.partition(-lower, least - 1, axis=1)[:, least - 1]
                i, j = np.nonzero(upper >= certain[:, None])
                found.append((q_id[start + i], v_id[j], lower[i, j], upper[i, j]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table(dict(zip(("q", "v", "lower", "upper"), columns, strict=True)))

    return (
        on_workers(left)
        .groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(meet, "q long, v long, lower double, upper double")
    )


def products(a: list[np.ndarray], b: list[np.ndarray]) -> list[int]:
    """Exact inner products of whole vectors, cut to 64 bits."""
    out = []
    for x, y in zip(a, b, strict=True):
        if float(np.abs(x.astype(np.float64)) @ np.abs(y.astype(np.float64))) < 2.0**62:
            out.append(int(x @ y))
        else:
            whole = sum(int(i) * int(j) for i, j in zip(x, y, strict=True))
            out.append(max(min(whole, 2**63 - 1), -(2**63)))
    return out


def _scored(pairs: DataFrame, vectors: DataFrame, asked: DataFrame) -> DataFrame:
    """``q``, ``query_id``, ``ids`` and ``score`` of pairs of ``q`` and ``v``, by the exact vectors."""
    rows = pairs.join(vectors, "v").join(asked.withColumnRenamed("vector", "asked"), "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            one, other = (
                [x.values.to_numpy() for x in rows.column(c)] for c in ("vector", "asked")
            )
            scores = pa.array(products(one, other), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column("q"), rows.column("query_id"), rows.column("ids"), scores],
                names=["q", "query_id", "ids", "score"],
            )

    wanted = rows.select("q", F.col("vec_id").alias("query_id"), "ids", "vector", "asked")
    return map_batches(wanted, run, "q long, query_id long, ids array<long>, score long")


def _nth(rows: DataFrame, value: str, n: int, name: str) -> DataFrame:
    """``q`` and its n-th largest value, or its smallest if it has fewer."""
    order = Window.partitionBy("q").orderBy(F.desc(value))
    first = rows.select("q", value).withColumn("at", F.row_number().over(order)).filter(F.col("at") <= n)
    return first.groupBy("q").agg(F.min(value).alias(name))


def search(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's best k rows.

    Both frames have ``vec_id`` and ``vector`` (whole numbers). A query's own id is no
    candidate for it.
    """
    found = distinct_vectors(rows, k).withColumn("v", F.monotonically_increasing_id())
    vectors = staged(found, "topk-vectors")
    asked = staged(queries.distinct().withColumn("q", F.monotonically_increasing_id()), "topk-queries")
    span = vectors.select(F.array_min("vector").alias("x"), F.array_max("vector").alias("y"))
    low, high = span.agg(F.min("x"), F.max("y")).first()
    low, high = (0, 0) if low is None else (low, high)
    width = max(1, -(-(high - low + 1) // CELLS))
    cells = staged(_approximated(vectors, low, width), "topk-cells")
    # One vector more than k: the query's own row may be the only id of one of them.
    need = k + 1
    survivors = staged(_survivors(cells, asked, need, low, width), "topk-bounds")
    certain = _nth(survivors, "lower", need, "certain")
    left = survivors.join(certain, "q").filter("upper >= certain").select("q", "v", "upper")
    order = Window.partitionBy("q").orderBy(F.desc("upper"), "v")
    left = staged(left.withColumn("at", F.row_number().over(order)), "topk-left")
    # Read in the order of their bounds: the first ones, then those that can still be among the best.
    first = staged(_scored(left.filter(F.col("at") <= 2 * need).select("q", "v"), vectors, asked), "topk-first")
    reached = _nth(first, "score", need, "reached")
    # A bound is a number of 53 bits, and is above the score by more than the score's own rounding.
    rest = left.filter(F.col("at") > 2 * need).join(reached, "q").filter(F.col("upper") >= F.col("reached").cast("double"))
    exact = first.union(_scored(rest.select("q", "v"), vectors, asked))
    each = exact.select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
