"""Nearest neighbours by a block matrix join.

Vectors are packed into blocks; a query block meets every candidate block of its
length, one tile at a time. A tile first multiplies int8 codes. Rounding errors of
the codes give each product a bound, so only pairs whose upper bound reaches the
k-th best lower bound (or the k-th score already held) are computed again from the
original vectors in double precision, summed in component order. The k best of a
query's tiles are merged by heaps inside a task, and the tasks' lists by rank.

Vectors that are null, empty, zero or hold null or non-finite components take no
part, neither do null ids. Rows that repeat an id are vectors of their own: each is a
query, and a candidate for all but itself; they are numbered in a written copy, so that
a lost task finds the same numbers. Only vectors of equal length are compared. Ties go
to the smaller id. An empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import durable

#: Blocks of results that a task holds at once; beyond, they are handed on and merged later.
HELD = 64


def usable(vectors: DataFrame) -> DataFrame:
    """id and v (double array) of the vectors that take part, and row, a number of their own."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(fine)
    return durable(rows.withColumn("row", F.monotonically_increasing_id()))


def quantised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale per row, and half the sum of absolute codes per row (for the error bound)."""
    scale = np.abs(matrix).max(1) / 127
    with np.errstate(over="ignore", invalid="ignore"):
        codes = np.clip(np.rint(matrix / np.where(scale > 0, scale, 1)[:, None]), -127, 127).astype(np.int8)
    return codes, scale, np.abs(codes.astype(np.int32)).sum(1) / 2


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: up to 1,024 components stay below 2**24 in single precision."""
    total = np.zeros((len(left), len(right)))
    for d in range(0, left.shape[1], 1024):
        total += left[:, d:d + 1024].astype(np.float32) @ right[:, d:d + 1024].astype(np.float32).T
    return total


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, components added in order."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += left[:, d] * right[:, d]
    return total


def tile_best(queries: tuple, candidates: tuple, k: int, floor: np.ndarray) -> list[list[tuple[float, int]]]:
    """Per query the k best (-score, id) of a tile. floor: scores below it can't count any more."""
    q_own, _, q_rows, q_codes, q_scale, q_half = queries
    c_own, c_ids, c_rows, c_codes, c_scale, c_half = candidates
    best: list[list[tuple[float, int]]] = []
    for start in range(0, len(q_own), 256):
        part = slice(start, start + 256)
        scale = q_scale[part, None] * c_scale[None, :]
        near = products(q_codes[part], c_codes) * scale
        slack = scale * (q_half[part, None] + c_half[None, :] + 0.25 * q_rows.shape[1]) * (1 + 1e-9) + 1e-12 * np.abs(near)
        own = q_own[part, None] == c_own[None, :]
        low = np.where(own, -np.inf, near - slack)
        reach = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(low), -np.inf)
        who, what = np.nonzero((near + slack >= np.maximum(reach, floor[part])[:, None]) & ~own)
        score = np.concatenate([np.zeros(0), *(exact(q_rows[part][who[i:i + 65536]], c_rows[what[i:i + 65536]]) for i in range(0, len(who), 65536))])
        order = np.lexsort((c_ids[what], -score, who))
        who, what, score = who[order], what[order], score[order]
        ends = np.searchsorted(who, np.arange(len(low) + 1))
        best += [list(zip((-score[a:min(a + k, b)]).tolist(), c_ids[what[a:min(a + k, b)]].tolist())) for a, b in zip(ends, ends[1:])]
    return best


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    """One row (dim, block, own, ids, rows) per block of about equally many vectors, as bytes of longs (row numbers, ids) and doubles."""
    def pack(group: pa.Table) -> pa.Table:
        order = np.lexsort((group["row"].to_numpy(), group["id"].to_numpy()))
        matrix = np.asarray(group["v"].combine_chunks().flatten(), np.float64).reshape(group.num_rows, -1)[order]
        return pa.table({"dim": group["dim"][:1], "block": group["block"][:1],
                         "own": [group["row"].to_numpy()[order].astype(np.int64).tobytes()], "ids": [group["id"].to_numpy()[order].astype(np.int64).tobytes()], "rows": [matrix.tobytes()]})

    placed = rows.select("row", "id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
    return placed.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, own binary, ids binary, rows binary")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, candidate_block: int = 4096, query_block: int = 1024) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the k largest inner products of every query; ``is_query`` is a condition on ``id``."""
    rows = usable(vectors)
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks = max(1, -(-n // candidate_block))
    candidates = _packed(rows, blocks)
    queries = _packed(rows.where(is_query), max(1, -(-asked // query_block))).select(
        "dim", F.col("own").alias("q_own"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("block").alias("q_block"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[np.ndarray, list]] = {}

        def handed(keys: list) -> Iterator[pa.RecordBatch]:
            for key in keys:
                own, ids, lists = held.pop(key)
                flat = [(int(r), int(q), i, -s) for r, q, found in zip(own, ids, lists) for s, i in found]
                if flat:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                                                     ["query_row", "query_id", "vec_id", "score"])

        for batch in batches:
            for row in range(batch.num_rows):
                dim, q_block, *packed = (batch.column(c)[row].as_py() for c in ("dim", "q_block", "q_own", "q_ids", "own", "ids", "q_rows", "rows"))
                q_own, q_ids, c_own, c_ids = (np.frombuffer(x, np.int64) for x in packed[:4])
                q_rows, c_rows = (np.frombuffer(x, np.float64).reshape(-1, dim) for x in packed[4:])
                key = (dim, q_block)
                if key not in held and len(held) >= HELD:
                    yield from handed([next(iter(held))])
                *_, lists = held.get(key) or (q_own, q_ids, [[] for _ in q_ids])
                floor = np.array([-x[k - 1][0] if len(x) == k else -np.inf for x in lists])
                new = tile_best((q_own, q_ids, q_rows, *quantised(q_rows)), (c_own, c_ids, c_rows, *quantised(c_rows)), k, floor)
                held[key] = (q_own, q_ids, [list(itertools.islice(heapq.merge(a, b), k)) for a, b in zip(lists, new)])
        yield from handed(list(held))

    tiles = queries.join(candidates, ["dim", "block"]).select("dim", "q_block", "q_own", "q_ids", "q_rows", "own", "ids", "rows")
    found = tiles.mapInArrow(run, "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
