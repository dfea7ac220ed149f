"""Nearest neighbours by cosine: a block matrix join of int8 tiles with error bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulark.llm.common import written
from tabulark.llm.vectors import pair_cosines, usable

QUERY_BLOCK = 1024
ROW_BLOCK = 4096
LEVELS = 127
#: Products of up to so many int8 pairs are exact in single precision.
EXACT_SINGLE = (1 << 24) // (LEVELS * LEVELS)
#: Above all rounding of the tile arithmetic.
ROUNDING = 1e-5

BLOCK_SCHEMA = "ids binary, width int, single boolean, raw binary, codes binary, steps binary, errors binary"


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, step per vector, and the length of what the codes leave out."""
    steps = np.abs(units).max(axis=1) / LEVELS
    codes = np.rint(units / steps[:, None]).astype(np.int8)
    errors = np.sqrt(((units - codes * steps[:, None]) ** 2).sum(axis=1))
    return codes, steps, errors


def blocks_of(rows: int):
    """Task function: (id, vector) rows to blocks of at most ``rows`` equally wide vectors."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple, tuple[list, list]] = {}

        def block(width: int, kind: str, ids: list, vectors: list) -> pa.RecordBatch:
            raw = np.stack(vectors)
            # Scaled first, so that squares of very large or small values stay finite.
            exact = raw.astype(np.float64)
            exact /= np.abs(exact).max(axis=1, keepdims=True)
            units = exact / np.sqrt((exact * exact).sum(axis=1, keepdims=True))
            codes, steps, errors = quantised(units)
            cells = [np.array(ids, np.int64).tobytes(), width, kind == "f4", raw.tobytes(), codes.tobytes(), steps.tobytes(), errors.tobytes()]
            kinds = [pa.binary(), pa.int32(), pa.bool_(), *[pa.binary()] * 4]
            names = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=names)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, vector in usable(batch.column(1)):
                key = (len(vector), vector.dtype.str[1:])
                held = waiting.setdefault(key, ([], []))
                held[0].append(ids[i])
                held[1].append(vector)
                if len(held[0]) >= rows:
                    yield block(*key, *waiting.pop(key))
        for key, held in waiting.items():
            yield block(*key, *held)

    return make


class Side:
    """One block of a tile, unpacked."""

    def __init__(self, ids: bytes, width: int, single: bool, raw: bytes, codes: bytes, steps: bytes, errors: bytes) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.raw = np.frombuffer(raw, np.float32 if single else np.float64).reshape(-1, width).astype(np.float64)
        self.raw /= np.abs(self.raw).max(axis=1, keepdims=True) if not single else 1.0
        kind = np.float32 if width <= EXACT_SINGLE else np.float64
        self.codes = np.frombuffer(codes, np.int8).reshape(-1, width).astype(kind)
        self.steps, self.errors = np.frombuffer(steps), np.frombuffer(errors)
        self.width = width


def tile(queries: Side, rows: Side, best: list[list[tuple]], k: int) -> None:
    """Merge the nearest rows of one tile into the heaps of the queries.

    With u = codes + rest, |u.v - codes.codes| <= |rest of u| + (1 + |rest of u|) |rest of v|.
    A pair survives if its upper bound reaches the k-th best lower bound or the
    k-th exact score known so far; survivors are computed in double precision.
    """
    near = (queries.codes @ rows.codes.T).astype(np.float64)
    near *= queries.steps[:, None] * rows.steps[None, :]
    slack = queries.errors[:, None] + (1 + queries.errors[:, None]) * rows.errors[None, :] + ROUNDING
    own = queries.ids[:, None] == rows.ids[None, :]
    near[own] = -np.inf
    floor = np.array([heap[-1][0] * -1 if len(heap) == k else -np.inf for heap in best])
    if near.shape[1] > k:
        floor = np.maximum(floor, np.partition(near - slack, -k, axis=1)[:, -k])
    i, j = np.nonzero((near + slack >= floor[:, None]) & ~own)
    if not len(i):
        return
    score = pair_cosines(queries.raw, rows.raw, i, j)
    order = np.lexsort((rows.ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    for s, e in zip(starts, np.r_[starts[1:], len(i)]):
        e = min(e, s + k)
        found = zip((-score[s:e]).tolist(), rows.ids[j[s:e]].tolist())
        best[i[s]] = [x for x, _ in zip(heapq.merge(best[i[s]], found), range(k))]


def nearest(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5
) -> DataFrame:
    """The ``k`` rows nearest by cosine to each query: ``query_id``, ``rank``, the key, ``score``.

    Rows become blocks of 4096 vectors, queries blocks of 1024; each pair of
    blocks is one tile, multiplied in int8 with bounds of the quantisation
    error. Nothing is approximate: a pair is left out only if its bound proves
    that k others are nearer. A task keeps one heap of k per query of its tile,
    and the tasks' heaps are merged at the end.

    Defined cases: vectors that are null, empty, zero or hold null or non-finite
    components take no part, neither do rows without a key; vectors of unequal
    width are never compared; a repeated key asks once, and rows with the
    query's own key are no candidates; ties go to the smaller key; with fewer
    than k candidates all are returned; other columns are ignored.
    """
    rows = vectors.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_id"), F.col(vector).alias("_v"), is_query.alias("_ask"))
    asked = rows.where(F.col("_ask")).select("_id", "_v").dropDuplicates(["_id"])
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    queries = asked.repartition(parts, "_id").mapInArrow(blocks_of(QUERY_BLOCK), BLOCK_SCHEMA)
    others = rows.select("_id", "_v").mapInArrow(blocks_of(ROW_BLOCK), BLOCK_SCHEMA)
    right = written(queries, "queries").select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    tiles = written(others, "rows").crossJoin(right).where((F.col("width") == F.col("q_width")) & (F.col("single") == F.col("q_single")))
    names = queries.columns

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[bytes, list[list[tuple]]] = {}
        sides: dict[bytes, Side] = {}
        for batch in batches:
            for row in batch.to_pylist():
                mark = row["q_ids"]
                if mark not in sides:
                    sides[mark] = Side(*[row[f"q_{c}"] for c in names])
                    heaps[mark] = [[] for _ in sides[mark].ids]
                tile(sides[mark], Side(*[row[c] for c in names]), heaps[mark], k)
        for mark, best in heaps.items():
            found = [(int(q), i, -s) for q, heap in zip(sides[mark].ids, best) for s, i in heap]
            if found:
                q, i, s = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=["query_id", key, "score"])

    found = tiles.mapInArrow(solve, f"query_id long, `{key}` long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", key, "score")
    )
