"""Links between vectors of a label by the subspace pigeonhole principle.

Two unit vectors with cosine c lie at squared distance 2 - 2c. Cut into blocks
of dimensions, the block distances add up to that, so in at least one block two
linked vectors are no farther apart than the block's proportional share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulark.llm.components import components
from tabulark.llm.vectors import pair_cosines, usable
from tabulark.operators.joins import lookup, null_safe_join
from tabulark.session import pin

CHUNK = 2048
BLOCK = 8
STRIP = 512
#: Coordinates of a block that are range-joined before anything is multiplied, and ranges of each.
LEADING, RANGES = 3, 4
#: Above all rounding of the block distances in single precision.
ROUNDING = 1e-5


def rotation(width: int, seed: int = 5) -> np.ndarray:
    """A fixed rotation, which spreads the energy of any direction over all blocks."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))[0]


def near_ranges(p: np.ndarray, q: np.ndarray, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of p, rows of q) that together hold every pair within ``reach`` in the leading coordinates.

    The rows of ``p`` are cut into ranges of one coordinate after the other, and
    each range meets the rows of ``q`` that lie in it or within ``reach`` of it.
    """
    todo = [(np.arange(len(p)), np.arange(len(q)), 0)]
    while todo:
        x, y, d = todo.pop()
        if not len(x) or not len(y):
            continue
        if d == min(LEADING, p.shape[1]):
            yield x, y
            continue
        for own in np.array_split(x[np.argsort(p[x, d], kind="stable")], RANGES):
            if len(own):
                v = q[y, d]
                todo.append((own, y[(v >= p[own[0], d] - reach) & (v <= p[own[-1], d] + reach)], d + 1))


def candidates(x: np.ndarray, y: np.ndarray, budget: float, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs near in at least one block of the rotated unit vectors, a strip of ``x`` at a time.

    Each block is range-joined: only pairs whose leading coordinates lie within
    the root of the block's share are multiplied.
    """
    width = x.shape[1]
    turn = rotation(width)
    left, right = (x @ turn).astype(np.float32), (y @ turn).astype(np.float32)
    near = np.zeros((len(left), len(right)), bool)
    for d in range(0, width, block):
        p, q = left[:, d : d + block], right[:, d : d + block]
        share = np.float32(budget * p.shape[1] / width + ROUNDING)
        # |p - q|^2 <= share, written as p.q >= (|p|^2 + |q|^2 - share) / 2
        half_p, half_q = ((v * v).sum(axis=1) / 2 for v in (p, q))
        for i, j in near_ranges(p, q, float(np.sqrt(share)) + ROUNDING):
            near[np.ix_(i, j)] |= (p[i] @ q[j].T) - half_q[j][None, :] >= (half_p[i] - share / 2)[:, None]
    for s in range(0, len(left), STRIP):
        i, j = np.nonzero(near[s : s + STRIP])
        yield i + s, j


def settled(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the pairs (i, j) and the pairs (k, root[k]) known already.

    What is known goes on as links: a root that hooks onto two lower ones takes
    the smaller, and the link to the other is looked at again in the next round.
    """
    known = np.flatnonzero(root != np.arange(len(root)))
    i, j = np.concatenate([i, known]), np.concatenate([j, root[known]])
    while True:
        while (root[root] != root).any():
            root = root[root]
        low = np.minimum(root[i], root[j])
        if not ((root[i] != low) | (root[j] != low)).any():
            return root
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)


def tile_links(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Weighted link counts and one link to the tile's first relative, per linked vector."""
    width, single = int(rows["width"].iloc[0]), bool(rows["single"].iloc[0])
    raw = np.frombuffer(b"".join(rows["raw"]), np.float32 if single else np.float64).reshape(-1, width).astype(np.float64)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    unit = raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))
    part, node, weight = (rows[c].to_numpy() for c in ("part", "node", "m"))
    first = np.flatnonzero(part == int(rows["low"].iloc[0]))
    second = np.flatnonzero(part == int(rows["high"].iloc[0]))
    links, root = np.zeros(len(raw), np.int64), np.arange(len(raw))
    same = int(rows["low"].iloc[0]) == int(rows["high"].iloc[0])
    if not len(first) or not len(second):
        return pd.DataFrame({"node": node[:0], "links": links[:0], "near": node[:0]})
    for i, j in candidates(unit[first], unit[second], 2 - 2 * least):
        if same:
            i, j = i[i < j], j[i < j]
        i, j = first[i], second[j]
        linked = pair_cosines(raw, raw, i, j) >= least
        i, j = i[linked], j[linked]
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        root = settled(root, i, j)
    found = np.flatnonzero(links)
    return pd.DataFrame({"node": node[found], "links": links[found], "near": node[root[found]]})


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.93,
    chunk: int = CHUNK,
) -> DataFrame:
    """Per vector its key, ``n_links``, ``component_id`` and ``kept``.

    Vectors of one label are linked when their cosine is at least ``least``.
    Equal vectors of a label are folded into one with a weight. The label is cut
    into chunks of about ``chunk`` vectors, and every pair of chunks is one task
    group: inside, the rotated vectors are range-joined block by block under the
    proportional budget, only what lies in reach being multiplied, the union of candidates is verified exactly, and only a
    count and one link per vector leave it. A label with a third of all rows is
    so many more pairs of chunks, and no pair of vectors is ever shuffled.

    Defined cases: rows whose label is null, whose key is null, or whose vector
    is null, empty, zero or partly null or non-finite link with nothing and form
    their own component; vectors of unequal width are not compared; rows that
    repeat a key are vectors of their own;
    other columns are ignored.
    """
    schema = f"`{key}` long, label {vectors.schema[label].dataType.simpleString()}, raw binary, width int, single boolean, print string"

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "label", "raw", "width", "single", "print"]
        for batch in batches:
            cells: list[list] = [[None] * batch.num_rows for _ in range(4)]
            for i, v in usable(batch.column(2)):
                raw = v.tobytes()
                for column, x in zip(cells, (raw, len(v), v.dtype == np.float32, hashlib.sha256(raw).hexdigest())):
                    column[i] = x
            kinds = (pa.binary(), pa.int32(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(cells, kinds)]], names=names)

    rows = vectors.select(F.col(key).cast("long").alias(key), F.col(label).alias("label"), vector).mapInArrow(prepare, schema)
    able = rows.where(F.col("print").isNotNull() & F.col("label").isNotNull() & F.col(key).isNotNull())
    group = ["label", "width", "single"]
    # A node is a different vector of a label, whatever its keys; its number is fixed once it is written.
    folded = pin(
        able.groupBy(*group, "print")
        .agg(F.min(key).alias("rep"), F.count(F.lit(1)).alias("m"), F.first("raw").alias("raw"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    parts = folded.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("parts"))
    cut = folded.join(parts, group).withColumn("part", F.pmod(F.xxhash64("print"), F.col("parts")).cast("int"))
    tiles = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        *group, "node", "m", "raw", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    found = pin(
        tiles.groupBy(*group, "low", "high").applyInPandas(
            lambda p: tile_links(p, least), "node long, links long, near long"
        )
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("near").alias("b")))
    named = folded.select("label", "print", "node", "rep", "m").join(joined, "node", "left")
    smallest = named.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min("rep").alias("smallest"), F.count(F.lit(1)).alias("members")
    )
    per = (
        lookup(named, smallest, ["component"], "left", weight="members")
        .join(counts, "node", "left")
        .select("label", "print", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("smallest", "rep").alias("component_id"))
    )
    met = null_safe_join(rows.select(key, "label", "print"), per, ["label", "print"], "left")
    return met.select(
        key,
        F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col(key).isNotNull(), F.coalesce("component_id", key)).alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
