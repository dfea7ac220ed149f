"""Exact duplicates by recipes: texts as ordered lists of verified content-defined chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulark.llm.common import BLANKS, text_of, written
from tabulark.llm.middle import slices
from tabulark.operators.joins import lookup
from tabulark.session import pin

#: Chunk sizes in bytes: least, most, and the leading hash bits that must be zero at a cut (2 KB on average).
LEAST, MOST, CUT_BITS = 256, 1 << 14, 11
#: Bytes around which a cut is decided.
AROUND = 8
#: Bytes of text that are normalised and hashed at once, and of chunks in a row of the store.
SLICE, ROW = 1 << 22, 1 << 22

U = np.uint64
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[ord(c) for c in BLANKS]] = True


def one_blank(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of white space as one space; ``starts`` are the places where texts begin, moved likewise."""
    blank = IS_BLANK[data]
    again = np.zeros(len(data), bool)
    again[1:] = blank[1:] & blank[:-1]
    again[starts[starts < len(data)]] = False
    kept = np.where(blank, np.uint8(32), data)[~again]
    before = np.concatenate([[0], np.cumsum(again)])
    return kept, starts - before[starts]


def cuts(data: np.ndarray, bits: int) -> np.ndarray:
    """Places behind ``AROUND`` bytes whose hash starts with ``bits`` zeros."""
    out = []
    for base in range(0, max(len(data) - AROUND + 1, 0), 1 << 20):
        piece = np.ascontiguousarray(data[base : base + (1 << 20) + AROUND - 1])
        words = np.lib.stride_tricks.as_strided(piece, (len(piece) - AROUND + 1, AROUND), (1, 1))
        value = np.ascontiguousarray(words).view("<u8").ravel() * U(0x9E3779B97F4A7C15)
        value ^= value >> U(32)
        value *= U(0xD6E8FEB86659FD93)
        out.append(np.flatnonzero(value >> U(64 - bits) == 0) + base + AROUND)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def chunk_ends(places: np.ndarray, start: int, end: int, least: int, most: int) -> list[int]:
    """Ends of the chunks of the text in [start, end), which depend on its own bytes only."""
    out: list[int] = []
    at = start
    near = int(np.searchsorted(places, start + AROUND))
    while at < end:
        near += int(np.searchsorted(places[near:], at + least))
        cut = int(places[near]) if near < len(places) else end
        at = min(cut, at + most, end)
        out.append(at)
    return out


def recipe_rows(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(key, at, text) to (key, at, sha, mark, recipe, part, own, chunks).

    The first row of a text carries its whole recipe; the chunks of a long text
    go on in further rows without one.
    """
    import xxhash

    keep = U((1 << bits) - 1)

    def normalised(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if pa.types.is_large_string(text.type):
            text = text.cast(pa.string())
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        data = text.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        return one_blank(raw, offsets - offsets[0])

    for batch in batches:
        sizes = pc.binary_length(batch.column(2)).to_numpy().astype(np.int64)
        for first, count in slices(sizes, SLICE):
            part = batch.slice(first, count)
            data, edges = normalised(part.column(2))
            places, view = cuts(data, CUT_BITS), memoryview(data)
            owner, rest = [], {n: [] for n in ("sha", "mark", "recipe", "part", "own", "chunks")}
            for i in range(count):
                start, end = int(edges[i]), int(edges[i + 1])
                ends = chunk_ends(places, start, end, LEAST, MOST)
                chunks = [bytes(view[a:b]) for a, b in zip([start, *ends], ends)]
                prints = np.fromiter((xxhash.xxh3_64_intdigest(c) for c in chunks), np.uint64, len(chunks)) & keep
                mark = np.uint64(xxhash.xxh3_64_intdigest(prints.tobytes(), end - start)).view(np.int64)
                prints = prints.view(np.int64)
                sha = hashlib.sha256(view[start:end]).hexdigest()
                step = ROW // MOST
                for seq, k in enumerate(range(0, max(len(chunks), 1), step)):
                    owner.append(i)
                    rest["sha"].append(sha)
                    rest["mark"].append(mark)
                    rest["recipe"].append(None if seq else prints)
                    rest["part"].append(seq)
                    rest["own"].append(prints[k : k + step])
                    rest["chunks"].append(chunks[k : k + step])
            longs = pa.list_(pa.int64())
            kinds = [pa.string(), pa.int64(), longs, pa.int32(), longs, pa.list_(pa.binary())]
            taken = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(taken), part.column(1).take(taken)]
                + [pa.array(v, k) for v, k in zip(rest.values(), kinds)],
                names=["key", "at", *rest],
            )


STORE = [
    T.StructField("at", T.LongType()),
    T.StructField("sha", T.StringType()),
    T.StructField("mark", T.LongType()),
    T.StructField("recipe", T.ArrayType(T.LongType())),
    T.StructField("part", T.IntegerType()),
    T.StructField("own", T.ArrayType(T.LongType())),
    T.StructField("chunks", T.ArrayType(T.BinaryType())),
]


def recipe_store(docs: DataFrame, key: str, text: str, bits: int) -> DataFrame:
    """The written chunks and recipes; ``at`` numbers the rows once and for all."""
    rows = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("at"), text_of(text).alias("text"))
    made = rows.mapInArrow(
        lambda batches: recipe_rows(batches, bits), T.StructType([T.StructField("key", docs.schema[key].dataType), *STORE])
    )
    return written(made, "recipes")


def exploded(store: DataFrame, *columns: str) -> DataFrame:
    each = F.posexplode(F.arrays_zip(F.col("own").alias("print"), F.col("chunks").alias("chunk"))).alias("pos", "_c")
    return store.select(*columns, each).select(*columns, "pos", "_c.print", "_c.chunk")


def shared_prints(suspects: DataFrame) -> DataFrame:
    """Prints that different chunks share, after equal chunks have been folded byte by byte."""
    different = exploded(suspects).select("print", "chunk").distinct()
    return pin(different.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("print"))


def ordinals(suspects: DataFrame, shared: DataFrame) -> DataFrame:
    """(at, mark, second): per text the number of each chunk among the chunks of its print."""
    placed = exploded(suspects, "at", "mark", "part")
    number = F.row_number().over(Window.partitionBy("print").orderBy("chunk"))
    named = lookup(placed.select("print", "chunk"), shared, ["print"], pinned=True).distinct().withColumn("number", number)
    met = lookup(placed, named, ["print", "chunk"], "left")
    order = F.array_sort(F.collect_list(F.struct("part", "pos", F.coalesce("number", F.lit(0)).cast("long").alias("number"))))
    return met.groupBy("at", "mark").agg(order.alias("_o")).select("at", "mark", F.col("_o.number").alias("second"))


def exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: its key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``n_chunks``.

    Texts are equal if they are identical after each run of ASCII white space
    became one space. Each is cut where its content says so; the chunks and the
    recipe, the ordered list of chunk prints, are written once. Only texts whose
    recipe print occurs again go on: their chunks meet by print and bytes,
    equal ones fold before the shuffle, and a print that different chunks share
    gets a number for each of them. The lists of these verified identifiers
    are compared in full. No whole text is shuffled; a group that holds a third
    of all rows is counted before it moves and joined by a split key.

    ``bits`` of the chunk prints are used; fewer only make more work.

    Defined cases: a null text is an empty one; the row with the smallest key
    stays, a null key ranks last, and of rows that repeat the smallest key one
    stays; text of any length is cut into rows of a bounded size. Other columns
    of ``docs`` are not read.
    """
    store = recipe_store(docs, key, text, bits)
    first = store.where(F.col("recipe").isNotNull())
    again = pin(first.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    suspects = lookup(store, again, ["mark"], weight="n", pinned=True)
    shared = shared_prints(suspects)
    rows = first.select("key", "at", "sha", "mark", "recipe")
    if shared.isEmpty():
        rows = rows.withColumn("second", F.lit(None).cast("array<long>"))
    else:
        rows = rows.join(ordinals(suspects, shared), ["at", "mark"], "left")
    # Nulls must meet, so the second list travels inside a struct.
    rows = rows.select("key", "at", "sha", "mark", F.struct("recipe", "second").alias("ids"))
    groups = pin(
        lookup(rows, again.select("mark", F.col("n").alias("_n")), ["mark"], weight="_n", pinned=True)
        .groupBy("mark", "ids")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("key").isNull().alias("none"), "key", "at")).alias("keep"))
        .where(F.col("n") > 1)
    )
    met = lookup(rows, groups, ["mark", "ids"], "left", weight="n", pinned=True)
    alone = F.col("n").isNull()
    return met.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("keep.key")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("at") == F.col("keep.at"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.size("ids.recipe").cast("long").alias("n_chunks"),
    )
