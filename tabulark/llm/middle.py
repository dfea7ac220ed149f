"""Fill-in-the-middle: documents cut into lines and rearranged, as one pyarrow.compute pipeline per batch."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of text that are cut at once; a document is never divided.
SLICE = 1 << 23

MADE = [
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
]


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers: the first groups of eight digits of sha256("seed:key")."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first, rows) of runs of rows with at most ``most`` bytes, a larger row alone."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        held = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, held + most, "right")), first + 1)
        yield first, last - first
        first = last


def unit_lists(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All lines with their newline, flattened: units, parent indices, ordinals, and units per text.

    The part behind the last newline is a unit only if it is not empty; an
    empty one stays in the flat array, as it joins to nothing, and is not counted.
    """
    lists = pc.split_pattern(text, "\n")
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    count = pc.list_value_length(lists).to_numpy().astype(np.int64)
    first = np.cumsum(count) - count
    ordinal = np.arange(len(flat)) - first[parent]
    last = ordinal == count[parent] - 1
    ends = pc.if_else(pa.array(last), pa.scalar("", flat.type), pa.scalar("\n", flat.type))
    units = pc.binary_join_element_wise(flat, ends, pa.scalar("", flat.type))
    tail = pc.equal(flat, pa.scalar("", flat.type)).to_numpy(zero_copy_only=False)[first + count - 1]
    return units, parent, ordinal, count - tail


def joined(units: pa.Array, parent: np.ndarray, role: np.ndarray, texts: int) -> pa.Array:
    """The chosen units of each text, as lists again and joined."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(parent[role], minlength=texts))])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), units.filter(pa.array(role)))
    return pc.binary_join(lists, pa.scalar("", units.type))


def rearranged(text: pa.Array, h: list[np.ndarray], rate: int, spm: int) -> list[pa.Array]:
    """The columns of ``MADE`` for a batch of texts."""
    text = pc.fill_null(text, pa.scalar("", text.type))
    units, parent, ordinal, n = unit_lists(text)
    one, two = h[0] % (n + 1), h[1] % (n + 1)
    low, high = np.minimum(one, two)[parent], np.maximum(one, two)[parent]
    roles = [ordinal < low, (ordinal >= low) & (ordinal < high), ordinal >= high]
    prefix, middle, suffix = (joined(units, parent, r, len(text)) for r in roles)
    glue = pa.scalar("", text.type)

    def around(*pieces: pa.Array | str) -> pa.Array:
        return pc.binary_join_element_wise(*[pa.scalar(p, text.type) if isinstance(p, str) else p for p in pieces], glue)

    marked = reduce(pc.or_, [pc.match_substring(text, m) for m in (PREFIX, SUFFIX, MIDDLE)])
    plain = pc.or_(pc.or_(pc.equal(text, glue), marked), pa.array(h[2] % 100 >= rate))
    spm_first = pa.array(h[3] % 100 < spm)
    output = pc.if_else(
        spm_first,
        around(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
        around(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle),
    )
    none = pa.scalar(None, pa.int64())

    def chars(piece: pa.Array) -> pa.Array:
        return pc.if_else(plain, none, pc.utf8_length(piece).cast(pa.int64()))

    return [
        pa.array(n, pa.int64()),
        pc.if_else(plain, PLAIN, pc.if_else(spm_first, SPM, PSM)),
        chars(prefix),
        chars(middle),
        pc.if_else(plain, text, output).cast(pa.string()),
    ]


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm: int = 50
) -> DataFrame:
    """``docs`` plus ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    A text of n lines, each with its newline, is cut at two of n + 1 places
    drawn from the seed and the key, into prefix, middle and suffix. ``rate``
    percent of the texts are rearranged, of these ``spm`` percent as suffix,
    prefix, middle, the others as prefix, suffix, middle, each part behind its
    mark. A text that is empty or holds a mark stays plain.

    One pass without a shuffle. A task holds the pieces of at most ``SLICE``
    bytes of text, or of one longer document.

    Defined cases: a null text counts as empty; a null key draws like an empty
    one; rows that repeat a key and text come out alike; the lengths are null
    for plain texts; columns of the five names are replaced, all others pass.
    """
    at = docs.columns.index(text)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(pc.struct_field(batch.column(0), at)), 0).to_numpy()
            for first, rows in slices(sizes.astype(np.int64), SLICE):
                part = batch.slice(first, rows)
                h = [part.column(i).to_numpy() for i in range(1, 5)]
                made = rearranged(pc.struct_field(part.column(0), at), h, rate, spm)
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["row", *[f.name for f in MADE]])

    drawn = [h.alias(f"h{i}") for i, h in enumerate(draws(F.col(key), seed), 1)]
    made = docs.select(F.struct(*docs.columns).alias("row"), *drawn).mapInArrow(
        emit, T.StructType([T.StructField("row", docs.schema, False), *MADE])
    )
    names = [f.name for f in MADE]
    return made.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in names], *names)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""

    def parts(*marks: str) -> Column:
        return F.split(F.substr(output, F.lit(1 + len(PREFIX))), "|".join(marks), -1)

    psm, spm = parts(SUFFIX, MIDDLE), parts(PREFIX, MIDDLE)
    return (
        F.when(form == PSM, F.concat(psm[0], psm[2], psm[1]))
        .when(form == SPM, F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )
