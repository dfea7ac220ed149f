"""Repeated byte strings, found by suffix arrays built by linear grouping.

Which suffixes are worth sorting together is decided by content: every window
of 200 bytes has one anchor, the least hash among its 64-byte strings, so equal
windows have equal anchors. Consecutive windows with one anchor are a run, the
unit that travels. Runs whose anchor stands nowhere else are through; equal
runs fold into one with a count; runs that share an anchor and differ are
sorted as suffixes, and windows that are neighbours in that order and equal
are repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.llm.common import text_of, written
from tabulark.operators.joins import lookup

WINDOW = 200
ANCHOR = 64
#: Bytes whose windows are hashed at once.
CHUNK = 1 << 21
#: Bytes that are suffix-sorted at once; a group of runs is never cut.
SORTED = 1 << 16
#: Groups with more different runs are settled window by window.
CROWD = 4_000
PLACE_BITS = 22

U = np.uint64


# ---- Suffix array by linear grouping -------------------------------------------------


def lyndon_groups(text: bytes | list[int]) -> tuple[list[int], list[int]]:
    """Groups of suffixes by longest Lyndon prefix, and the previous-smaller pointers.

    The last symbol must be the only smallest. Groups start as equal first
    symbols and are taken in descending order. Every member points to the
    nearest earlier suffix of a lower group; a suffix that k members point to
    is continued by k copies of the group's prefix, so it moves behind the rest
    of its own group, the more copies the higher. A group is named by its first
    place in the order, so splitting renames only the suffixes that move.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    first = 0
    for k, i in enumerate(order):
        if k and text[i] != text[order[k - 1]]:
            first = k
        place[i], group[i] = k, first
        size[first] += 1
    before = list(range(-1, n - 1))
    end = n - 1
    while end > 0:
        i = order[end]
        here = group[i]
        if here == end:
            p = before[i]
            while p >= 0 and group[p] > here:
                p = before[p]
            before[i] = p
            if p >= 0:
                own = group[p]
                left = size[own] - 1
                if left:
                    size[own] = left
                    to = own + left
                    at, other = place[p], order[to]
                    order[at], order[to] = other, p
                    place[other], place[p] = at, to
                    group[p], size[to] = to, 1
            end -= 1
            continue
        pointed: dict[int, int] = {}
        for i in sorted(order[here : end + 1]):
            p = before[i]
            while p >= 0 and group[p] >= here:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        end = here - 1
        copies = sorted(set(pointed.values()), reverse=True)
        for k in copies:
            split: dict[int, list[int]] = {}
            for p, c in pointed.items():
                if c == k:
                    split.setdefault(group[p], []).append(p)
            for own, moved in split.items():
                left = size[own] - len(moved)
                if not left:
                    continue
                size[own] = left
                start = own + left
                size[start] = len(moved)
                for to, p in enumerate(moved, start):
                    at, other = place[p], order[to]
                    order[at], order[to] = other, p
                    place[other], place[p] = at, to
                    group[p] = start
    return group, before


def suffix_array(text: bytes | list[int]) -> list[int]:
    """All suffixes in order: each group's order is emitted without sorting it again.

    Going up the finished order, the suffixes that end their Lyndon prefix where
    the current one starts are next in their groups. They are the one before it
    and those its pointers lead to, as far as they are larger, that is, not yet
    emitted.
    """
    group, before = lyndon_groups(text)
    n = len(text)
    out, free, todo = [0] * n, list(range(n)), [True] * n
    out[0], todo[n - 1] = n - 1, False
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and todo[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            todo[j] = False
            j = before[j]
    return out


# ---- Anchors and runs ----------------------------------------------------------------


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def anchors(data: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the string at every place, and the anchor place of the window at every place."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1))
    words = np.ascontiguousarray(words).view("<u8").ravel()
    count = len(data) - anchor + 1
    value = np.zeros(count, np.uint64)
    for step in range(0, anchor, 8):
        value *= U(0x9E3779B97F4A7C15)
        value += words[step : step + count]
    value = stirred(value)
    # High bits hash, low bits place: the least is the leftmost of the least hashes.
    low = U((1 << PLACE_BITS) - 1)
    least = (value & ~low) | np.arange(count, dtype=np.uint64)
    width, span = window - anchor + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: span - width], least[width - span :])
    return value, (least & low).astype(np.int64)


def runs_of(texts: list[bytes], window: int, anchor: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes, int]]:
    """Per piece of a text: its number, anchor hashes, run starts, window counts, anchor offsets, bytes, first place."""
    for number, text in enumerate(texts):
        for base in range(0, max(len(text) - window + 1, 0), CHUNK):
            piece = text[base : base + CHUNK + window - 1]
            value, at = anchors(np.frombuffer(piece, np.uint8), window, anchor)
            edge = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            count = np.diff(np.r_[edge, len(at)])
            yield number, value[at[edge]], edge, count, at[edge] - edge, piece, base


def packed(start: np.ndarray, count: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return (start << 33) | (count << 25) | (offset << 17)


def unpacked(pack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return pack >> 33, pack >> 25 & 255, pack >> 17 & 255


def run_table(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, print, doc, mark, pack) per run; ``docs`` is (doc, mark, text)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            doc, mark = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = (t.as_py().encode("utf-8", "surrogatepass") for t in batch.column(2))
            held: list[tuple] = []
            size = 0
            for number, value, start, count, offset, piece, base in runs_of(texts, window, anchor):
                view = memoryview(piece)
                prints = np.fromiter(
                    (
                        xxhash.xxh3_64_intdigest(view[s : s + c + window - 1], o)
                        for s, c, o in zip(start.tolist(), count.tolist(), offset.tolist())
                    ),
                    np.uint64,
                    len(start),
                )
                held.append(
                    (value.view(np.int64), prints.view(np.int64), np.full(len(start), doc[number]), np.full(len(start), mark[number]), packed(start + base, count, offset))
                )
                size += len(start)
                if size >= 1 << 16:
                    yield _batch(held)
                    held, size = [], 0
            if held:
                yield _batch(held)

    def _batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["anchor", "print", "doc", "mark", "pack"])

    return docs.mapInArrow(emit, "anchor long, print long, doc long, mark long, pack long")


# ---- Settling runs that share an anchor ----------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    off = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (off.bit_length() + 7) // 8


def reach(sides: list[bytes]) -> list[int]:
    """Per string the longest prefix that it shares with any other one."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for a, b in zip(order, order[1:]):
        both = common(sides[a], sides[b])
        out[a], out[b] = max(out[a], both), max(out[b], both)
    return out


def repeated_places(strings: list[bytes], window: int) -> list[list[int]]:
    """Per string the places whose window of bytes stands at another place too."""
    joined = b"\x00".join(strings)
    symbols = [c + 2 for c in joined]
    at, starts = 0, []
    for s in strings:
        starts.append(at)
        at += len(s)
        if at < len(symbols):
            symbols[at] = 1
        at += 1
    symbols.append(0)
    owner = [-1] * len(symbols)
    for k, (start, s) in enumerate(zip(starts, strings)):
        for i in range(start, start + len(s) - window + 1):
            owner[i] = k
    found: list[list[int]] = [[] for _ in strings]
    last, last_bytes, last_in = -1, b"", True
    for i in suffix_array(symbols):
        k = owner[i]
        if k < 0:
            continue
        here = joined[i : i + window]
        if here == last_bytes:
            found[k].append(i - starts[k])
            if not last_in:
                found[owner[last]].append(last - starts[owner[last]])
            last_in = True
        else:
            last_in = False
        last, last_bytes = i, here
    return found


def settle(groups: list[list[tuple[bytes, int, int]]], window: int) -> list[list[list[int]]]:
    """Per group and run (bytes, anchor offset, copies) the repeated window places.

    A window can only stand elsewhere as far as its run agrees with another one
    to both sides of the anchor, so runs are cut to that reach before sorting.
    Cut runs that became equal are sorted as two, which is as good as all.
    """
    strings: list[bytes] = []
    homes: list[list[tuple[int, int] | None]] = []
    for group in groups:
        left = reach([bytes(b[:o][::-1]) for b, o, _ in group])
        right = reach([b[o:] for b, o, _ in group])
        twice: dict[bytes, list[int]] = {}
        home: list[tuple[int, int] | None] = []
        for (b, o, _), x, y in zip(group, left, right):
            if x + y < window:
                home.append(None)
                continue
            cut = b[o - x : o + y]
            seen = twice.setdefault(cut, [])
            if len(seen) < 2:
                seen.append(len(strings))
                strings.append(cut)
            home.append((seen[0], o - x))
        homes.append(home)
    places = repeated_places(strings, window) if strings else []
    return [[[p + h[1] for p in places[h[0]]] if h else [] for h in home] for home in homes]


def covered(places: list[int], window: int) -> list[tuple[int, int]]:
    """Merged (from, to) of the windows at these places."""
    out: list[tuple[int, int]] = []
    for p in sorted(places):
        if out and p <= out[-1][1]:
            out[-1] = (out[-1][0], p + window)
        else:
            out.append((p, p + window))
    return out


def sorted_groups(window: int):
    """Task function: (anchor, pack, doc, mark, copies, bytes), sorted by anchor, to repeated (doc, mark, from, to)."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*[c.to_pylist() for c in b.columns])

        def flush(waiting: list[list[tuple]]) -> pa.RecordBatch:
            groups = [[(r[5], r[1] >> 17 & 255, r[4]) for r in g] for g in waiting]
            out: list[tuple] = []
            for g, found in zip(waiting, settle(groups, window)):
                for (_, pack, doc, mark, copies, _), places in zip(g, found):
                    if copies == 1 and places:
                        start = pack >> 33
                        out.extend((doc, mark, start + a, start + z) for a, z in covered(places, window))
            columns = list(zip(*out)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "mark", "from", "to"])

        waiting, size = [], 0
        for _, group in groupby(rows(), key=lambda r: r[0]):
            waiting.append(list(group))
            size += sum(len(r[5]) for r in waiting[-1])
            if size >= SORTED:
                yield flush(waiting)
                waiting, size = [], 0
        if waiting:
            yield flush(waiting)

    return solve


def window_prints(window: int):
    """Task function for crowded groups: a print of every window, with the place it stands at."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = ["one", "two", "doc", "mark", "from", "copies"]
        for batch in batches:
            out: list[tuple] = []
            for _, pack, doc, mark, copies, data in zip(*[c.to_pylist() for c in batch.columns]):
                start, offset, view = pack >> 33, pack >> 17 & 255, memoryview(data)
                for p in range(len(data) - window + 1):
                    value = xxhash.xxh3_128_intdigest(view[p : p + window], offset - p & 0xFFFF)
                    out.append((value >> 65, value & (1 << 63) - 1, doc, mark, start + p, copies))
                if len(out) >= 1 << 15:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    return emit


# ---- The operator --------------------------------------------------------------------


def squeezed(docs: DataFrame) -> DataFrame:
    """(doc, mark, size, squeezed text): what is shuffled instead of the text."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for b in batches:
            coder = zstandard.ZstdCompressor(level=1)
            raw = [t.as_py().encode("utf-8", "surrogatepass") for t in b.column(2)]
            small = pa.array([coder.compress(t) for t in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), small], names=["doc", "mark", "z"])

    return docs.select("doc", "mark", "text").mapInArrow(squeeze, "doc long, mark long, z binary")


def _cut_runs(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    import zstandard

    names = ["anchor", "pack", "doc", "mark", "copies", "crowd", "data"]
    kinds = [*[pa.int64()] * 6, pa.binary()]
    for b in batches:
        coder = zstandard.ZstdDecompressor()
        out: list[tuple] = []
        for doc, mark, z, wanted in zip(*[c.to_pylist() for c in b.columns]):
            text = coder.decompress(z)
            for w in wanted:
                start, count = w["pack"] >> 33, w["pack"] >> 25 & 255
                out.append((w["anchor"], w["pack"], doc, mark, w["copies"], w["crowd"], text[start : start + count + window - 1]))
            if len(out) >= 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _keep_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    names = ["doc", "n_bytes", "spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])), pa.binary()]
    for b in batches:
        coder = zstandard.ZstdDecompressor()
        out: list[tuple] = []
        size = 0
        for doc, z, spans in zip(*[c.to_pylist() for c in b.columns]):
            text, at, rest = coder.decompress(z), 0, []
            merged: list[dict] = []
            for s in sorted(spans or (), key=lambda s: s["from"]):
                if merged and s["from"] <= merged[-1]["to"]:
                    merged[-1]["to"] = max(merged[-1]["to"], s["to"])
                else:
                    merged.append(dict(s))
            for s in merged:
                rest.append(text[at : s["from"]])
                at = s["to"]
            rest.append(text[at:])
            out.append((doc, len(text), merged, b"".join(rest)))
            size += len(text)
            if size >= 1 << 24:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def drop_repeated_strings(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, crowd: int = CROWD
) -> DataFrame:
    """Per document its key, ``n_bytes``, ``spans`` (from, to) removed and ``kept`` bytes.

    Every byte covered by a string of ``window`` bytes that starts anywhere else
    too, in the same or another document, is removed; all is judged on the
    input. Texts are UTF-8 bytes, and no string crosses documents.

    Two passes read the texts; one shuffle moves them, compressed. Anchors that
    stand only once leave after a count of anchors. Equal runs are counted, not
    gathered. A group with more than ``crowd`` different runs, such as a passage
    in a third of all documents, is not sorted in one task: its windows are
    counted one by one, which is as exact and spreads over tasks.

    Defined cases: a null text counts as empty; a text below ``window`` bytes
    loses nothing; null keys pass through; a document is known by its key and a
    64-bit hash of its text, so rows with a null or repeated key are documents
    of their own, so a repeated row loses what the other has; other columns are
    ignored; an empty table gives no rows. The key is an integer.
    """
    full = text_of(text)
    none = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.coalesce(F.col(key).cast("long"), none).alias("doc"), F.xxhash64(full).alias("mark"), full.alias("text"))
    runs = run_table(rows, window, anchor)
    short = F.shiftright("anchor", 32).cast("int")
    # Small sides are written before they are joined: both sides of the join are
    # then plain shuffles, and adaptive execution may split one anchor's rows.
    counted = runs.select(short.alias("short")).groupBy("short").agg(F.count(F.lit(1)).alias("n"))
    often = written(counted.where(F.col("n") > 1).select("short"), "often")
    again = written(runs.withColumn("short", short).join(often, "short").drop("short"), "runs")
    kinds = written(
        again.groupBy("anchor", "print").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "mark", "pack")).alias("at")),
        "kinds",
    )
    differing = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("crowd")).where(F.col("crowd") > 1)
    start = F.shiftright("pack", 33)
    windows = F.shiftright("pack", 25).bitwiseAND(F.lit(255))
    copied = again.join(kinds.where(F.col("copies") > 1).select("anchor", "print"), ["anchor", "print"]).select(
        "doc", "mark", start.alias("from"), (start + windows + (window - 1)).alias("to")
    )
    wanted = (
        lookup(kinds, differing, ["anchor"], weight="crowd")
        .select("anchor", "copies", "crowd", "at.doc", "at.mark", "at.pack")
        .groupBy("doc", "mark")
        .agg(F.collect_list(F.struct("anchor", "pack", "copies", "crowd")).alias("wanted"))
    )
    small = squeezed(rows)
    cut = written(
        small.join(wanted, ["doc", "mark"])
        .select("doc", "mark", "z", "wanted")
        .mapInArrow(
            lambda b: _cut_runs(b, window), "anchor long, pack long, doc long, mark long, copies long, crowd long, data binary"
        ),
        "cut",
    )
    grouped = cut.where(F.col("crowd") <= crowd).select("anchor", "pack", "doc", "mark", "copies", "data")
    by_sort = (
        grouped.repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(sorted_groups(window), "doc long, mark long, from long, to long")
    )
    prints = (
        cut.where(F.col("crowd") > crowd).select("anchor", "pack", "doc", "mark", "copies", "data")
        .mapInArrow(window_prints(window), "one long, two long, doc long, mark long, from long, copies long")
    )
    met = prints.groupBy("one", "two").agg(F.sum("copies").alias("n")).where(F.col("n") > 1).select("one", "two")
    by_print = prints.where(F.col("copies") == 1).join(met, ["one", "two"]).select(
        "doc", "mark", "from", (F.col("from") + window).alias("to")
    )
    spans = (
        copied.unionByName(by_sort).unionByName(by_print)
        .groupBy("doc", "mark")
        .agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    )
    kept = (
        squeezed(rows).join(spans, ["doc", "mark"], "left")
        .select("doc", "z", "spans")
        .mapInArrow(_keep_rest, "doc long, n_bytes long, spans array<struct<from:long,to:long>>, kept binary")
    )
    kind = docs.schema[key].dataType
    return kept.select(F.when(F.col("doc") != none, F.col("doc")).cast(kind).alias(key), "n_bytes", "spans", "kept")


def removed(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"])
