"""Collocations from suffix trees over words, built group by group after vertical partitioning.

A first scan counts how many suffixes start with each word, by hash class of
the word; a class above the memory budget is extended to two words and, if it
is still too large, to the whole leaf. Classes are packed into groups under the
budget. A second scan cuts every suffix to the longest phrase asked for, folds
equal ones and sends them to their group. Each group builds its subtree alone
and reads the count of every phrase from the totals of the leaves below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulark.llm.common import written
from tabulark.operators.joins import lookup
from tabulark.session import pin

NO_LANG = "und"
#: Hash classes of first words; the counts of classes are all that the driver sees.
CLASSES = 1 << 16
#: Suffixes in a group, the memory of one subtree.
BUDGET = 1 << 20
#: Bytes of text that are made into one partial tree.
SLICE = 1 << 22

U = np.uint64
WORD, BLANK, BREAK = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


# ---- Words ---------------------------------------------------------------------------


@dataclass
class Words:
    """Words of a stretch of text: 1-based codes into ``names``, and whether the next word follows in the piece."""

    codes: np.ndarray
    follows: np.ndarray
    names: pa.Array


def words_of(data: np.ndarray, starts: np.ndarray) -> Words:
    """``data`` holds texts that begin at ``starts``; nothing reaches over their borders."""
    kind = KIND[data]
    is_word = kind == WORD
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    at = starts[starts < len(data)]
    begins[at] = is_word[at]
    place = np.flatnonzero(begins)
    edges = np.append(np.cumsum(is_word)[place] - 1, np.count_nonzero(is_word)).astype(np.int32)
    letters = LOWER[data[is_word]]
    text = pa.StringArray.from_buffers(len(place), pa.py_buffer(edges), pa.py_buffer(letters))
    coded = text.dictionary_encode()
    # A word follows if neither a break nor the border of a text lies between.
    border = kind == BREAK
    piece = np.cumsum(border)[place]
    text_no = np.searchsorted(at, place, "right")
    follows = np.zeros(len(place), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (text_no[1:] == text_no[:-1])
    return Words(coded.indices.to_numpy().astype(np.int64) + 1, follows, coded.dictionary)


def stretches(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, text starts) of about ``SLICE`` bytes; a longer text is cut at a break between pieces."""
    if pa.types.is_large_string(text.type):
        text = text.cast(pa.string())
    if not len(text) or text.buffers()[2] is None:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8)
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + SLICE, end)
        if to < end:
            last = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            if last > at:
                to = last
            else:
                own = int(offsets[np.searchsorted(offsets, at, "right")])
                breaks = np.flatnonzero(KIND[data[to:own]] == BREAK)
                to = to + int(breaks[0]) + 1 if len(breaks) else own
        inside = offsets[(offsets >= at) & (offsets < to)] - at
        yield data[at:to], inside
        at = to


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    for batch in batches:
        for lang in pc.unique(batch.column(0)).to_pylist():
            own = batch.column(1).filter(pc.equal(batch.column(0), lang))
            for data, starts in stretches(own):
                found = words_of(data, starts)
                if len(found.codes):
                    yield lang, found


def suffixes(words: Words, depth: int) -> np.ndarray:
    """One row per word: the codes of the words from there on, at most ``depth`` and inside the piece, then 0."""
    out = np.zeros((len(words.codes), depth), np.int32)
    alive = np.ones(len(words.codes), bool)
    for k in range(depth):
        out[: len(alive), k] = np.where(alive, words.codes[k:], 0)
        alive = alive[:-1] & words.follows[k : len(words.codes) - 1][: len(alive) - 1]
    return out


def folded(rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in order, and how often each occurs."""
    width = int(rows.max(initial=0)) + 1
    key, top = rows[:, 0].astype(np.int64), width
    for k in range(1, rows.shape[1]):
        if top > (1 << 62) // width:
            seen, key = np.unique(key, return_inverse=True)
            top = len(seen)
        key, top = key * width + rows[:, k], top * width
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else order
    if counts is None:
        total = np.diff(np.append(first, len(key)))
    else:
        total = np.add.reduceat(counts[order], first) if len(first) else counts
    return rows[order[first]], total


# ---- Vertical partitioning -----------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_hashes(rows: np.ndarray, names: pa.Array, lang: str) -> list[np.ndarray]:
    """Per suffix a hash of the language and its first word, its first two words, and all of it."""
    import xxhash

    seed = xxhash.xxh3_64_intdigest(lang.encode())
    known = np.fromiter((xxhash.xxh3_64_intdigest(w.encode(), seed) for w in names.to_pylist()), np.uint64, len(names))
    of = np.concatenate([[U(0)], known])
    out, h = [], np.full(len(rows), U(1))
    for k in range(rows.shape[1]):
        h = mixed(h * U(0x9E3779B97F4A7C15) + of[rows[:, k]])
        out.append(h)
    return [out[0], out[min(1, len(out) - 1)], out[-1]]


@dataclass
class Partition:
    """Where prefixes go: class -> first cell and cells, cell -> first group and groups."""

    cell: np.ndarray
    cells: np.ndarray
    group: np.ndarray
    groups: np.ndarray
    #: Per group: nodes of one word, of two words, may be continued in other groups.
    parted: np.ndarray

    def cells_of(self, hashes: list[np.ndarray]) -> np.ndarray:
        own = (hashes[0] % U(CLASSES)).astype(np.int64)
        return self.cell[own] + (mixed(hashes[1]) % self.cells[own].astype(np.uint64)).astype(np.int64)

    def groups_of(self, hashes: list[np.ndarray]) -> np.ndarray:
        cell = self.cells_of(hashes)
        return self.group[cell] + (mixed(~hashes[2]) % self.groups[cell].astype(np.uint64)).astype(np.int64)


def classes_cut(counts: dict[int, int], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """First cell and number of cells per class: one, or more where the class is above the budget."""
    cells = np.ones(CLASSES, np.int64)
    for c, n in counts.items():
        if n > budget:
            cells[c] = -(-4 * n // budget)
    return np.cumsum(cells) - cells, cells


def packed_groups(cell: np.ndarray, cells: np.ndarray, counts: dict[int, int], inner: dict[int, int], budget: int) -> Partition:
    """Cells packed into groups of at most ``budget`` suffixes; those above it are cut by their leaves."""
    total = int(cells.sum())
    group, groups = np.zeros(total, np.int64), np.ones(total, np.int64)
    parted: list[tuple[bool, bool]] = []
    for wide in (False, True):
        held = budget + 1
        for c in np.flatnonzero((cells > 1) == wide).tolist():
            for k in range(int(cell[c]), int(cell[c] + cells[c])):
                n = inner.get(k, 0) if wide else counts.get(c, 0)
                if n > budget:
                    group[k], groups[k] = len(parted), -(-n // budget)
                    parted += [(True, True)] * int(groups[k])
                    held = budget + 1
                    continue
                if held + n > budget:
                    parted.append((wide, False))
                    held = 0
                group[k] = len(parted) - 1
                held += n
    return Partition(cell, cells, group, groups, np.array(parted, bool).reshape(-1, 2))


def counted(df: DataFrame, column: str) -> dict[int, int]:
    """Sums per class or cell; there are at most as many as the partition has."""
    return {r[0]: r[1] for r in df.groupBy(column).agg(F.sum("n")).collect()}


def vertical_partition(texts: DataFrame, depth: int, budget: int) -> Partition:
    """Counts by first word and, for the classes above the budget, by the first two."""

    def first_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CLASSES, np.int64)
        for lang, words in by_language(batches):
            own = np.arange(1, len(words.names) + 1)[:, None]
            h = prefix_hashes(own, words.names, lang)[0] % U(CLASSES)
            seen += np.bincount(h.astype(np.int64), np.bincount(words.codes - 1, minlength=len(own)), CLASSES).astype(np.int64)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held])], names=["class", "n"])

    counts = counted(texts.mapInArrow(first_words, "class long, n long"), "class")
    cell, cells = classes_cut(counts, budget)
    inner: dict[int, int] = {}
    if (cells > 1).any():
        plain = Partition(cell, cells, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), bool))

        def two_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(int(cells.sum()), np.int64)
            for lang, words in by_language(batches):
                rows, n = folded(suffixes(words, min(depth, 2)))
                at = plain.cells_of(prefix_hashes(rows, words.names, lang))
                seen += np.bincount(at, n, len(seen)).astype(np.int64)
            held = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held])], names=["cell", "n"])

        inner = counted(texts.mapInArrow(two_words, "cell long, n long"), "cell")
    return packed_groups(cell, cells, counts, inner, budget)


# ---- Subtrees ------------------------------------------------------------------------

TREE = "grp long, lang string, names binary, leaves binary, counts binary"
NODES = "lang string, size int, phrase string, n long"


def partial_trees(partition: Partition, depth: int):
    """Task function: texts to the part of each group's tree that a stretch of text gives."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        coder = zstandard.ZstdCompressor(level=1)
        for lang, words in by_language(batches):
            rows, n = folded(suffixes(words, depth))
            group = partition.groups_of(prefix_hashes(rows, words.names, lang))
            order = np.argsort(group, kind="stable")
            ids, first = np.unique(group[order], return_index=True)
            names, leaves, counts = [], [], []
            for a, b in zip(first, np.append(first[1:], len(order))):
                own = rows[order[a:b]]
                used, inverse = np.unique(own, return_inverse=True)
                # Code 0 says that the suffix has ended.
                used = used[used > 0]
                codes = inverse.reshape(own.shape) + (0 if (own == 0).any() else 1)
                names.append(words.names.take(pa.array(used - 1)))
                leaves.append(coder.compress(np.ascontiguousarray(codes.T.astype(np.int32)).tobytes()))
                counts.append(coder.compress(n[order[a:b]].tobytes()))
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *[len(x) for x in names]]), pa.int32()), pa.concat_arrays(names)
            )
            # A word holds no blank, so blanks part them.
            texts = [coder.compress(t.as_buffer()) for t in pc.binary_join(lists, " ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array([lang] * len(ids)), *[pa.array(x, pa.binary()) for x in (texts, leaves, counts)]],
                names=["grp", "lang", "names", "leaves", "counts"],
            )

    return emit


def nodes_of(rows: np.ndarray, counts: np.ndarray, names: pa.Array, least: int, parted: tuple[bool, bool]) -> Iterator[tuple]:
    """(words, phrases, counts) per depth of the tree whose leaves are ``rows``, in order.

    A node counts what the leaves below it count. Nodes below ``least`` are left
    out, but for those that other groups may continue.
    """
    depth = rows.shape[1]
    new = np.zeros(len(rows), bool)
    new[0] = True
    for k in range(depth):
        new[1:] |= rows[1:, k] != rows[:-1, k]
        start = np.flatnonzero(new)
        total = np.add.reduceat(counts, start)
        shown = rows[start, k] > 0
        if not ((k == 0 and parted[0]) or (0 < k < depth - 1 and parted[1])):
            shown &= total >= least
        start, total = start[shown], total[shown]
        columns = [names.take(pa.array(rows[start, j] - 1)) for j in range(k + 1)]
        yield k + 1, pc.binary_join_element_wise(*columns, " "), total


def subtrees(partition: Partition, depth: int, least: int):
    """Task function: partial trees, sorted by group and language, to the counted nodes of each whole one."""

    def whole(lang: str, group: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        names = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
        code = names.indices.to_numpy() + np.int32(1)
        rows, base = [], 0
        for own, leaves, _ in parts:
            of = np.concatenate([np.zeros(1, np.int32), code[base : base + len(own)]])
            rows.append(of[leaves.reshape(depth, -1).T])
            base += len(own)
        tree, total = folded(np.concatenate(rows), np.concatenate([p[2] for p in parts]))
        found = [(0, pa.array([""]), np.array([total.sum()]))]
        found += nodes_of(tree, total, names.dictionary, least, tuple(partition.parted[group]))
        for size, phrase, n in found:
            if len(phrase):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(phrase)), pa.array(np.full(len(phrase), size), pa.int32()), phrase, pa.array(n, pa.int64())],
                    names=["lang", "size", "phrase", "n"],
                )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        coder = zstandard.ZstdDecompressor()
        at, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                here = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if here != at and parts:
                    yield from whole(at[1], at[0], parts)
                    parts = []
                at = here
                leaves = np.frombuffer(coder.decompress(batch.column(3)[i].as_py()), np.int32)
                counts = np.frombuffer(coder.decompress(batch.column(4)[i].as_py()), np.int64)
                text = pa.array([coder.decompress(batch.column(2)[i].as_py())], pa.binary()).cast(pa.string())
                parts.append((pc.split_pattern(text, " ").flatten(), leaves, counts))
        if parts:
            yield from whole(at[1], at[0], parts)

    return emit


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", most_words: int = 3, least: int = 10, budget: int = BUDGET
) -> DataFrame:
    """(lang, size, phrase, n): how often each phrase of 1 to ``most_words`` words occurs, if at least ``least`` times.

    The phrase of size 0 is empty and counts all words of the language.
    """
    texts = docs.select(
        F.coalesce(F.col(lang), F.lit(NO_LANG)).cast("string").alias("lang"), F.coalesce(text, F.lit("")).alias("text")
    )
    partition = vertical_partition(texts, most_words, budget)
    parts = texts.mapInArrow(partial_trees(partition, most_words), TREE)
    nodes = (
        parts.repartition("grp").sortWithinPartitions("grp", "lang").mapInArrow(subtrees(partition, most_words, least), NODES)
    )
    return (
        nodes.groupBy("lang", "size", "phrase")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= least) | (F.col("size") == 0))
    )


# ---- Scores --------------------------------------------------------------------------


def part_of(phrase: str, first: Column, words: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, words), " ")


def scored(counts: DataFrame, candidates: DataFrame) -> DataFrame:
    """``candidates`` with l, r and score of their weakest cut; exact, as products are decimals of 38 digits."""
    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*",
        part_of("phrase", F.lit(1), F.col("k")).alias("head"),
        part_of("phrase", F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    known = counts.where((F.col("size") > 0) & (F.col("size") < F.lit(candidates.agg(F.max("size")).first()[0] or 0)))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    # Plain joins: both sides are small beside the texts, and AQE splits a part that many candidates share.
    met = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    exact = met.withColumns({"x": F.lit(1_000_000).cast("decimal(7,0)") * (wide["a"] * wide["a"]), "y": wide["l"] * wide["r"]})
    return (
        exact.select("lang", "phrase", F.struct(F.expr("x div y").alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase")
        .agg(F.min("cut").alias("cut"))
        .select("lang", "phrase", "cut.l", "cut.r", "cut.score")
    )


def inside_longer(candidates: DataFrame, shortest: int) -> DataFrame:
    """(lang, phrase, longer): per phrase the count of the most frequent longer candidate that holds it."""
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(shortest), F.col("size") - 1),
            lambda w: F.transform(F.sequence(F.lit(1), F.col("size") - w + 1), lambda i: part_of("phrase", i, w)),
        )
    )
    return (
        candidates.where(F.col("size") > shortest)
        .select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    words: tuple[int, int] = (2, 3),
    least: int = 10,
    held: int = 50,
    top: int = 2000,
    budget: int = BUDGET,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces,
    these at blanks and tabs into words. A candidate is a phrase with a word
    number within ``words`` that occurs a >= ``least`` times. Each cut in two parts that
    occur l and r times gives floor(10^6 a a / (l r)), the lowest counts, of
    equal ones that with the shorter first part. A candidate inside a longer
    one that occurs at least ``held`` percent as often is dropped. Order:
    score, then a, both descending, then the phrase by its bytes.

    All words of all texts are counted, by suffix subtrees as said above. What a
    task holds is bounded by ``budget`` suffixes; a frequent word is spread over
    groups by its next words, and equal suffixes are folded before they move.

    Defined cases: a null text is empty, a null language is ``und`` and one with
    that name; a language without candidates has no rows; rows that repeat a
    document count again. Other columns are not read.
    """
    low, high = words
    counts = written(phrase_counts(docs, text, lang, high, least, budget), "phrases")
    candidates = pin(counts.where((F.col("size") >= low) & (F.col("size") <= high)).withColumnRenamed("n", "a"))
    longer = inside_longer(candidates, low)
    free = (
        candidates.join(longer, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * held))
        .select("lang", "phrase", "size", "a")
    )
    best = free.select("lang", "phrase", "a").join(scored(counts, free), ["lang", "phrase"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.where(F.col("size") == 0).select("lang", "n")
    return lookup(ranked, totals, ["lang"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
