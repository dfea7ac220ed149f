"""Near copies by ProbMinHash signatures of weighted word shingles, banding and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.llm.common import written
from tabulark.llm.components import components, kept
from tabulark.operators.joins import lookup

WORDS = 5
LEAST = 0.8
BANDS = 24
ROWS = 4
#: Pairs whose signatures agree on a smaller share are not verified. At the true
#: similarity of 0.8 and 96 places this lies almost five deviations low.
DOUBT = 0.6
#: Buckets of at most so many members are settled pair by pair, larger ones by tiles.
SMALL = 64
TILE = 256
CHUNK = 1 << 20
PLACES = 64

U = np.uint64


@cache
def byte_weights() -> np.ndarray:
    """A random number per byte value and place inside a word (places repeat every 64 bytes)."""
    return np.random.default_rng(11).integers(0, 1 << 63, (PLACES, 256), dtype=np.uint64).ravel()


@cache
def blanks() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per maximal run of bytes other than ASCII white space."""
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], ~blanks()[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    length = end - start
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    place = np.arange(length.sum()) - np.repeat(first, length)
    bytes_in = data[np.repeat(start, length) + place]
    return stirred(np.add.reduceat(byte_weights()[(place % PLACES) * 256 + bytes_in], first) + length.astype(np.uint64))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; a shorter text is one shingle of all its words."""
    if not len(words):
        return words
    size = min(size, len(words))
    value = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        value = value * U(0x9E3779B97F4A7C15) + words[i : i + len(value)]
    return stirred(value)


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, places: int) -> np.ndarray:
    """ProbMinHash of ``docs`` weighted sets at once; two agree on a place with their probability Jaccard.

    Every shingle has a Poisson process of its weight's rate. Round t holds the
    t-th arrivals: each picks a place of its document and stands there if it is
    the earliest. A shingle goes on only while its time lies below the latest
    time standing in its document; later arrivals could change nothing.
    """
    earliest, standing = np.full(docs * places, np.inf), np.zeros(docs * places, np.uint64)
    time, base, t = np.zeros(len(doc)), doc * places, 0
    while len(doc):
        t += 1
        draw = stirred(shingle + stirred(np.full(1, t, np.uint64))[0])
        time = time - np.log(((draw >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        slot = base + (stirred(draw) % U(places)).astype(np.int64)
        np.minimum.at(earliest, slot, time)
        won = earliest[slot] == time
        standing[slot[won]] = shingle[won]
        latest = earliest.reshape(docs, places).max(axis=1)
        alive = time < latest[doc]
        doc, shingle, weight, time, base = doc[alive], shingle[alive], weight[alive], time[alive], base[alive]
    return standing.reshape(docs, places)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over shared d of 1 / sum over all e of max(a_e / a_d, b_e / b_d); sets sorted."""
    both, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    if wa.max() == 1 and wb.max() == 1:
        return len(both) / (len(a) + len(b) - len(both))
    only_a, only_b = np.ones(len(a), bool), np.ones(len(b), bool)
    only_a[ia], only_b[ib] = False, False
    rest_a, rest_b = wa[only_a].sum(), wb[only_b].sum()
    kinds, n = np.unique(np.stack([wa[ia], wb[ib]], axis=1), axis=0, return_counts=True)
    total = 0.0
    for (x, y), k in zip(kinds, n):
        shared = (np.maximum(kinds[:, 0] / x, kinds[:, 1] / y) * n).sum()
        total += k / (shared + rest_a / x + rest_b / y)
    return total


PROFILE = "print_a long, print_b long, keys array<long>, signature binary, shingles binary, counts binary"


def profiles(docs: DataFrame, key: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """Per document a print of its words, band keys, signature and weighted shingles; null without words."""
    places = bands * rows

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, *[x.split()[0] for x in PROFILE.split(", ")]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]

        def block(ids: list, prints: list, sets: list) -> pa.RecordBatch:
            full = [i for i, s in enumerate(sets) if s is not None]
            doc = np.repeat(np.arange(len(full)), [len(sets[i][0]) for i in full])
            every = np.concatenate([sets[i][0] for i in full]) if full else np.empty(0, np.uint64)
            weight = np.concatenate([sets[i][1] for i in full]).astype(np.float64) if full else np.empty(0)
            signed = signatures(doc, every, weight, len(full), places)
            value = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(full), 1))
            for r in range(rows):
                value = stirred(value * U(0x9E3779B97F4A7C15) + signed[:, r::rows])
            cells: list[list] = [[None] * len(ids) for _ in kinds]
            for row, i in enumerate(full):
                small = sets[i][0].astype(np.uint32)
                order = np.argsort(small, kind="stable")
                once, first = np.unique(small[order], return_index=True)
                counts = np.add.reduceat(sets[i][1][order], first).astype(np.uint32)
                found = (*prints[i], value[row].view(np.int64), signed[row].astype(np.uint32).tobytes(), once.tobytes(), counts.tobytes())
                for cell, x in zip(cells, found):
                    cell[i] = x
            return pa.RecordBatch.from_arrays([pa.array(ids, id_kind), *[pa.array(c, k) for c, k in zip(cells, kinds)]], names=names)

        id_kind = None
        ids, prints, sets, size = [], [], [], 0
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = word_hashes((t.as_py() or "").lower().encode("utf-8", "surrogatepass"))
                ids.append(k)
                if len(hashes):
                    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                    prints.append(np.frombuffer(digest, np.int64).tolist())
                    sets.append(np.unique(shingles(hashes, words), return_counts=True))
                else:
                    prints.append(None)
                    sets.append(None)
                size += len(hashes)
                if size >= CHUNK // 8 or len(ids) >= 2000:
                    yield block(ids, prints, sets)
                    ids, prints, sets, size = [], [], [], 0
        if ids:
            yield block(ids, prints, sets)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(profile, f"`{key}` {kind}, {PROFILE}")


def _pairs_with(pairs: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    for side in ("a", "b"):
        named = facts.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(named, side)
    return pairs


def verified(pairs: DataFrame, facts: DataFrame, least: float, doubt: float) -> DataFrame:
    """The pairs whose exact probability Jaccard is at least ``least``."""

    def plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            same = [
                (np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).mean() >= doubt
                for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())
            ]
            yield b.select([0, 1]).filter(pa.array(same, pa.bool_()))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [[np.frombuffer(x, np.uint32) for x in b.column(i).to_pylist()] for i in range(2, 6)]
            near = [
                probability_jaccard(a, wa.astype(np.int64), c, wc.astype(np.int64)) >= least for a, wa, c, wc in zip(*sets)
            ]
            yield b.select([0, 1]).filter(pa.array(near, pa.bool_()))

    signed = _pairs_with(pairs, facts, ["signature"])
    likely = signed.select("a", "b", "signature_a", "signature_b").mapInArrow(plausible, "a long, b long")
    full = _pairs_with(likely, facts, ["shingles", "counts"])
    return full.select("a", "b", "shingles_a", "counts_a", "shingles_b", "counts_b").mapInArrow(exact, "a long, b long")


def near_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    least: float = LEAST,
    bands: int = BANDS,
    rows: int = ROWS,
    doubt: float = DOUBT,
    small: int = SMALL,
    tile: int = TILE,
) -> DataFrame:
    """Per document its key, ``group_id`` (smallest key of its group) and ``kept`` (it has that key).

    Two documents are linked when the probability Jaccard of their weighted
    word shingles is at least ``least``; groups are what links connect. Texts
    with the same words fold into one before anything is compared. Documents
    that share a band key meet in a bucket; each is verified against the
    smallest and the largest member, so a bucket of any size costs two pairs a
    member. Buckets that still hold several groups are then settled: small ones
    by all pairs across groups, larger ones by tiles: first each member's best
    partner by signature, then all plausible pairs of different groups, verified
    inside the tile, which only links leave. Only keys, signatures of candidates and shingles of
    plausible pairs are shuffled.

    Words are runs other than ASCII white space, lower-cased; a text with fewer
    than ``words`` of them is one shingle. Defined cases: a text that is null or
    has no word is a group of its own; a null key gets a null group and is kept;
    rows that repeat a key belong together; other columns are ignored; an empty
    table gives no rows.
    """
    rows_in = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    found = written(profiles(rows_in, "id", "text", words, bands, rows), "profiles")
    able = found.where(F.col("print_a").isNotNull() & F.col("id").isNotNull())
    firsts = written(
        able.groupBy("print_a", "print_b").agg(F.min("id").alias("node"), F.min_by("keys", "id").alias("keys")), "firsts"
    )
    members = firsts.select("node", F.explode("keys").alias("bucket"))
    shared = (
        members.groupBy("bucket")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    buckets = written(members.join(shared, "bucket"), "buckets")
    # Only documents that share a bucket are ever compared; their ids are sent out if they are few.
    wanted = written(buckets.select("node").distinct(), "wanted")
    full = able.select(F.col("id").alias("node"), "keys", "signature", "shingles", "counts")
    facts = written(lookup(full, wanted, ["node"], "left_semi", pinned=True).dropDuplicates(["node"]), "facts")
    groups = _groups(facts, buckets, least, doubt, small, tile)
    group = (
        firsts.join(groups.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
        .select("print_a", "print_b", F.coalesce("component", "node").alias("_group"))
    )
    return (
        found.select("id", "print_a", "print_b")
        .join(group, ["print_a", "print_b"], "left")
        .select(F.col("id").alias(key), F.when(F.col("id").isNotNull(), F.coalesce("_group", "id")).alias("group_id"))
        .withColumn("kept", F.col(key).eqNullSafe(F.col("group_id")))
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()


def _groups(
    facts: DataFrame, buckets: DataFrame, least: float, doubt: float, small: int, tile: int
) -> DataFrame:
    """``node`` and ``component`` of every member that has a verified link."""
    low = buckets.select(F.col("low").alias("a"), F.col("node").alias("b"))
    high = buckets.where(F.col("n") > 2).select(F.col("node").alias("a"), F.col("high").alias("b"))
    rows = 2 * buckets.count()
    tried = kept(_ordered(low.union(high)), rows)
    links = written(verified(tried, facts, least, doubt), "links")
    groups = components(links)
    mixed = _mixed(buckets, groups, rows)
    few = mixed.where(F.col("n") <= small)
    other = few.select("bucket", F.col("node").alias("b"), F.col("group").alias("other"))
    across = few.join(other, "bucket").where((F.col("node") < F.col("b")) & (F.col("group") != F.col("other")))
    fresh = written(_ordered(across.select(F.col("node").alias("a"), "b")).join(tried, ["a", "b"], "left_anti"), "fresh")
    groups = _united(groups, written(verified(fresh, facts, least, doubt), "links"))
    crowded = buckets.where(F.col("n") > small)
    if crowded.isEmpty():
        return groups
    # Each member's best partner of another group, twice over its largest bucket: this unites what hangs together.
    most = F.max_by(F.struct("bucket", "n", "low", "high"), F.struct("n", "bucket")).alias("b")
    largest = kept(crowded.groupBy("node").agg(most).select("node", "b.*"), rows)
    for _ in range(2):
        rest = _mixed(largest, groups, rows)
        pairs = written(_ordered(best_pairs(rest, facts, doubt, tile)), "pairs")
        before, groups = groups, _united(groups, written(verified(pairs, facts, least, doubt), "links"))
        if groups is before:
            break
    # What is left is verified pair by pair inside the tiles; only links leave them.
    rest = _mixed(crowded, groups, rows)
    return _united(groups, written(tile_links(rest, facts, least, doubt, tile), "links"))


def _united(groups: DataFrame, more: DataFrame) -> DataFrame:
    """``groups`` after further links; a group goes on as links to its component, which settle at once."""
    if more.isEmpty():
        return groups
    return components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more.select("a", "b")))


def _mixed(buckets: DataFrame, groups: DataFrame, rows: int) -> DataFrame:
    """Members of the buckets that hold more than one group, each with its group."""
    placed = buckets.join(groups.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "bucket", "node", "n", F.coalesce("component", "node").alias("group")
    )
    ends = placed.groupBy("bucket").agg(F.min("group").alias("g"), F.max("group").alias("h")).where(F.col("g") != F.col("h"))
    return kept(placed.join(ends.select("bucket"), "bucket"), rows, "mixed")


def _tiles(members: DataFrame, facts: DataFrame, columns: list[str], tile: int) -> DataFrame:
    """Task groups in which every two members of different groups of a bucket meet once.

    A bucket's largest group needs no look inside. Its members are dealt to
    parts of about ``tile`` once per part of the rest, and the parts of the rest
    meet each other; so what travels grows with the rest, not with the square
    of the bucket.
    """
    sizes = members.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("c"))
    largest = sizes.groupBy("bucket").agg(
        F.max_by("group", F.struct("c", "group")).alias("main"),
        F.ceil(F.max("c") / F.lit(tile)).cast("int").alias("main_parts"),
        F.ceil((F.sum("c") - F.max("c")) / F.lit(tile)).cast("int").alias("rest_parts"),
    )
    each = members.join(largest, "bucket").join(facts.select("node", *columns), "node")
    draw, parts = F.xxhash64("node"), F.col("rest_parts")
    rest = each.where(F.col("group") != F.col("main")).withColumn("own", F.pmod(draw, parts).cast("int"))
    main = each.where(F.col("group") == F.col("main")).withColumn("own", F.pmod(draw, F.col("main_parts")).cast("int"))
    kept = ["bucket", "node", "group", *columns]

    def placed(df: DataFrame, upto: str, lower: Column, upper: Column, part: Column) -> DataFrame:
        dealt = df.select(*kept, "own", F.explode(F.sequence(F.lit(0), F.col(upto) - 1)).alias("other"))
        return dealt.select(*kept, lower.alias("lower"), upper.alias("upper"), part.alias("part"))

    own, other = F.col("own"), F.col("other")
    inside = placed(rest, "rest_parts", F.least(own, other), F.greatest(own, other), own)
    across = placed(rest, "main_parts", -1 - own, other, -1 - own)
    return inside.unionByName(across).unionByName(placed(main, "rest_parts", -1 - other, own, own))


class _Tile:
    """The members of two parts of a bucket, and how alike their signatures are."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.rows = rows.sort_values("node")
        self.signed = np.frombuffer(b"".join(self.rows["signature"]), np.uint32).reshape(len(rows), -1)
        self.node, self.group, self.part = (self.rows[c].to_numpy() for c in ("node", "group", "part"))
        self.alone = rows["lower"].iloc[0] == rows["upper"].iloc[0]

    def partners(self, i: int, doubt: float) -> tuple[np.ndarray, np.ndarray]:
        apart = np.flatnonzero((self.group != self.group[i]) & (self.alone | (self.part != self.part[i])))
        share = (self.signed[apart] == self.signed[i]).mean(axis=1)
        return apart[share >= doubt], share[share >= doubt]


def best_pairs(members: DataFrame, facts: DataFrame, doubt: float, tile: int) -> DataFrame:
    """For each member the most similar one of another group in every tile, by signature."""

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        t, out = _Tile(rows), []
        for i in range(len(t.node)):
            near, share = t.partners(i, doubt)
            if len(near):
                out.append((t.node[i], t.node[near[share.argmax()]]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    tiles = _tiles(members, facts, ["signature"], tile)
    return tiles.groupBy("bucket", "lower", "upper").applyInPandas(best, "a long, b long")


def tile_links(members: DataFrame, facts: DataFrame, least: float, doubt: float, tile: int) -> DataFrame:
    """Links between different groups of a bucket, as many as connect what is linked.

    All plausible pairs are verified, the most similar first, but for those whose
    groups a link of the tile has joined already. A pair that shares several
    buckets is looked at in the first of them only.
    """

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        t, bucket = _Tile(rows), rows["bucket"].iloc[0]
        keys = np.array(t.rows["keys"].tolist(), np.int64)
        sets = [np.frombuffer(x, np.uint32) for x in t.rows["shingles"]]
        counts = [np.frombuffer(x, np.uint32).astype(np.int64) for x in t.rows["counts"]]
        pairs: list[tuple[float, int, int]] = []
        for i in range(len(t.node)):
            near, share = t.partners(i, doubt)
            near, share = near[near > i], share[near > i]
            if len(near):
                same = keys[near] == keys[i]
                here = keys[i][same.argmax(axis=1)] == bucket
                pairs.extend(zip((-share[here]).tolist(), [i] * int(here.sum()), near[here].tolist()))
        top = {g: g for g in t.group.tolist()}

        def root(g: int) -> int:
            while top[g] != g:
                top[g] = top[top[g]]
                g = top[g]
            return g

        out = []
        for _, i, j in sorted(pairs):
            g, h = root(int(t.group[i])), root(int(t.group[j]))
            if g != h and probability_jaccard(sets[i], counts[i], sets[j], counts[j]) >= least:
                top[h] = g
                out.append((t.node[i], t.node[j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    tiles = _tiles(members, facts, ["signature", "keys", "shingles", "counts"], tile)
    return tiles.groupBy("bucket", "lower", "upper").applyInPandas(links, "a long, b long")
