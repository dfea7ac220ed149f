"""Language identification with bit-sliced Bloom filters over character n-grams.

One slot per hash position holds a bitmask of languages, so a single look-up
answers for all languages at once: the masks of an n-gram's slots are combined
with AND, and the result names every language whose filter contains it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulark.operators.joins import bounded_rows
from tabulark.session import pin

NONE = "und"
SIZES = (2, 3, 4)
SLOTS = 1 << 20
HASHES = 2
SAMPLE = 1_000
MOST_LANGUAGES = 63
#: Characters that are hashed at once; the arrays made of them take some 80 bytes a character.
CHUNK = 1 << 17


@dataclass(frozen=True)
class Filters:
    """Bit-sliced filters: bit l of ``slots[i]`` belongs to ``languages[l]``."""

    languages: tuple[str, ...]
    slots: np.ndarray
    sizes: tuple[int, ...]
    hashes: int

    @property
    def false_positives(self) -> np.ndarray:
        """Chance per language that an n-gram outside its filter passes."""
        bits = [float((self.slots >> np.uint64(i) & np.uint64(1)).mean()) for i in range(len(self.languages))]
        return np.array(bits) ** self.hashes


@cache
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def bare_words(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters with one blank (0) between words; ``owner`` numbers the text of each code point."""
    is_letter = letters()[points]
    first = np.empty(len(points), bool)
    if len(points):
        first[0] = True
        first[1:] = owner[1:] != owner[:-1]
    before = np.empty(len(points), bool)
    before[:1] = False
    before[1:] = is_letter[:-1]
    keep = is_letter | before | first
    kept = np.where(is_letter, points, 0)[keep]
    return kept, owner[keep]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, on arrays."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def ngram_hashes(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of one text each, without those that hold a blank inside."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, owner.dtype)
    value = np.full(n, size, np.uint64)
    inner = np.ones(n, bool)
    wide = words.astype(np.uint64) + np.uint64(1)
    for i in range(size):
        part = words[i : i + n]
        value *= np.uint64(0xD1342543DE82EF95)
        value += wide[i : i + n]
        if 0 < i < size - 1 or size == 2:
            inner &= part != 0
    ok = inner & (owner[:n] == owner[size - 1 : size - 1 + n])
    return mixed(value[ok]), owner[:n][ok]


def places(hashes: np.ndarray, slots: int, count: int) -> list[np.ndarray]:
    """``count`` slots per hash, from its two halves; ``slots`` is a power of two."""
    low, step, mask = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32), np.uint32(slots - 1)
    return [(low + np.uint32(i) * step) & mask for i in range(count)]


def batches_of_text(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row count, code points, row of each) for runs of rows of bounded length."""
    parts, rows, size, first = [], [], 0, 0
    for i, text in enumerate(column):
        points = code_points((text.as_py() or "").lower())
        parts.append(points)
        rows.append(len(points))
        size += len(points)
        if size >= CHUNK:
            yield first, len(rows), np.concatenate(parts), np.repeat(np.arange(len(rows), dtype=np.int32), rows)
            parts, rows, size, first = [], [], 0, i + 1
    if rows:
        yield first, len(rows), np.concatenate(parts), np.repeat(np.arange(len(rows), dtype=np.int32), rows)


def counted_ngrams(sizes: tuple[int, ...]):
    """Task function: (lang, text) rows to the documents per (lang, n-gram) of the task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                texts = batch.column(1).filter(pc.equal(batch.column(0), lang))
                for _, _, points, owner in batches_of_text(texts):
                    words, of = bare_words(points, owner)
                    for size in sizes:
                        grams, doc = ngram_hashes(words, of, size)
                        pair = mixed(grams ^ mixed(doc.astype(np.uint64) + np.uint64(1)))
                        gram, n = np.unique(grams[np.unique(pair, return_index=True)[1]], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(gram)), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))],
                            names=["lang", "gram", "n"],
                        )

    return count


def fit_filters(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    sizes: tuple[int, ...] = SIZES,
    slots: int = SLOTS,
    hashes: int = HASHES,
    least_share: float = 0.002,
    contrast: float = 0.3,
) -> Filters:
    """Filters learned from about ``sample`` labelled documents per language.

    The sample is every document whose hash falls below sample / documents of
    its language; it is the only bound, and all else covers whole texts. An
    n-gram enters the filter of a language where it is found in at least
    ``least_share`` of the sampled documents and in ``contrast`` times the share
    it has in the language that uses it most.

    Rows with a null text or language teach nothing. More than
    ``MOST_LANGUAGES`` languages are an error. Without any labelled row the
    filters know no language.
    """
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    totals = {r["_l"]: r["_n"] for r in bounded_rows(known.groupBy(F.col(lang).alias("_l")).agg(F.count(F.lit(1)).alias("_n")), MOST_LANGUAGES, "languages")}
    languages = tuple(sorted(totals))
    if not languages:
        return Filters((), np.zeros(slots, np.uint64), sizes, hashes)
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key), F.col(text)), F.lit(1_000_000)) / F.lit(1e6)
    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in totals.items() for x in (k, min(1.0, sample / v))]), F.col(lang))
    chosen = pin(known.where(draw < rate).select(F.col(lang).alias("lang"), F.col(text).alias("text")))
    sampled = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = (
        chosen.mapInArrow(counted_ngrams(sizes), "lang string, gram long, n long")
        .groupBy("gram")
        .pivot("lang", list(languages))
        .agg(F.sum("n"))
    )
    shares = [F.coalesce(F.col(f"`{x}`"), F.lit(0)) / F.lit(max(sampled.get(x, 0), 1)) for x in languages]
    most = F.greatest(*shares) if len(shares) > 1 else shares[0]
    mask = F.lit(0).cast("long")
    for i, s in enumerate(shares):
        inside = (s >= least_share) & (s >= F.lit(contrast) * most)
        mask = mask.bitwiseOR(F.when(inside, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    # Slots are merged by the aggregate: at most ``slots`` rows reach the driver.
    marked = counts.select("gram", mask.alias("mask")).where(F.col("mask") != 0)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gram, bits = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
            for p in places(gram, slots, hashes):
                yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64)), pa.array(bits)], names=["slot", "mask"])

    merged = marked.mapInArrow(spread, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(slots, np.uint64)
    table[merged.column("slot").to_numpy()] = merged.column("mask").to_numpy().view(np.uint64)
    return Filters(languages, table, sizes, hashes)


def scores(column: pa.Array, filters: Filters) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(first row, languages, scores) for runs of rows of bounded length that cover ``column`` in order."""
    n = len(filters.languages)
    wrong = np.minimum(filters.false_positives, 0.999) if n else np.zeros(0)
    for first, rows, points, owner in batches_of_text(column):
        named: list[str] = []
        found = np.zeros(rows)
        words, of = bare_words(points, owner)
        written = np.bincount(owner[letters()[points]], minlength=rows) > 0
        hits, grams = np.zeros((n, rows)), np.zeros(rows)
        for size in filters.sizes:
            value, doc = ngram_hashes(words, of, size)
            first_slot, *others = places(value, len(filters.slots), filters.hashes)
            mask = filters.slots[first_slot]
            for p in others:
                mask &= filters.slots[p]
            grams += np.bincount(doc, minlength=rows)
            for i in range(n):
                hits[i] += np.bincount(doc[(mask >> np.uint64(i) & np.uint64(1)).astype(bool)], minlength=rows)
        for r in range(rows):
            if not n or not written[r]:
                named.append(NONE)
                continue
            # Expected hits = true + wrong * (grams - true), solved for the true ones.
            true = np.clip((hits[:, r] - wrong * grams[r]) / (1 - wrong), 0, grams[r])
            best = int(true.argmax())
            named.append(filters.languages[best])
            found[r] = true[best] / grams[r] if grams[r] else 0.0
        yield first, named, found


def named_rows(batch: pa.RecordBatch, judged: int, width: int, filters: Filters) -> Iterator[pa.RecordBatch]:
    """The first ``width`` columns plus language and score of column ``judged``.

    The rows leave in runs of bounded length, as slices of ``batch``: no copy of its texts is made.
    """
    names = [*batch.schema.names[:width], "lang_pred", "score"]
    for first, named, found in scores(batch.column(judged), filters):
        columns = batch.slice(first, len(named)).columns[:width]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(named, pa.string()), pa.array(found)], names=names)


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``.

    The score is the share of the text's n-grams that the filter of the named
    language holds, corrected for its false positives. Ties go to the language
    that sorts first. The filters are broadcast; their size is fixed by ``slots``.
    A text goes to the Python worker once, in the column that also comes back.

    Defined cases: a text that is null or holds no letter is ``und`` with score
    0, as is every text when no language was learned; a text without a known
    n-gram gets the first language with score 0; input columns of the two
    names are replaced, all others pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType(
        [*[docs.schema[c] for c in kept], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    inside = text in kept
    judged, width = kept.index(text) if inside else len(kept), len(kept)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from named_rows(batch, judged, width, shared.value)

    return docs.select(*kept, *([] if inside else [F.col(text).alias("_judged")])).mapInArrow(name, schema)


def held_out(key: str) -> Column:
    """Whether a document is kept out of learning: crc32 of its key as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
