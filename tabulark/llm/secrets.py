"""Secrets in texts: patterns, and a randomness test battery for tokens without one.

All work is expressions of the JVM: patterns, positions, test statistics and
their tails. The driver sees one histogram of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.functions.normal import LOWER, SWITCH, UPPER, density
from tabulark.llm.common import text_of
from tabulark.session import pin


@dataclass(frozen=True)
class Pattern:
    kind: str
    regex: str
    #: A match counts only if this group of it has so many characters.
    group: int
    least: int


#: Fixed forms. Matches are leftmost and do not overlap within a kind. The last
#: two are written with their least length, which finds the same spans: a run is
#: maximal, so a shorter one holds no longer one.
PATTERNS = (
    Pattern("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Pattern("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Pattern("hex", r"[0-9a-f]{24,}", 0, 24),
)
RANDOM = "random"


@dataclass(frozen=True)
class Encoding:
    """An alphabet and the character classes without which a token is taken for a word or a number."""

    name: str
    alphabet: str
    regex: str


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: The first that fits is inferred.
ENCODINGS = (
    Encoding("hex", _DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    Encoding("HEX", _DIGITS + "ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    Encoding("base32", _UPPER + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$"),
    Encoding("base36", _DIGITS + _LOWER, r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$"),
    Encoding("BASE36", _DIGITS + _UPPER, r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$"),
    Encoding("base64url", _UPPER + _LOWER + _DIGITS + "-_", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_-]+=*$"),
    Encoding("base64", _UPPER + _LOWER + _DIGITS + "+/", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/]+=*$"),
)
#: Candidates are the maximal runs of each of these; ``=`` belongs to one only as padding behind it.
TOKENS = (r"[A-Za-z0-9+/]{20,}={0,2}", r"[A-Za-z0-9_-]{20,}={0,2}", r"[A-Za-z0-9]{20,}={0,2}")
#: What a text must hold for any match of a token or of a pattern without a group, and for one of the pattern with a group.
RUN = r"[A-Za-z0-9+/_-]{20}"
MARKS = (":", "=")
#: Lower ends of the length bands that are controlled one by one.
BANDS = (20, 28, 40, 64, 128)
BINS = 200
SURE = 0.5
LEAST_P = 1e-12


def named(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def running_totals(sizes: Column) -> Column:
    """Sum of all earlier sizes for each element, by blocks: no step copies the whole array.

    Sizes and block sums are named: inside a lambda they would be worked out again for every element.
    """
    zero = F.lit(0).cast("long")

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, x: a + x)

    def of(v: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int"))
        starts = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), width)

        def spread(blocks: Column) -> Column:
            return F.flatten(
                F.transform(
                    F.transform(starts, lambda s, k: F.struct(s.alias("s"), total(F.slice(blocks, 1, k)).alias("base"))),
                    lambda b: named(
                        F.slice(v, b["s"] + 1, width), lambda own: F.transform(own, lambda _, k: b["base"] + total(F.slice(own, 1, k)))
                    ),
                )
            )

        return named(F.transform(starts, lambda s: total(F.slice(v, s + 1, width))), spread)

    return named(sizes, of)


def matches(text: Column, regex: str, group: int = 0) -> Column:
    """(start, end, part) of every leftmost non-overlapping match, in code points; ``part`` is the group.

    The text between matches comes from a split at the same pattern. A text is
    searched once if nothing matches and once for each of the three lists
    otherwise, however many matches it holds.
    """
    kind = "array<struct<start:bigint,end:bigint,part:string>>"

    def placed(whole: Column) -> Column:
        part = F.regexp_extract_all(text, F.lit(regex), F.lit(group)) if group else whole
        gaps = F.transform(F.split(text, regex, -1), lambda g: F.length(g).cast("long"))

        def spans(gaps: Column) -> Column:
            steps = F.zip_with(gaps, whole, lambda g, m: g + F.coalesce(F.length(m), F.lit(0)))
            return F.zip_with(
                F.arrays_zip(running_totals(steps).alias("b"), F.slice(gaps, 1, F.size(whole)).alias("g"), whole.alias("m")),
                part,
                lambda x, p: F.struct(
                    (x["b"] + x["g"]).alias("start"), (x["b"] + x["g"] + F.length(x["m"])).alias("end"), p.alias("part")
                ),
            )

        found = F.filter(named(gaps, spans), lambda x: x["part"].isNotNull())
        return F.when(F.size(whole) > 0, found).otherwise(F.array()).cast(kind)

    return named(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), placed)


def searched(text: Column) -> tuple[Column, Column]:
    """``text`` where a run of :data:`RUN` stands, and where a pattern with a group matches; empty elsewhere.

    One search tells that most texts hold neither, which spares them the many scans of :func:`matches`.
    """
    marked = reduce(lambda a, b: a | b, [F.contains(text, F.lit(m)) for m in MARKS])
    named_value = reduce(lambda a, b: a | b, [text.rlike(p.regex) for p in PATTERNS if p.group])
    return F.when(text.rlike(RUN), text).otherwise(""), F.when(marked & named_value, text).otherwise("")


def base_spans(text: Column, assigned: Column | None = None) -> Column:
    """(start, order, end, kind) of all pattern matches, sorted; those with a group are looked for in ``assigned``."""
    def of(order: int, pattern: Pattern) -> Column:
        where = text if assigned is None or not pattern.group else assigned
        long_enough = F.filter(matches(where, pattern.regex, pattern.group), lambda m: F.length(m["part"]) >= pattern.least)
        return F.transform(
            long_enough,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(pattern.kind).alias("kind")
            ),
        )

    return F.array_sort(F.concat(*[of(i, p) for i, p in enumerate(PATTERNS)]))


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def upper_tail(x: Column) -> Column:
    """1 - distribution of the standard normal, by the same published ratio as in ``functions.normal``."""

    def far(size: Column) -> Column:
        fraction = size + 0.65
        for i in (4.0, 3.0, 2.0, 1.0):
            fraction = size + F.lit(i) / fraction
        ratio = _polynomial(size, UPPER) / _polynomial(size, LOWER)
        return F.when(size < SWITCH, F.exp(-(size * size) / 2.0) * ratio).otherwise(density(size) / fraction)

    return named(x, lambda v: named(far(F.abs(v)), lambda t: F.when(v > 0, t).otherwise(F.lit(1.0) - t)))


def _two_sided(z: Column) -> Column:
    return F.lit(2.0) * upper_tail(F.abs(z))


def _floor(p: Column) -> Column:
    return F.greatest(F.least(p, F.lit(1.0)), F.lit(LEAST_P))


def uniformity(values: Column, size: Column) -> Column:
    """Tail of chi-squared against equal use of the alphabet, by the cube-root normal form."""
    n, k = F.size(values).cast("double"), size.cast("double")
    squares = F.aggregate(
        F.transform(F.sequence(F.lit(0), size - 1), lambda c: F.size(F.filter(values, lambda v: v == c)).cast("double")),
        F.lit(0.0),
        lambda a, x: a + x * x,
    )
    chi, free = squares * k / n - n, k - 1
    spread = F.lit(2.0) / (F.lit(9.0) * free)
    return upper_tail((F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def runs(values: Column, size: Column) -> Column:
    """Two-sided tail of the number of runs of the upper and the lower half of the alphabet."""

    def of(bits: Column) -> Column:
        n = F.size(bits).cast("double")
        high = F.aggregate(bits, F.lit(0), lambda a, b: a + b).cast("double")
        changes = F.zip_with(
            F.slice(bits, 1, F.size(bits) - 1), F.slice(bits, 2, F.size(bits) - 1), lambda a, b: (a != b).cast("int")
        )
        count = F.aggregate(changes, F.lit(1), lambda a, b: a + b).cast("double")

        def judge(mean: Column) -> Column:
            variance = (mean - 1) * (mean - 2) / (n - 1)
            return F.when(variance > 0, _two_sided((count - mean) / F.sqrt(variance))).otherwise(F.lit(0.0))

        return named(named(high, lambda h: 2 * h * (n - h) / n + 1), judge)

    return named(F.transform(values, lambda v: (v * 2 >= size).cast("int")), of)


def serial_correlation(values: Column) -> Column:
    """Two-sided tail of the correlation between neighbouring symbols."""
    n = F.size(values).cast("double")

    def of(off: Column) -> Column:
        products = F.zip_with(F.slice(off, 1, F.size(off) - 1), F.slice(off, 2, F.size(off) - 1), lambda a, b: a * b)
        r = F.aggregate(products, F.lit(0.0), lambda a, x: a + x)
        total = F.aggregate(off, F.lit(0.0), lambda a, x: a + x * x)
        return named(
            total,
            lambda t: F.when(t > 0, _two_sided((r / t + 1 / (n - 1)) * F.sqrt(n - 1))).otherwise(F.lit(0.0)),
        )

    mean = F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v).cast("double") / n
    return named(named(mean, lambda m: F.transform(values, lambda v: v.cast("double") - m)), of)


def battery(token: Column) -> Column:
    """(encoding, p): Fisher's combination of the three tests under the inferred encoding; null if none fits."""
    fits = F.coalesce(*[F.when(token.rlike(e.regex), F.struct(F.lit(e.name).alias("name"), F.lit(e.alphabet).alias("alphabet"))) for e in ENCODINGS])

    def judge(e: Column) -> Column:
        size = F.length(e["alphabet"])
        values = F.transform(
            F.filter(F.split(F.rtrim(token, F.lit("=")), "", -1), lambda c: c != ""),
            lambda c: F.call_function("instr", e["alphabet"], c).cast("long") - 1,
        )

        def half(v: Column) -> Column:
            return -sum((F.log(_floor(p)) for p in (uniformity(v, size), runs(v, size), serial_correlation(v))), F.lit(0.0))

        # Tail of chi-squared with six degrees of freedom at 2 * half.
        p = named(named(values, half), lambda h: F.exp(-h) * (1 + h + h * h / 2))
        return F.when(e.isNotNull(), F.struct(e["name"].alias("encoding"), p.alias("p")))

    return named(fits, judge)


def band(length: Column) -> Column:
    return F.coalesce(*[F.when(length >= b, F.lit(b)) for b in reversed(BANDS)], F.lit(0))


def cuts(histogram: list, share: float) -> dict[str, float]:
    """Per stratum the least p at which a token is called random.

    Random tokens have uniform p, so twice the tokens above one half estimates
    how many are random in all. Of the tokens at or above a cut, those beyond
    the random ones expected there are false discoveries; the cut is the lowest
    that keeps their share at or below ``share``.
    """
    strata: dict[str, list[int]] = {}
    for row in histogram:
        strata.setdefault(row["stratum"], [0] * BINS)[row["bin"]] += row["n"]
    found = {}
    for name, bins in strata.items():
        random = sum(bins[int(BINS * SURE) :]) / (1 - SURE)
        above, best = sum(bins), SURE
        for i in range(int(BINS * SURE)):
            if above and 1 - random * (1 - i / BINS) / above <= share:
                best = i / BINS
                break
            above -= bins[i]
        found[name] = best
    return found


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", share: float = 0.1) -> DataFrame:
    """The key and ``spans``: (start, order, end, kind) of every secret, sorted, one row per document.

    Pattern matches always stay. A candidate that overlaps none of them is
    tested; candidates are the maximal runs of at least 20 characters of each
    of three alphabets, so that the value in NAME=value and the parts of a path
    are candidates of their own. Of random candidates inside each other the
    longest counts. The encoding is inferred from the
    characters, three tests judge uniformity of the alphabet, runs and serial
    correlation, and their combined p is held against the cut of its stratum,
    encoding by length band, so short tokens, for which the tests say little,
    and long ones are controlled apart. Texts without a run of 20 characters
    and without an assignment are told apart first (:func:`searched`); they
    have no span.

    Offsets are code points, ends exclusive. Only spans and p values are kept
    between the two passes; texts are scanned once and never shuffled.

    Defined cases: a null text counts as empty and has no span; null and
    repeated keys pass through, row by row; other columns are ignored; with no
    token in a stratum there is nothing to cut; an empty table gives no rows.
    """
    runs_in, assigned_in = searched(text_of(text))
    # Two columns of a projection of their own: each is used several times and worked out once.
    found = docs.select(F.col(key).alias(key), runs_in.alias("_runs"), assigned_in.alias("_assigned"))
    tokens = F.array_distinct(F.concat(*[matches(F.col("_runs"), t) for t in TOKENS]))
    rows = found.select(key, base_spans(F.col("_runs"), F.col("_assigned")).alias("_base"), tokens.alias("_tokens"))

    def clear(token: Column) -> Column:
        return ~F.exists("_base", lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"]))

    def judged(token: Column) -> Column:
        def placed(verdict: Column) -> Column:
            stratum = F.concat_ws(":", verdict["encoding"], band(F.length(token["part"])))
            return F.struct(
                token["start"].alias("start"), token["end"].alias("end"), stratum.alias("stratum"), verdict["p"].alias("p")
            )

        return named(battery(token["part"]), placed)

    tested = pin(
        rows.select(
            key,
            "_base",
            F.filter(F.transform(F.filter("_tokens", clear), judged), lambda t: t["p"].isNotNull()).alias("_tested"),
        )
    )
    bins = F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int")
    histogram = (
        tested.select(F.explode("_tested").alias("t"))
        .groupBy(F.col("t.stratum").alias("stratum"), bins.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    limits = cuts(histogram, share)
    if limits:
        cut = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])
        taken = F.filter("_tested", lambda t: t["p"] >= F.element_at(cut, t["stratum"]))
    else:
        taken = F.col("_tested")
    # What lies inside another one is not told twice.
    outer = named(
        taken,
        lambda those: F.filter(
            those,
            lambda t: ~F.exists(
                those,
                lambda o: (o["start"] <= t["start"]) & (t["end"] <= o["end"]) & (o["end"] - o["start"] > t["end"] - t["start"]),
            ),
        ),
    )
    added = F.transform(
        outer,
        lambda t: F.struct(t["start"].alias("start"), F.lit(len(PATTERNS)).alias("order"), t["end"].alias("end"), F.lit(RANDOM).alias("kind")),
    )
    return tested.select(key, F.array_sort(F.concat("_base", added)).alias("spans"))


def described(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
