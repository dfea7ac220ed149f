"""Packing token sequences by minimum bin slack.

Every task packs the documents of its own partition as they stream by, so
packing needs no shuffle and no global order. Full windows leave at once; what
remains of a document waits in a pool of bounded size. When the pool is full,
a subset-sum program over the waiting lengths fills window after window.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW = 1024
POOL = 16_384
#: Pieces that leave a task at once, 4 MB of ids at the usual window.
PIECES = 1024
SEQUENCE_BITS = 36
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The one added token of the ``tokenizers`` file, which the rank file does not hold.
ADDED, ADDED_ID = "<|endoftext|>", 50256
#: White-space runs from this length on are cut out before the pattern sees them, whose
#: look-ahead keeps a stack as long as the run. The class is the pattern's own white space.
LONG_RUN = 10_000
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@cache
def byte_pair_encoder(vocabulary: str = VOCABULARY, added: bool = False) -> Callable[[str], list[int]]:
    """Token ids of the public byte-level vocabulary.

    With ``added``, the added token in a text has its own id, as ``tokenizers``
    gives by default; else it is plain text.

    The rank file is the same vocabulary as the ``tokenizers`` file of that
    name and gives the same ids several times faster; a test holds them equal.
    ``vocabulary`` is a public file name or a path.

    A text may hold white-space runs of any length. The pattern takes a run as
    one piece, without its last character if something else follows: a long run
    is cut at these two places, and its piece goes to the merges directly.
    """
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    long_run = re.compile(f"{WHITE}(?<!{WHITE}{WHITE}){WHITE}{{{LONG_RUN - 1},}}")

    def plain(text: str) -> list[int]:
        if len(text) < LONG_RUN:
            return coder.encode_ordinary(text)
        ids, at = [], 0
        for run in long_run.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += coder.encode_ordinary(text[at : run.start()])
            ids += coder._encode_single_piece(text[run.start() : end])
            at = end
        return ids + coder.encode_ordinary(text[at:])

    def encode(text: str) -> list[int]:
        if ADDED not in text:
            return plain(text)
        first, *rest = text.split(ADDED)
        ids = plain(first)
        for part in rest:
            ids.append(ADDED_ID)
            ids += plain(part)
        return ids

    return encode if added else plain


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths whose sum comes closest to ``room`` from below.

    Bit s of ``reach`` says that a sum s can be formed. Long lengths come first,
    each in blocks of 1, 2, 4, ... copies; every step keeps the bits before it,
    from which the counts are read back.
    """
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, block = min(counts[length], room // length), 1
        while left and not reach >> room:
            copies = min(block, left)
            steps.append((length, copies, reach))
            reach |= (reach << (length * copies)) & mask
            left, block = left - copies, block * 2
        if reach >> room:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for length, copies, before in reversed(steps):
        if not before >> total & 1:
            used[length] += copies
            total -= length * copies
    return dict(used)


class Packer:
    """Pieces waiting by length, and the windows made of them."""

    def __init__(self, window: int, first_sequence: int) -> None:
        self.window, self.sequence = window, first_sequence
        self.waiting: dict[int, list[tuple]] = defaultdict(list)
        self.size = 0

    def add(self, key, start: int, ids: bytes, total: int) -> None:
        self.waiting[len(ids) // 4].append((key, start, ids, total))
        self.size += 1

    def take(self, length: int) -> tuple:
        found = self.waiting[length].pop()
        if not self.waiting[length]:
            del self.waiting[length]
        self.size -= 1
        return found

    def place(self, piece: tuple, offset: int) -> tuple:
        key, start, ids, total = piece
        return key, start, len(ids) // 4, ids, total, self.sequence, offset

    def drain(self, until: int) -> Iterator[tuple]:
        """Fill windows until at most ``until`` pieces wait.

        Each window starts with the longest piece and takes the multiset that
        fills the rest best. What is still open is closed with the head of one
        more piece, whose tail waits on; only the very last window stays short.
        The same multiset is used as often as the waiting counts allow.
        """
        while self.size > until:
            counts = {length: len(pieces) for length, pieces in self.waiting.items()}
            seed = max(counts)
            counts[seed] -= 1
            chosen = fullest({k: v for k, v in counts.items() if v}, self.window - seed)
            counts[seed] += 1
            chosen[seed] = chosen.get(seed, 0) + 1
            slack = self.window - sum(k * v for k, v in chosen.items())
            times = min(counts[k] // v for k, v in chosen.items())
            for _ in range(1 if slack else times):
                offset = 0
                for length in sorted(chosen, reverse=True):
                    for _ in range(chosen[length]):
                        yield self.place(self.take(length), offset)
                        offset += length
                if slack and self.waiting:
                    key, start, ids, total = self.take(max(self.waiting))
                    yield self.place((key, start, ids[: slack * 4], total), offset)
                    self.add(key, start + slack, ids[slack * 4 :], total)
                self.sequence += 1
                if self.size <= until:
                    return


def pack_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = 0,
    vocabulary: str = VOCABULARY,
    pool: int = POOL,
    added: bool = False,
) -> DataFrame:
    """Pieces of documents packed into sequences of at most ``window`` tokens.

    One row per piece: the key, ``start`` (its document's ids before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens`` (with
    the end id), ``sequence_id`` and ``offset`` in that sequence. A document is
    its token ids and ``end_id``; every id lies in exactly one piece. ``added``
    is that of the encoder.

    Every full window of a document is a sequence. Rests are packed by minimum
    bin slack; the pool of ``pool`` pieces bounds the memory of a task, not the
    input. At most one sequence per partition stays short of the window.

    Defined cases: white-space runs may have any length; a null text counts as empty and is the end id alone; null
    and repeated keys pass through, each row is a document of its own; other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        *[T.StructField(n, T.LongType()) for n in ("start", "length")],
        T.StructField("ids", T.BinaryType()),
        *[T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset")],
    ]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode = byte_pair_encoder(vocabulary, added)
        packer = Packer(window, TaskContext.get().partitionId() << SEQUENCE_BITS)
        end = np.array([end_id], "<u4").tobytes()
        for part in batches:
            for k, words in zip(part.column(0).to_pylist(), part.column(1)):
                ids = np.array(encode(words.as_py() or ""), "<u4").tobytes() + end
                total = len(ids) // 4
                full = total - total % window
                for start in range(0, full, window):
                    yield packer.place((k, start, ids[start * 4 : (start + window) * 4], total), 0)
                    packer.sequence += 1
                if full < total:
                    packer.add(k, full, ids[full * 4 :], total)
                if packer.size >= pool:
                    yield from packer.drain(pool // 2)
        yield from packer.drain(0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first in batches:
            kinds = [first.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
            found = pieces(chain([first], batches))
            while rows := list(islice(found, PIECES)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.name for f in fields]
                )

    return docs.select(key, text).mapInArrow(pack, T.StructType(fields))
