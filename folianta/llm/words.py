"""Words and word hashes of whole Arrow batches, without a Python loop per word.

Words are maximal runs of digits, letters a-z (A-Z lowered) and anything outside ASCII, which
is the pattern ``WORD`` read byte by byte: every byte of a character outside ASCII is a word
byte. All helpers work inside a Spark task on one batch; a document is never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 1 << 17
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
UNCHANGED = np.arange(256, dtype=np.uint8)
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[9:14] = NOT_SPACE[32] = False


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, so that any of their bits may be used (a bijection)."""
    x = values.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U64) * _U64(_BASE))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for the first ``count`` exponents, kept for the worker."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        size = max(count, BLOCK_BYTES + 1)
        steps = np.full(size, base, dtype=_U64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:count]


@dataclass
class Words:
    """Words of a block of texts: byte bounds, hash and, per text, where its words begin."""

    data: np.ndarray  # bytes of all texts, lowered
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # len(texts) + 1 entries; words of text i are first[i] : first[i + 1]

    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space behind each, and the byte at which every word begins there."""
        sizes = self.ends - self.starts + 1
        begins = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts - begins, sizes)
        packed = self.data[np.minimum(at, len(self.data) - 1)] if len(at) else self.data[:0]
        packed[begins + sizes - 1] = 32
        return packed, begins

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words ``begin`` to ``end``, for many spans at once."""
        sums = np.zeros(len(self.hashes) + 1, dtype=_U64)
        np.cumsum(self.hashes * powers(_BASE, len(self.hashes)), out=sums[1:])
        return mix((sums[end] - sums[begin]) * powers(_INVERSE, len(sums))[begin])

    def text(self, begin: int, end: int) -> str:
        """Words ``begin`` to ``end`` joined by single spaces."""
        return b" ".join(
            self.data[a:b].tobytes() for a, b in zip(self.starts[begin:end], self.ends[begin:end])
        ).decode("utf-8", "replace")


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of each; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def split_words(texts: pa.Array, is_word: np.ndarray = IS_WORD, letters: np.ndarray = LOWERED) -> Words:
    """All words of ``texts``; equal words have equal hashes in every batch and task.

    ``letters`` maps every byte first, ``is_word`` tells which of the results belong to words.
    """
    raw, offsets = utf8(texts)
    size = len(raw)
    data = letters[raw]
    inside = is_word[data]
    opens, closes = inside.copy(), inside.copy()
    if size:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < size)]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.zeros(size + 1, dtype=_U64)
    np.cumsum(_BYTE_VALUES[data] * powers(_BASE, size), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * powers(_INVERSE, size)[starts])
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def bound_batches(spark: SparkSession) -> None:
    """Let the session send at most BATCH_ROWS rows or about BATCH_BYTES to Python at once.

    Texts are long rows: Spark's 10,000 of them would fill hundreds of megabytes in each task.
    Smaller settings are left alone.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(re.sub(r"[^-0-9]", "", spark.conf.get(key)))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``size`` text bytes; a longer text gets its own slice."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        totals = np.cumsum(lengths.to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            before = totals[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(totals, before + size, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
    pa.default_memory_pool().release_unused()  # the worker lives on


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, at its first word; shorter tails are left out."""
    count = max(0, len(hashes) - width + 1)
    total = np.zeros(count, dtype=_U64)
    for i, factor in enumerate(powers(_BASE, width)):
        total += hashes[i : i + count] * factor
    return mix(total + _U64(width))
