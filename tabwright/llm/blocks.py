"""Texts of an Arrow batch as bytes, words and rolling fingerprints in numpy, in blocks of bounded size.

Fingerprints of ranges are polynomial hashes modulo the prime 2**61 - 1, so that the hash of any range follows from two
prefix sums (Rabin and Karp); words are told apart by their bytes. What leaves a function is mixed to spread all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import SparkSession

#: Bytes of text that are worked on at once (one longer document is a block of its own).
BLOCK_BYTES = 1 << 20
#: The same, and rows handed over at once, in steps of a chain: numpy holds some hundred bytes for each of the text, and
#: a worker that goes on to the next step keeps most of what it ever took.
LEAN_BYTES, LEAN_ROWS = 1 << 18, 1000
SIZE_MARK = 0xA0761D6478BD642F
#: The modulus of range hashes, and a base for bytes and one for sequences of words.
PRIME = (1 << 61) - 1
BYTE_BASE, WORD_BASE = 0x1E3779B97F4A7C15, 0x16E8FEB86659FD93

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit values modulo PRIME."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return x - np.uint64(PRIME) * (x >= np.uint64(PRIME))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME of reduced values, by halves of 31 bits: 2**62 counts as 2 and 2**61 as 1."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0 + a0 * b1
    top = (a1 * b1 << np.uint64(1)) + (middle >> np.uint64(30))
    return _reduced(top + ((middle & np.uint64((1 << 30) - 1)) << half) + a0 * b0)


def _prefix_sums(x: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, ... values modulo PRIME; halves are summed apart, so nothing overflows."""
    out = np.zeros(len(x) + 1, np.uint64)
    high = _reduced(np.cumsum(x >> np.uint64(32), dtype=np.uint64))
    low = _reduced(np.cumsum(x & np.uint64(0xFFFFFFFF), dtype=np.uint64))
    out[1:] = _reduced((high >> np.uint64(29)) + ((high & np.uint64((1 << 29) - 1)) << np.uint64(32)) + low)
    return out


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo PRIME, from 0 to n at least."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        out = []
        for b in (base, pow(base, PRIME - 2, PRIME)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.append(p, _product(p, np.full(1, pow(b, len(p), PRIME), np.uint64)))
            out.append(p)
        have = (out[0], out[1])
        _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hashes of any ranges of one sequence of numbers."""

    def __init__(self, values: np.ndarray, base: int):
        self.up, self.down = powers(base, len(values))
        numbers = _reduced(values.astype(np.uint64)) + np.uint64(1)
        self.sums = _prefix_sums(_product(_reduced(numbers), self.up[: len(values)]))

    def _hashes(self, low: np.ndarray, high: np.ndarray, down: np.ndarray) -> np.ndarray:
        return _product(_reduced(high + np.uint64(PRIME) - low), down)

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hash of values[start:end] for each range; ranges of different length differ."""
        raw = self._hashes(self.sums[starts], self.sums[ends], self.down[starts])
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(SIZE_MARK))

    def windows(self, size: int) -> np.ndarray:
        """The same for every range of ``size`` values."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        raw = self._hashes(self.sums[:n], self.sums[size:], self.down[:n])
        return mix(raw + np.uint64(size * SIZE_MARK % (1 << 64)))


#: Base and inverse of ``loose_windows``.
_LOOSE = 0x9E3779B97F4A7C15
_loose_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def loose_windows(values: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ranges of ``size`` values that are equal where the ranges are, and mostly differ where they differ.

    Modulo 2**64, which costs a fraction but lets regular sequences collide: for choosing ranges, never for equality.
    """
    n = len(values) + 1 - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    if len(_loose_powers[0]) <= len(values):
        for k, b in enumerate((_LOOSE, pow(_LOOSE, -1, 1 << 64))):
            p = np.full(max(len(values) + 1, 1 << 16), b, np.uint64)
            p[0] = 1
            _loose_powers[k] = np.multiply.accumulate(p)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _loose_powers[0][: len(values)], out=sums[1:])
    return mix((sums[size:] - sums[:n]) * _loose_powers[1][:n])


def content_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit ids of byte ranges: mixed from all their bytes up to 16, XXH3 of longer ones."""
    sizes = ends - starts
    padded = np.append(data, np.zeros(16, np.uint8))
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    low = eight[starts] & masks[np.minimum(sizes, 8)]
    high = eight[np.minimum(starts + 8, len(eight) - 1)] & masks[np.clip(sizes - 8, 0, 8)]
    ids = mix(mix(low + sizes.astype(np.uint64) * np.uint64(SIZE_MARK)) + mix(high ^ np.uint64(0x5851F42D4C957F2D)))
    long = np.flatnonzero(sizes > 16)
    if len(long):
        raw = data.tobytes()
        places = zip(starts[long].tolist(), ends[long].tolist(), strict=True)
        ids[long] = np.fromiter((xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in places), np.uint64, len(long))
    return ids


@dataclass
class Block:
    """Some whole documents of a batch: rows [first, last), their bytes end to end, and where each starts (and the end)."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The documents of a string column (null: empty) in blocks of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield Block(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that are run inside hand so many rows at once to Python; texts are long, and so are thousands of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    out[(out >= 65) & (out <= 90)] += 32
    return out


@dataclass
class Words:
    """Words of a block: byte ranges in the block, fingerprints, and the index of each document's first word (and the end)."""

    starts: np.ndarray
    ends: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray


#: Bytes of plain words: letters and digits, and all bytes of other scripts.
PLAIN = np.zeros(256, bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(block: Block, data: np.ndarray | None = None, plain: bool = False) -> Words:
    """Runs of bytes that are neither a space nor 9 to 13 (``plain``: of PLAIN bytes); a word never crosses documents."""
    data = block.data if data is None else data
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(block.bounds), np.int64))
    solid = PLAIN[data] if plain else (data != 32) & ((data < 9) | (data > 13))
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    heads = block.bounds[:-1]
    heads = heads[heads < n]
    begin[heads] = solid[heads]
    stop = np.zeros(n + 1, bool)
    stop[1:] = solid
    stop[1:n] &= ~solid[1:] | begin[1:]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop)
    return Words(starts, ends, content_ids(data, starts, ends), np.searchsorted(starts, block.bounds))


def of_doc(bounds: np.ndarray) -> np.ndarray:
    """For each element of the block, the row of its document within the block."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of values[i : i + width] for each i."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    best, reach = values, 1
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    return np.minimum(best[:n], best[width - reach : width - reach + n])
