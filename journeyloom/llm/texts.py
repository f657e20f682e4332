"""Shared text helpers: words of Arrow text columns as hash arrays, bounded slices, table columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SLICE_BYTES = 1 << 20
#: Words longer than this are hashed by blake2b, shorter ones by a random polynomial.
LONG_WORD = 64
_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def crc_remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus`` (NULL keys count as the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that extra columns never clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (the finaliser of a common public hash)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _bytes_table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """prime**i and prime**-i modulo 2**64 for i < n; kept for ordinary slices only."""
    if n <= SLICE_BYTES:
        n = SLICE_BYTES
        if n in _POWERS:
            return _POWERS[n]
    found = tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, p, np.uint64)))) for p in (_PRIME, _INVERSE))
    if n == SLICE_BYTES:
        _POWERS[n] = found
    return found


class Words:
    """Words of consecutive documents: hashes, byte spans in ``data``, and each document's first word."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, table: np.ndarray):
        self.data, self.starts, self.ends, self.first = data, starts, ends, first
        self._table = table

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, length: int | None = None) -> np.ndarray:
        """Hash of every word, or of its first ``length`` bytes."""
        ends = self.ends if length is None else np.minimum(self.ends, self.starts + length)
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        if not hasattr(self, "_sums"):
            powers, self._inverse = _powers(len(self.data))
            sums = np.empty(len(self.data) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(self._table[self.data] * powers[: len(self.data)], out=sums[1:])
            self._sums = sums
        raw = (self._sums[ends] - self._sums[self.starts]) * self._inverse[self.starts]
        found = mix(raw + (ends - self.starts).astype(np.uint64))
        for i in np.flatnonzero(ends - self.starts > LONG_WORD):
            found[i] = int.from_bytes(hashlib.blake2b(self.data[self.starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
        return found


def lower_table() -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def white_table() -> np.ndarray:
    return np.isin(np.arange(256), list(SPACES))


def symbol_table() -> np.ndarray:
    """White space, controls and ASCII punctuation: what separates tokens of letters and digits."""
    return np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; NULL counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def word_slices(column: pa.Array, separators: np.ndarray | None = None, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over slices of whole rows of about SLICE_BYTES."""
    separators = white_table() if separators is None else separators
    fold = lower_table() if lower else None
    raw, offsets = column_bytes(column)
    table = _bytes_table()
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        stop = min(stop, rows)
        data = raw[offsets[row] : offsets[stop]]
        if fold is not None:
            data = fold[data]
        bounds = offsets[row : stop + 1] - offsets[row]
        yield row, stop, split_words(data, bounds, separators, table)
        row = stop


def split_words(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray, table: np.ndarray | None = None) -> Words:
    """Words of the rows ``bounds`` of ``data``: runs of bytes that are no separators."""
    inside = ~separators[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        before[edges] = False
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds), _bytes_table() if table is None else table)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive values (row borders are the caller's business)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for i in range(length):
        found = found * _PRIME + words[i : i + n]
    return mix(found)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
