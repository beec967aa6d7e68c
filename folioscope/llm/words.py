"""Words of Arrow text columns as NumPy arrays of 64-bit hashes.

A word is a run of bytes other than blank and tab to carriage return. Hashes are polynomial
sums over random byte values, so equal words have equal hashes in every task. All work is
vectorised over blocks of whole rows; a block's size is bounded unless one row exceeds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Letters and digits only; every byte of a character beyond ASCII counts as a letter.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_rng = np.random.Generator(np.random.PCG64(20240229))
_RAW = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _RAW.copy()
_LOWER[65:91] = _RAW[97:123]
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        table = np.full(max(n, 2 * BLOCK_BYTES), base)
        table[0] = 1
        _powers[key] = np.multiply.accumulate(table)
    return _powers[key][:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair, independent of where the run stands."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=sums[1:])
    inverse = powers(len(values) + 1, _INVERSE)
    found = (sums[ends] - sums[starts]) * inverse[starts]
    found += (ends - starts).astype(np.uint64)
    return mix(found)


def text_blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, bytes and row offsets of blocks of whole rows; null counts as empty."""
    array = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    n = len(array)
    if not n:
        return
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + n + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """``row``: row of each word; ``first``: number of words before each row, and the total."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True, alphabet: np.ndarray = ~_SPACE) -> Words:
    """Runs of bytes of ``alphabet`` within each row, by default whatever isn't white space."""
    n = len(data)
    solid = alphabet[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    gap = np.ones(n + 1, bool)
    np.logical_not(solid, out=gap[:n])
    before = np.empty(n, bool)
    before[:1] = True
    before[1:] = gap[: n - 1]
    starts = np.flatnonzero(solid & (before | edge[:n]))
    ends = np.flatnonzero(solid & (gap[1:] | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hashes = run_hashes((_LOWER if lower else _RAW)[data], starts, ends)
    return Words(hashes, starts, ends, row, first)


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte range and row of every line; rows are split at line feeds only."""
    feeds = np.flatnonzero(data == 10)
    rows = np.arange(len(offsets) - 1)
    starts = np.concatenate([offsets[:-1], feeds + 1])
    ends = np.concatenate([offsets[1:], feeds])
    row = np.concatenate([rows, np.searchsorted(offsets, feeds, "right") - 1])
    order = np.lexsort((starts, row))
    ends = np.sort(ends[np.lexsort((ends, np.concatenate([rows, row[len(rows) :]])))])
    return starts[order], ends, row[order]


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values, for every position at which a full run begins."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * _BASE + hashes[k : k + n]
    return mix(total)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Lists of the given lengths over consecutive values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    if values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
