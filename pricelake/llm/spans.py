"""Vectorised splitting and hashing of the UTF-8 bytes of Arrow string columns.

Texts stay in the Arrow buffer: no Python string is made. All splits used by the operators are at ASCII bytes, which
never occur inside a longer UTF-8 sequence, so working on bytes equals working on code points.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20  # texts are worked on in blocks of about this size, which bounds the temporary arrays

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
AS_IS = np.arange(256, dtype=np.uint8)

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SEGMENT = 1 << 16    # bytes that share one table of powers, which every worker keeps
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@dataclass
class Block:
    """Rows `first` to `last` of a batch: their bytes, and where each row begins in them (one entry more than rows)."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of a string column in blocks of about `limit` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Block(first, last, whole[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def runs(kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of one non-zero kind inside each row: starts, ends, and the first run of each row (one more)."""
    if not len(kinds):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, np.zeros(len(offsets), np.int64)
    begins = np.empty(len(kinds) + 1, bool)
    begins[0] = begins[-1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:-1])
    begins[offsets] = True
    edges = np.flatnonzero(begins)
    inside = kinds[edges[:-1]] != 0
    starts, ends = edges[:-1][inside], edges[1:][inside]
    return starts, ends, np.searchsorted(starts, offsets)


def words(block: Block, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that are no separators."""
    return runs((~separators)[block.data].view(np.uint8), block.offsets)


def lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines between \\n: starts, ends, and the first line of each row (one more). An empty row has one empty line."""
    breaks = np.flatnonzero(block.data == 10)
    starts = np.sort(np.concatenate([block.offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, block.offsets[1:]]))
    each = np.diff(np.searchsorted(breaks, block.offsets)) + 1
    return starts, ends, np.concatenate([[0], np.cumsum(each)])


def trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without white space at both ends; a blank span becomes empty."""
    solid = np.flatnonzero(~SPACES[data])
    if not len(solid):
        return starts, starts.copy()
    after = np.searchsorted(solid, starts)
    before = np.searchsorted(solid, ends) - 1
    some = before >= after
    new_starts = np.where(some, solid[np.minimum(after, len(solid) - 1)], starts)
    return new_starts, np.where(some, solid[before] + 1, starts)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(seed: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(seed)
    if have is None or len(have[0]) < length:
        base = _MULTIPLIERS[seed]
        factors = np.full((2, length), [[base], [pow(base, -1, 1 << 64)]], np.uint64)
        factors[:, 0] = 1
        have = tuple(np.cumprod(factors, axis=1))
        _powers[seed] = have
    return have


_VALUES = [mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(m)) for m in _MULTIPLIERS]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = AS_IS, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the spans' bytes after `fold`; spans must be in order and must not overlap.

    Each is a difference of running sums of byte values times powers, shifted to position 0 and mixed with the length.
    """
    result = np.zeros(len(starts), np.uint64)
    values = _VALUES[seed][fold]
    at = 0
    while at < len(starts):
        upto = max(int(np.searchsorted(ends, starts[at] + _SEGMENT, "right")), at + 1)
        low, high = int(starts[at]), int(ends[upto - 1])
        powers, inverse = _power_tables(seed, max(high - low + 1, _SEGMENT + 1))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * powers[:high - low], out=sums[1:])
        begin, end = starts[at:upto] - low, ends[at:upto] - low
        result[at:upto] = (sums[end] - sums[begin]) * inverse[begin]
        at = upto
    return mixed(result ^ (ends - starts).astype(np.uint64) * np.uint64(_MULTIPLIERS[1 - seed]))


def rows_of(firsts: np.ndarray) -> np.ndarray:
    """The row of each run, from the first run of each row."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def ngrams(values: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive values of a row, and the row of each; order matters."""
    rows = rows_of(firsts)
    if len(values) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joint = values[:len(values) - n + 1].copy()
    for k in range(1, n):
        joint = joint * np.uint64(0xD1342543DE82EF95) + values[k:len(values) - n + 1 + k]
    same = rows[:len(rows) - n + 1] == rows[n - 1:]
    return mixed(joint[same]), rows[:len(rows) - n + 1][same]


def row_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The sum of each row's values."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[firsts[1:]] - sums[firsts[:-1]]


def release() -> None:
    """Give freed memory back to the system. An idle Python worker keeps the peak of its last task otherwise, beside the
    executor's other processes."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
