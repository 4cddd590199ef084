"""A wavelet matrix over token ids, kept in one compressed blob.

Level by level, from the highest bit of the ids, the sequence's bits are one plane, and the sequence is then parted by
that bit, zeros first. A plane has a directory of ones before every 512 bits, so rank is one directory entry and at most
eight words, and select a search in the directory. With these, an id at a place, the number of times an id occurs in a
range, and the places of its occurrences each take one step a level, without decoding the sequence.

Blob: magic, levels, length, zeros of each level, then for each level the compressed sizes of plane and directory, then
those sections (zstd). Planes are read when a level is first used.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

MAGIC = b"PLWAVE01"
BLOCK = 512             # bits for each directory entry
WORDS = BLOCK // 64
_codec = pa.Codec("zstd", compression_level=3)


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, the first bit lowest, filled up to whole blocks."""
    packed = np.packbits(bits, bitorder="little")
    whole = np.zeros(-(-len(bits) // BLOCK) * WORDS * 8, np.uint8)
    whole[:len(packed)] = packed
    return whole.view(np.uint64)


def _narrow(levels: int) -> type:
    return np.uint16 if levels <= 16 else np.uint32


def encode(ids: np.ndarray, levels: int | None = None) -> bytes:
    """The blob of a sequence of non-negative ids below 2^32."""
    ids = np.ascontiguousarray(ids, np.uint32)
    top = int(ids.max()).bit_length() if len(ids) else 0
    levels = max(levels or 1, top, 1)
    ids, zeros, sections = ids.astype(_narrow(levels)), [], []
    for level in range(levels):
        one = (ids & ids.dtype.type(1 << (levels - 1 - level))).astype(bool)
        words = _words(one)
        directory = np.zeros(len(words) // WORDS + 1, np.uint32)
        np.cumsum(np.bitwise_count(words).reshape(-1, WORDS).sum(1), out=directory[1:])
        zeros.append(len(ids) - int(directory[-1]))
        sections += [_codec.compress(words.tobytes(), asbytes=True), _codec.compress(directory.tobytes(), asbytes=True)]
        ids = np.concatenate([ids.take(np.flatnonzero(x)) for x in (~one, one)])     # by places, faster than by a random mask
    head = MAGIC + struct.pack("<BQ", levels, len(ids)) + struct.pack(f"<{levels}Q", *zeros)
    return head + struct.pack(f"<{2 * levels}Q", *map(len, sections)) + b"".join(sections)


class WaveletMatrix:
    """Queries on a blob. Arguments and results are arrays; places are 0-based."""

    def __init__(self, blob: bytes):
        if blob[:8] != MAGIC:
            raise ValueError("no wavelet blob")
        self.levels, self.length = struct.unpack_from("<BQ", blob, 8)
        self.zeros = struct.unpack_from(f"<{self.levels}Q", blob, 17)
        sizes = struct.unpack_from(f"<{2 * self.levels}Q", blob, 17 + 8 * self.levels)
        self.places = np.concatenate([[0], np.cumsum(sizes)]) + 17 + 24 * self.levels
        self.blob, self.loaded = blob, {}

    def __len__(self) -> int:
        return self.length

    def _plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in self.loaded:
            blocks = -(-self.length // BLOCK)
            made = []
            for section, size, kind in ((2 * level, blocks * WORDS * 8, np.uint64), (2 * level + 1, (blocks + 1) * 4, np.uint32)):
                stored = self.blob[self.places[section]:self.places[section + 1]]
                made.append(np.frombuffer(_codec.decompress(stored, size, asbytes=True), kind))
            self.loaded[level] = tuple(made)
        return self.loaded[level]

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        words, _ = self._plane(level)
        return words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place; a place may be the length."""
        words, directory = self._plane(level)
        block = at >> 9
        found = directory[block].astype(np.int64)
        inside = at & (BLOCK - 1)
        for k in range(WORDS):
            bits = np.clip(inside - 64 * k, 0, 64)
            some = np.flatnonzero(bits)
            mask = np.full(len(some), ~np.uint64(0)) >> (np.uint64(64) - bits[some].astype(np.uint64))
            found[some] += np.bitwise_count(words[block[some] * WORDS + k] & mask)
        return found

    def _select(self, level: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """The place of the nth (from 0) bit of this value."""
        words, directory = self._plane(level)
        before = directory.astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before, nth, "right") - 1
        left = nth - before[block]
        own = words.reshape(-1, WORDS)[block]
        own = own if bit else ~own
        upto = np.cumsum(np.bitwise_count(own), axis=1, dtype=np.int64)
        word = (upto <= left[:, None]).sum(1)
        rows = np.arange(len(nth))
        left = left - np.where(word > 0, upto[rows, np.maximum(word - 1, 0)], 0)
        bits = own[rows, word][:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)
        return block * BLOCK + word * 64 + (np.cumsum(bits, axis=1, dtype=np.int64) <= left[:, None]).sum(1)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at these places."""
        at = np.asarray(at, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.length):
            raise IndexError("no such place")
        ids = np.zeros(len(at), np.uint32)
        for level in range(self.levels if len(at) else 0):
            one, ones = self._bit(level, at), self._ones(level, at)
            ids = ids << np.uint32(1) | one.astype(np.uint32)
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return ids

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of `token` from place `low` to before `high` stand after the last level."""
        if token >> self.levels or low >= high:
            return 0, 0
        ends = np.array([low, high], np.int64)
        for level in range(self.levels):
            ones = self._ones(level, ends)
            ends = self.zeros[level] + ones if token >> (self.levels - 1 - level) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often `token` occurs from place `low` to before `high`."""
        first, last = self._range(token, low, self.length if high is None else high)
        return last - first

    def occurrences(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """The places of `token` from `low` to before `high`, in order."""
        first, last = self._range(token, low, self.length if high is None else high)
        at = np.arange(first, last)
        for level in reversed(range(self.levels if len(at) else 0)):
            bit = token >> (self.levels - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """The whole sequence, from the last level up."""
        ids = np.zeros(self.length, _narrow(self.levels))
        for level in reversed(range(self.levels if self.length else 0)):
            words, _ = self._plane(level)
            one = np.unpackbits(words.view(np.uint8), count=self.length, bitorder="little").astype(bool)
            ids[self.zeros[level]:] |= ids.dtype.type(1 << (self.levels - 1 - level))
            above = np.empty_like(ids)
            above[~one], above[one] = ids[:self.zeros[level]], ids[self.zeros[level]:]
            ids = above
        return ids.astype(np.uint32)
