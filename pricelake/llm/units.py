"""Token ids of whole blocks of texts, each distinct stretch of a block encoded once by its tokenizer's own library.

A text is cut before a space that follows a character that is no white space. Neither tokenizer used here has a token
across such a place (the byte-level splitter begins a new piece there, and no entry of the piece vocabulary has its space
mark after another character), so the ids of a text are those of its stretches in order. Tests compare with whole texts.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa

from pricelake.llm import spans

AT_ONCE = 4096      # stretches that a library encodes in one call, whose results are large objects of its own
SPACE_MARK = "▁"

# Control characters, space, and every byte that may end a Unicode white space character (U+0085, U+00A0, U+1680,
# U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000). After any of these a text is not cut, which is always right.
MAYBE_SPACE = np.zeros(256, bool)
MAYBE_SPACE[:0x21] = MAYBE_SPACE[0x80:0x8B] = True
MAYBE_SPACE[[0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


def stretches(block: spans.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of a block, and the first of each row (one more). Empty rows have none."""
    data = block.data
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 0x20) & ~MAYBE_SPACE[data[:-1]]
    cut[block.offsets] = True
    edges = np.flatnonzero(cut)
    return edges[:-1], edges[1:], np.searchsorted(edges[:-1], block.offsets)


LETTERS = np.zeros(256, bool)
LETTERS[ord("A"):ord("Z") + 1] = LETTERS[ord("a"):ord("z") + 1] = True
OTHERS = ~LETTERS & (np.arange(256) < 128)
SOLID = OTHERS & ~MAYBE_SPACE & (np.arange(256) != ord("'"))     # an apostrophe may begin a piece of its own with letters
# ASCII control characters and white space, and the first bytes of all other white space, make a piece be encoded by itself.
NOT_JOINED = np.arange(256) < 0x21
NOT_JOINED[[0xC2, 0xE1, 0xE2, 0xE3]] = True
KEPT = 1_500_000          # entries of a process's cache of pieces, which is emptied when full
LONGEST_KEPT = 64       # bytes; longer ones are not cached


def splits(block: spans.Block, whole: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like `stretches`, cut also between an ASCII letter and another ASCII character, where the byte-level splitter always
    begins a new piece; but not inside the strings `whole`."""
    data = block.data
    before, after = data[:-1], data[1:]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (after == 0x20) & ~MAYBE_SPACE[before] | LETTERS[before] & OTHERS[after] | SOLID[before] & LETTERS[after]
    raw = data.tobytes() if whole else b""
    for text in whole:
        at = raw.find(text)
        while at >= 0:
            cut[at + 1:at + len(text)] = False
            at = raw.find(text, at + 1)
    cut[block.offsets] = True
    edges = np.flatnonzero(cut)
    return edges[:-1], edges[1:], np.searchsorted(edges[:-1], block.offsets)


class ByteLevelTokens:
    """All ids of a block from a byte-level vocabulary file, its library asked once for each piece that is not cached."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        [self.line_break] = self.library.encode("\n", add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.kept: dict[bytes, int] = {}
        self.store = pa.array([], pa.list_(pa.int32()))

    def _words(self, found: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Sizes and ids of pieces of ASCII letters, but for a space they may begin with: the library's model takes them as they
        are, with its sign for a space."""
        tokenize, number = self.library.model.tokenize, attrgetter("id")
        made = [tokenize("\u0120" + f[1:].decode() if f[0] == 0x20 else f.decode()) for f in found]
        sizes = np.fromiter(map(len, made), np.int32, len(made))
        return [sizes], [np.fromiter(map(number, chain.from_iterable(made)), np.int32, int(sizes.sum()))]

    def _joined(self, found: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Sizes and ids of pieces without white space, but for a space they may begin with: many are encoded at a time with
        line breaks in between, each of which is a piece of its own."""
        sizes, flat = [], []
        for at in range(0, len(found), AT_ONCE):
            text = b"\n".join(found[at:at + AT_ONCE]).decode()
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)
            breaks = ids == self.line_break
            sizes.append(np.diff(np.flatnonzero(breaks), prepend=-1, append=len(ids)).astype(np.int32) - 1)
            flat.append(ids[~breaks])
        return sizes, flat

    def _alone(self, found: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        sizes, flat = [], []
        for at in range(0, len(found), AT_ONCE):
            made = self.library.encode_batch_fast([f.decode() for f in found[at:at + AT_ONCE]], add_special_tokens=False)
            ids = [encoding.ids for encoding in made]
            sizes.append(np.fromiter(map(len, ids), np.int32, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes[-1].sum())))
        return sizes, flat

    def _encoded(self, found: list[bytes], words: int, joint: int) -> pa.ListArray:
        """The first pieces are words, those after them can be joined, the rest cannot."""
        made = [self._words(found[:words]), self._joined(found[words:joint]), self._alone(found[joint:])]
        places = np.cumsum(np.concatenate([np.zeros(1, np.int32), *(part for sizes, _ in made for part in sizes)]), dtype=np.int32)
        flat = np.concatenate([np.zeros(0, np.int32), *(part for _, ids in made for part in ids)])
        return pa.ListArray.from_arrays(pa.array(places), pa.array(flat))

    @staticmethod
    def _kinds(data: np.ndarray, distinct: Distinct) -> np.ndarray:
        """0 for words, 1 for other pieces that can be joined, 2 for the rest."""
        if not len(data):
            return np.zeros(0, np.int64)
        first, end = distinct.lead + (data[distinct.lead] == 0x20), distinct.lead + distinct.sizes
        has = lambda flags: np.diff(np.append(np.int32(0), np.cumsum(flags, dtype=np.int32))[[first, end]], axis=0)[0] > 0
        return np.where((first == end) | has(NOT_JOINED[data]), 2, has(~LETTERS[data]))

    def __call__(self, block: spans.Block) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after another, and how many each row has."""
        distinct = Distinct(block, splits(block, self.special))
        if len(self.kept) > KEPT:
            self.clear()
        place = np.fromiter(map(self.kept.get, distinct.found, repeat(-1)), np.int64, len(distinct.found))
        new = np.flatnonzero(place < 0)
        # words come first, then pieces to be joined, then the others, and of these the long ones, which are not kept, last
        kind = np.where(distinct.sizes > LONGEST_KEPT, 3, self._kinds(block.data, distinct))[new]
        new = new[np.argsort(kind, kind="stable")]
        words, joint, short = np.searchsorted(np.sort(kind), [1, 2, 3]).tolist()
        place[new] = len(self.store) + np.arange(len(new))
        pieces_ = [distinct.found[i] for i in new.tolist()]
        self.kept.update(zip(pieces_[:short], place[new[:short]].tolist()))
        every = pa.concat_arrays([self.store, self._encoded(pieces_, words, joint)])
        self.store = every.slice(0, len(self.store) + short)
        taken = every.take(pa.array(place[distinct.which]))
        return taken.flatten().to_numpy(), spans.row_sums(taken.value_lengths().to_numpy(), distinct.firsts)


class StretchEncoder:
    """Ids of stretches as an Arrow list array. `encode` takes a list of strings and gives a list of lists of ids."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self.encode = encode

    def __call__(self, found: list[bytes]) -> pa.ListArray:
        sizes, flat = [np.zeros(1, np.int32)], [np.zeros(0, np.int32)]
        for at in range(0, len(found), AT_ONCE):
            ids = self.encode([s.decode() for s in found[at:at + AT_ONCE]])
            sizes.append(np.fromiter(map(len, ids), np.int32, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes[-1].sum())))
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes), dtype=np.int32)), pa.array(np.concatenate(flat)))


class Distinct:
    """The distinct stretches of a block, and which of them each stretch is. They are told apart by 64-bit hashes: two of the
    block's stretches are taken for one with a probability below 1e-8."""

    def __init__(self, block: spans.Block, cuts: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        starts, ends, self.firsts = cuts or stretches(block)
        # numbered as they first occur
        self.which = pa.array(spans.hashes(block.data, starts, ends)).dictionary_encode().indices.to_numpy()
        lead = np.flatnonzero(np.diff(np.maximum.accumulate(self.which), prepend=-1))
        raw = block.data.tobytes()
        self.lead, self.sizes = starts[lead], (ends - starts)[lead]
        self.found = [raw[a:b] for a, b in zip(starts[lead].tolist(), ends[lead].tolist(), strict=True)]


@functools.cache
def byte_level_tokens(path: str) -> ByteLevelTokens:
    """The ids of whole blocks; strings of special tokens inside texts become these tokens."""
    return ByteLevelTokens(path)


@functools.cache
def byte_level(path: str) -> StretchEncoder:
    """Encoder of a byte-level vocabulary file for stretches; strings of special tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return StretchEncoder(lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)])


@functools.cache
def pieces(path: str) -> StretchEncoder:
    """Encoder of a piece model for stretches of a text that a space precedes: the model puts that space back itself."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)
    lone = [library.piece_to_id(SPACE_MARK)]

    def encode(texts: list[str]) -> list[list[int]]:
        found = library.encode([t[1:] for t in texts], num_threads=1) if texts else []
        return [lone if t == " " else ids for t, ids in zip(texts, found, strict=True)]

    return StretchEncoder(encode)


@functools.cache
def byte_level_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file, special tokens included."""
    # The byte-level alphabet: printable Latin-1 stands for itself, the other bytes take code points from 256 on.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    entries = stored["model"]["vocab"]
    special = {t["id"]: t["content"].encode() for t in stored["added_tokens"]}
    found = [b""] * (max([*entries.values(), *special]) + 1)
    for entry, i in entries.items():
        found[i] = bytes(byte[c] for c in entry)
    for i, content in special.items():
        found[i] = content
    return found


@functools.cache
def piece_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a piece model: its space mark as a space, byte entries as that byte."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)
    return [bytes([int(library.id_to_piece(i)[3:-1], 16)]) if library.is_byte(i)
            else library.id_to_piece(i).replace(SPACE_MARK, " ").encode() for i in range(library.get_piece_size())]
