"""Exact token counts at every prefix, by dynamic programming over byte-pair merges.

The vocabulary joins pairs inside pieces (runs of letters, single digits, runs of other signs, a few contractions) and
marks the last symbol of a piece. For a piece, `last[k]` is the last token of the encoding of its first k symbols; it is
the one vocabulary entry t that ends there and that stays apart from `last[k - len(t)]` when the two are encoded
together. So each prefix costs a few lookups, and counts of longer texts are sums over pieces: how many tokens a text
has, whether it fits a budget and where to cut it are read off the stored counts without encoding anything again.

Pieces never cross a blank, so a text's counts are stored at the end of each blank-separated word; inside a word
`WordCounter.prefixes` has them at every code point, which is where a limit inside a word is looked for.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.tables import arrow_struct, by_batch, table

LIMIT = 2048
WORDS_KEPT = 400_000   # entries of the cache of words, and of that of pieces, which are emptied when full
LONGEST_KEPT = 48      # longer words are not cached

_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+")


class WordCounter:
    """Token counts of blank-separated words for one vocabulary file of word-end byte-pair merges."""

    def __init__(self, path: str):
        from tokenizers import PreTokenizedString, Tokenizer

        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.pieces_of = library.pre_tokenizer.pre_tokenize_str
        self.steps, self.pre_tokenized = (library.normalizer, library.pre_tokenizer), PreTokenizedString
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        self.ids: dict[str, int] = stored["model"]["vocab"]
        self.end = stored["model"]["end_of_word_suffix"]
        self.special = [entry["content"] for entry in stored["added_tokens"]]
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in stored["model"]["merges"]):
            pair, whole = (self.ids[left], self.ids[right]), self.ids[left + right]
            self.joined[pair] = whole
            self.halves[whole] = pair
        self.longest = max(map(len, self.ids))
        self.apart: dict[tuple[int, int], bool] = {}
        self.piece_counts: dict[str, int] = {}
        self.word_counts: dict[str, int] = {"": 0}

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' text gives the two tokens: no merge across the border comes first.

        Ids grow with the order of merges. Both tokens are taken apart, the later merge first, and each pair that
        meets at the border is looked up: a merge that is earlier than those not yet taken apart would join it.
        """
        known = self.apart.get((left, right))
        if known is not None:
            return known
        a, b, bound, free = left, right, 1 << 60, True
        while True:
            whole = self.joined.get((a, b))
            if whole is not None and whole < bound:
                free = False
                break
            a_parts, b_parts = self.halves.get(a), self.halves.get(b)
            if a_parts is None and b_parts is None:
                break
            # the merge that made the left token wins a tie with one across the border, that of the right does not
            if b_parts is None or (a_parts is not None and a > b):
                a, bound = a_parts[1], a
            else:
                b, bound = b_parts[0], b + 1
        if len(self.apart) > WORDS_KEPT * 4:
            self.apart.clear()
        self.apart[(left, right)] = free
        return free

    def _inner(self, piece: str, last: list[int] | None = None, count: list[int] | None = None) -> tuple[list[int], list[int]]:
        """For each prefix taken as the beginning of a longer piece: its last token, and its count. Given lists of the
        first prefixes are continued."""
        ids, last, count = self.ids, last or [-1], count or [0]
        for k in range(len(last), len(piece) + 1):
            for begin in range(max(0, k - self.longest), k):
                token = ids.get(piece[begin:k])
                if token is not None and (begin == 0 or self.stay_apart(last[begin], token)):
                    last.append(token)
                    count.append(count[begin] + 1)
                    break
        return last, count

    def _closed(self, piece: str, k: int, last: list[int], count: list[int]) -> int:
        """Tokens of the first k symbols as a piece of their own."""
        for begin in range(max(0, k - self.longest), k):
            token = self.ids.get(piece[begin:k] + self.end)
            if token is not None and (begin == 0 or self.stay_apart(last[begin], token)):
                return count[begin] + 1
        raise ValueError(f"no encoding of {piece[:k]!r}")

    def piece(self, piece: str) -> int:
        known = self.piece_counts.get(piece)
        if known is None:
            known = self._closed(piece, len(piece), *self._inner(piece[:-1]))
            if len(piece) <= LONGEST_KEPT:
                if len(self.piece_counts) >= WORDS_KEPT:
                    self.piece_counts.clear()
                self.piece_counts[piece] = known
        return known

    def _pieces(self, word: str) -> list[str]:
        """The word's pieces as the merges see them, special strings left out."""
        if word.isascii() and word.isprintable():
            return _ASCII_PIECES.findall(word.lower())
        return [piece for piece, _ in self.pieces_of(self.normalize(word))]

    def word(self, word: str) -> int:
        """Tokens of a text without blanks; special strings count one each."""
        known = self.word_counts.get(word)
        if known is not None:
            return known
        if "<|" in word:
            parts = self.special_pattern.split(word)
            total = len(parts) // 2 + sum(self.piece(p) for part in parts[::2] for p in self._pieces(part))
        else:
            total = sum(map(self.piece, self._pieces(word)))
        if len(word) <= LONGEST_KEPT:
            if len(self.word_counts) >= WORDS_KEPT:
                self.word_counts.clear()
                self.word_counts[""] = 0
            self.word_counts[word] = total
        return total

    def prefix_counts(self, piece: str) -> list[int]:
        """Token counts of the first 0, 1, ... symbols of one piece."""
        last, count = self._inner(piece)
        return [0] + [self._closed(piece, k, last, count) for k in range(1, len(piece) + 1)]

    def _placed(self, word: str) -> list[tuple[str, int, int]]:
        """Pieces with the code points of the word that each comes from; of pieces that share a code point, or that a
        sign still to be composed may change, the first."""
        if word.isascii() and word.isprintable():
            return [(m[0], m.start(), m.end()) for m in _ASCII_PIECES.finditer(word.lower())]
        normalizer, splitter = self.steps
        found = self.pre_tokenized(word)
        found.normalize(normalizer.normalize)
        splitter.pre_tokenize(found)
        composed = unicodedata.is_normalized("NFC", word)
        placed: list[tuple[str, int, int]] = []
        for piece, (first, end), _ in found.get_splits("original", "char"):
            if placed and (first < placed[-1][2] or not composed and unicodedata.combining(word[first])):
                placed[-1] = (*placed[-1][:2], max(end, placed[-1][2]))
            else:
                placed.append((piece, first, end))
        nexts = [first for _, first, _ in placed[1:]] + [len(word)]
        for i, (piece, first, end) in enumerate(placed):    # signs that went into the one before count with it
            while end < nexts[i] and not word[end].isspace():
                end += 1
            placed[i] = (piece, first, end)
        return placed

    def _inside(self, source: str, piece: str) -> list[int]:
        """Token counts of the first 1, 2, ... code points of what became this piece, with those that share its last one."""
        if len(source) <= 3:    # a contraction begins as other pieces
            return [self.word(source[:k]) for k in range(1, len(source) + 1)]
        last, count = self._inner(piece)
        if unicodedata.is_normalized("NFC", source):    # and so are its prefixes
            size = {c: sum(len(p) for p, _ in self.pieces_of(self.normalize(c))) for c in set(source)}
            ends = np.cumsum([size[c] for c in source]).tolist()
            if ends[-1] == len(piece):
                return [self._closed(piece, k, last, count) for k in ends]
        counts = []
        for k in range(1, len(source) + 1):     # a sign still to come may change the last ones
            own = [p for p, _ in self.pieces_of(self.normalize(source[:k]))]
            if len(own) != 1:
                counts.append(sum(map(self.piece, own)))
                continue
            same = len(own[0])
            while not piece.startswith(own[0][:same]):
                same -= 1
            counts.append(self._closed(own[0], len(own[0]), *self._inner(own[0], last[:same + 1], count[:same + 1])))
        return counts

    def prefixes(self, word: str, budget: int | None = None) -> list[int]:
        """Token counts of the first 0, 1, ... code points of a text without blanks, at least as far as they can fit a
        budget: from the piece on with which the tokens of whole pieces exceed it, none does."""
        counts, used = [0], 0
        begin, before = 0, 0    # of the last piece: its place, and the tokens before it
        parts = self.special_pattern.split(word) if "<|" in word else [word]
        at = 0
        for i, part in enumerate(parts):
            if i % 2:           # the beginning of a special string is plain text, and may join the piece before
                counts += [before + self.word(word[begin:at + k]) for k in range(1, len(part))]
                used += 1
                counts.append(used)
                begin, before = at + len(part), used
            for piece, first, end in self._placed(part) if i % 2 == 0 else ():
                if budget is not None and used > budget:
                    return counts
                counts += [used] * (at + first + 1 - len(counts))   # signs without tokens
                begin, before = at + first, used
                counts += [used + n for n in self._inside(part[first:end], piece)]
                used = counts[-1]
            at += len(part)
            if len(counts) <= at:
                counts += [used] * (at + 1 - len(counts))
                begin, before = at, used
            if budget is not None and used > budget and i % 2:
                return counts
        return counts

    def cut(self, text: str, parts: list[str], counts: np.ndarray, limit: int) -> tuple[int, int]:
        """Code points of the longest prefix of at most `limit` tokens, and its tokens; words and counts are those of `text`."""
        fits = int(np.searchsorted(counts, limit, "right")) - 1
        if fits == len(parts):
            return len(text), int(counts[fits])
        left = limit - int(counts[fits])
        inside = self.prefixes(parts[fits], left)
        k = max(k for k, n in enumerate(inside) if n <= left)
        return sum(map(len, parts[:fits])) + fits + k, int(counts[fits]) + inside[k]

    def text(self, text: str) -> tuple[list[str], np.ndarray]:
        """The text's words and the token count at the end of each (one more entry than words, from 0)."""
        parts = text.replace("\n", " ").split(" ")
        known = self.word_counts.get
        counts = [known(w) if known(w) is not None else self.word(w) for w in parts]
        return parts, np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


@functools.lru_cache(maxsize=1)
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def _vocabulary(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_counts(text: Column, limit: int = LIMIT, path: str | None = None) -> Column:
    """A struct for each text: n_bytes (UTF-8), n_tokens, and where to cut it to at most `limit` tokens.

    cut_at counts the code points of the longest prefix within the limit, which may end inside a word; cut_tokens are
    its tokens. `path` must exist on every executor; by default the installed public
    file is taken. Null counts as empty. A text is one row's work, linear in its length; repeated rows count alike.
    """

    def work(values: pa.Array) -> dict[str, pa.Array]:
        words = counter(_vocabulary(path))
        sizes, totals, cuts, cut_tokens = [], [], [], []
        for value in values:
            content = value.as_py() or ""
            parts, counts = words.text(content)
            sizes.append(len(content.encode()))
            totals.append(int(counts[-1]))
            place, tokens = words.cut(content, parts, counts, limit)
            cuts.append(place)
            cut_tokens.append(tokens)
        return {"n_bytes": pa.array(sizes, pa.int64()), "n_tokens": pa.array(totals, pa.int64()),
                "cut_at": pa.array(cuts, pa.int64()), "cut_tokens": pa.array(cut_tokens, pa.int64())}

    return arrow_struct(text, "n_bytes long, n_tokens long, cut_at long, cut_tokens long", work)


def prefix_table(docs: DataFrame, key: str, text: str = "text", path: str | None = None, inside: bool = False) -> DataFrame:
    """For each row: key, and `counts`, the exact token count at the end of each blank-separated word, from 0; with
    `inside`, at every code point of the text."""

    def every(words: WordCounter, content: str) -> np.ndarray:
        parts, counts = words.text(content)
        own = [np.array(words.prefixes(part)) + before for part, before in zip(parts, counts, strict=False)]
        return np.concatenate(own)      # a word's first entry is the prefix that ends with the blank before it

    def work(batch: pa.RecordBatch) -> dict:
        words = counter(_vocabulary(path))
        texts = (value.as_py() or "" for value in batch.column(1))
        counts = [every(words, value) if inside else words.text(value)[1] for value in texts]
        return {key: batch.column(0), "counts": pa.array(counts, pa.list_(pa.int64()))}

    return by_batch(docs.select(key, text), f"`{key}` {docs.schema[key].dataType.simpleString()}, counts array<long>",
                    work)


def words_within(counts: Column, budget: int) -> Column:
    """How many words of a row of `prefix_table` fit the budget; JVM-side, without another look at the text."""
    return F.size(F.filter(counts, lambda c: c <= budget)) - 1


def points_within(counts: Column, budget: int) -> Column:
    """How many code points of a row of `prefix_table` with `inside` fit the budget. Within a word a longer prefix may
    have fewer tokens, so it is the last entry that fits."""
    return F.array_max(F.filter(F.transform(counts, lambda c, i: F.when(c <= budget, i)), lambda i: i.isNotNull()))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text; over_limit: more than 2,048."""
    docs = table(spark, sf_dir, "documents").select("doc_id", token_counts(F.col("text")).alias("counted"))
    return docs.select("doc_id", "counted.n_bytes", "counted.n_tokens",
                       (F.col("counted.n_tokens") > LIMIT).alias("over_limit"),
                       "counted.cut_at", "counted.cut_tokens")
