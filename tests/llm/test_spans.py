import random

import numpy as np
import pyarrow as pa
from helpers import awkward, lowered, words

from pricelake.llm import spans


def test_splits_and_hashes():
    texts = [r[1] for r in awkward()] + ["a\n", "\n\n", "x" * 5000, "é\x0b\x0cé"]
    known = {}
    for block in spans.blocks(pa.array(texts), 4000):
        starts, ends, firsts = spans.words(block)
        hashed = spans.hashes(block.data, starts, ends, spans.LOWER)
        line_starts, line_ends, line_firsts = spans.lines(block)
        a, b = spans.trimmed(block.data, line_starts, line_ends)
        for row in range(block.last - block.first):
            text = texts[block.first + row] or ""
            own = words(lowered(text))
            assert firsts[row + 1] - firsts[row] == len(own)
            for word, value in zip(own, hashed[firsts[row]:firsts[row + 1]], strict=True):
                assert known.setdefault(word, value) == value
            keys = [block.data[a[i]:b[i]].tobytes().decode() for i in range(line_firsts[row], line_firsts[row + 1])]
            assert keys == [x.strip(" \t\n\x0b\x0c\r") for x in text.split("\n")]
    assert len(set(map(int, known.values()))) == len(known)


def test_long_spans_cross_segments(monkeypatch):
    rng = random.Random(0)
    data = np.frombuffer("".join(rng.choice("abc ") for _ in range(20_000)).encode(), np.uint8)
    block = spans.Block(0, 1, data, np.array([0, len(data)]))
    starts, ends, _ = spans.words(block)
    whole = spans.hashes(data, starts, ends)
    monkeypatch.setattr(spans, "_SEGMENT", 64)
    assert np.array_equal(whole, spans.hashes(data, starts, ends))


def test_ngrams_stay_in_rows():
    values = np.arange(7, dtype=np.uint64)
    grams, rows = spans.ngrams(values, np.array([0, 3, 3, 7]), 2)
    assert rows.tolist() == [0, 0, 2, 2, 2] and len(set(grams.tolist())) == 5


def test_tables_of_powers_that_a_worker_keeps_are_small():
    spans._powers.clear()
    text = pa.array(["some words of a line\n" * 200_000])
    block = next(spans.blocks(text))
    starts, ends, _ = spans.words(block)
    for seed in (0, 1):
        assert len(np.unique(spans.hashes(block.data, starts, ends, spans.LOWER, seed))) == 5
    assert sum(x.nbytes for tables in spans._powers.values() for x in tables) < 4 << 20
