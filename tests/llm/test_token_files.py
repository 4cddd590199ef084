"""Wavelet-matrix files against plain arrays and whole texts encoded by the library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelake.llm import spans, units, wavelet
from pricelake.llm.token_files import documents, occurrences, read_tokens, token_counts, write_tokens
from pricelake.llm.wavelet import WaveletMatrix, encode

public_tokenizers = pytest.importorskip("public_tokenizers")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40) | st.integers(0, 2**32 - 1), max_size=700), st.integers(0, 2**32 - 1))
def test_matrix_equals_a_list(ids, other):
    matrix = WaveletMatrix(encode(np.array(ids, np.uint32)))
    assert len(matrix) == len(ids) and matrix.decode().tolist() == ids
    assert matrix.access(np.arange(len(ids))).tolist() == ids
    for token in {*ids[:5], other}:
        low, high = len(ids) // 3, len(ids) - len(ids) // 4
        assert matrix.count(token) == ids.count(token)
        assert matrix.count(token, low, high) == ids[low:high].count(token)
        assert matrix.occurrences(token).tolist() == [i for i, x in enumerate(ids) if x == token]
        assert matrix.occurrences(token, low, high).tolist() == [i for i in range(low, high) if ids[i] == token]


def test_matrix_of_many_blocks():
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.3, 200_000) % 50_000).astype(np.uint32)
    blob = encode(ids)
    matrix = WaveletMatrix(blob)
    assert np.array_equal(matrix.decode(), ids) and len(blob) < 2 * len(ids)
    at = rng.integers(0, len(ids), 500)
    assert np.array_equal(matrix.access(at), ids[at])
    for token in (1, 2, 777, 49_999):
        assert np.array_equal(matrix.occurrences(token), np.flatnonzero(ids == token))
    with pytest.raises(IndexError):
        matrix.access([len(ids)])
    with pytest.raises(ValueError):
        WaveletMatrix(b"something else")


def plain(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        made.append((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
    return made


ALPHABET = [" ", " ", "a", "b", "Z", "é", "à", " ", "\n", "\t", "　", "0", "7", "!", "'", "'s", "'ll", ".", "中", "<|endoftext|>", "<|", "|>",
            "\x1c", "\x7f", "́", "²", "word", " the"]


def test_pieces_give_the_ids_of_whole_texts(monkeypatch):
    import pyarrow as pa

    from pricelake.llm import spans, units

    rng = random.Random(11)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + ["x" * 300, "x" * 300 + " y"]
    tokens = units.ByteLevelTokens(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(units, "KEPT", 3000)
    want = [m[3][:-1] for m in plain(list(enumerate(texts)))]
    for _ in range(2):      # the second time from the cache, as far as it has not been emptied
        got = []
        for block in spans.blocks(pa.array(texts), 9_000):
            flat, each = tokens(block)
            got += [part.tolist() for part in np.split(flat, np.cumsum(each)[:-1])]
        assert got == want
    assert max(map(len, tokens.kept)) <= units.LONGEST_KEPT


def check(spark, rows, folder, shard_tokens):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, file string, part long, _doc long")
    stored = write_tokens(df.repartition(4), folder, shard_tokens=shard_tokens)
    made = plain(rows)
    got = documents(stored).orderBy("start").collect()
    assert sorted(((r.doc, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted((m[:3] for m in made), key=str)
    ids = [r.doc for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got][:-1]]).tolist()
    return stored, made


def test_files_equal_whole_text_encodings(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i * 7 % 211, prose(rng, rng.randint(0, 300))) for i in range(150)]
    rows += [(500, "special <|endoftext|> inside  <|endoftext|>"), (501, None), (502, ""), (None, "no id"), (None, None),
             (503, "日本語　テキスト café   au\n\nlait \t"), (504, "!!! ! !"), (505, "\x00 x")]
    stored, made = check(spark, rows, str(tmp_path / "files"), 2_000)
    assert stored.count() > 4
    wanted = [0, 50256, 256, 11, 49_000, 10**6]
    counts = {r.token: r.n for r in token_counts(stored, wanted).collect()}
    assert counts == {t: sum(m[3].count(t) for m in made) for t in wanted}
    found = sorted(((r.doc, r.token, r.place) for r in occurrences(stored, [0, 50256]).collect()), key=str)
    assert found == sorted(((m[0], t, i) for m in made for i, t in enumerate(m[3]) if t in (0, 50256)), key=str)
    again = read_tokens(spark, str(tmp_path / "files"))
    assert again.count() == stored.count()


def test_one_id_with_most_rows_and_awkward_rows(spark, tmp_path, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    rows = [(9, f"text {i % 5}") for i in range(400)] + [(r[0], r[1]) for r in awkward()]
    stored, _ = check(spark, rows, str(tmp_path / "files"), 500)
    assert stored.select("part").distinct().count() > 1     # rows of one id are in several ranges


def test_empty_table_and_other_id_types(spark, tmp_path):
    stored = write_tokens(frame(spark, []), str(tmp_path / "none"))
    assert documents(stored).count() == 0 and token_counts(stored, [5]).first().n == 0
    named = spark.createDataFrame([("b", "two"), ("a", "one two"), (None, "x")], "doc_id string, text string")
    got = documents(write_tokens(named, str(tmp_path / "named"))).orderBy("start").collect()
    assert [(r.doc, r.start) for r in got] == [(None, 0), ("a", 2), ("b", 5)]


def test_a_wavelet_matrix_moves_small_ids_in_16_bits(monkeypatch):
    """Ids on both sides of 2^16 come back as they are; those below are parted as 16-bit numbers."""
    rng = np.random.default_rng(5)
    kinds, concatenate = [], np.concatenate
    for top, kind in ((50_000, np.uint16), (65_536, np.uint16), (65_537, np.uint32), (1 << 31, np.uint32)):
        ids = np.append(rng.integers(0, top, 3000), top - 1).astype(np.uint32)
        with monkeypatch.context() as patch:
            patch.setattr(np, "concatenate", lambda parts, *a, **b: kinds.append(parts[0].dtype) or concatenate(parts, *a, **b))
            blob = wavelet.encode(ids)
        assert set(kinds) == {np.dtype(kind)}
        kinds.clear()
        found = wavelet.WaveletMatrix(blob).decode()
        assert found.dtype == np.uint32 and (found == ids).all()


def test_stretches_are_numbered_as_they_first_occur():
    block = next(spans.blocks(pa.array(["b a b", " c a", "b"])))
    distinct = units.Distinct(block)
    assert distinct.found == [b"b", b" a", b" b", b" c"] and distinct.which.tolist() == [0, 1, 2, 3, 1, 0]
