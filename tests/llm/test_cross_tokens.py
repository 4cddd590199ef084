"""Cross-tokenizer alignment against whole texts encoded by both libraries and compared token by token."""

import hashlib
import random
from collections import Counter

import pytest
from helpers import awkward, frame, prose

from pricelake.llm.cross_tokens import aligned
from pricelake.llm.units import byte_level_bytes, piece_bytes

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PATH_B)


def ends(ids, entries):
    at, found = 0, {}
    for i, token in enumerate(ids):
        at += len(entries[token])
        found[at] = i
    return found


def plain(rows, libraries):
    """Each row's groups and links by whole-text encodings, then the counts over all rows."""
    entries_a, entries_b = byte_level_bytes(PATH_A), piece_bytes(PATH_B)
    made, totals = [], Counter()
    for doc, text in rows:
        a = libraries[0].encode(" " + text, add_special_tokens=False).ids if text else []
        b = libraries[1].encode(text) if text else []
        want = (" " + text).encode() if text else b""
        if b"".join(entries_a[i] for i in a) != want or b"".join(entries_b[i] for i in b) != want:
            a, b = [], []
        ends_a, ends_b = ends(a, entries_a), ends(b, entries_b)
        links, groups, low_a, low_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a[end], ends_b[end]
            links.append((a[i], b[j]))
            groups.append(",".join(map(str, a[low_a:i + 1])) + "|" + ",".join(map(str, b[low_b:j + 1])))
            low_a, low_b = i + 1, j + 1
        totals.update(links)
        text_of_groups = ";".join(groups)
        made.append((doc, len(a), len(b), len(groups), links,
                     hashlib.sha256(text_of_groups.encode()).hexdigest() if a else ""))
    highest = Counter()
    for (_, b), n in totals.items():
        highest[b] = max(highest[b], n)
    return sorted(((doc, n_a, n_b, groups, len(links), sum(totals[p] == highest[p[1]] for p in links),
                    sum(totals[p] for p in links), digest) for doc, n_a, n_b, groups, links, digest in made), key=str), totals


def run(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, a long, pair string").repartition(parts)
    found, totals = aligned(df)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in found.select(columns).collect()), key=str), totals


def texts():
    rng = random.Random(5)
    odd = ["a  b", "  lead", "trail  ", "tab\there", "x\n\n y", "nbsp  after", "ideographic　 space", "▁ mark ▁x",
           "<|endoftext|> here<s>", "</s><unk> <pad>", "日本語 テキスト です", "naïve café à la crème", "🙂 🙂🙂", "\x00 zero",
           "don't we'll I'm", "12345 67", " ", "\n", "  line", "é x́", "a\u0085 b", "....  ,,,", "a" * 5000,
           "​ zero width ﻿ bom", "one two one two", "x \t y", "word\r\n next"]
    alphabet = [" ", " ", "a", "b", "é", " ", "\n", "　", "0", "!", "▁", "中", "<|endoftext|>", "'s", "\x1c"]
    odd += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    return odd + [prose(rng, rng.randint(1, 400)) for _ in range(60)]


def test_equals_whole_text_encodings(spark, libraries):
    rows = list(enumerate(texts()))
    rows += [(900, None), (901, ""), (None, "no id"), (7, rows[7][1]), (7, rows[7][1])]
    got, totals = run(spark, [(i, t, "x", 1, "y") for i, t in rows])
    want, counts = plain(rows, libraries)
    assert got == want
    assert {(r.a, r.b): r.total for r in totals.collect()} == dict(counts)


def test_awkward_rows_and_empty_tables(spark, libraries):
    rows = awkward()
    found, _ = aligned(frame(spark, rows))
    got = sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
                  for r in found.collect()), key=str)
    assert got == plain([(r[0], r[1]) for r in rows], libraries)[0]
    nothing, totals = aligned(frame(spark, []))
    assert nothing.count() == 0 and totals.count() == 0


def test_partitions_and_blocks_do_not_matter(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, prose(rng, 40), "x", 1, "y") for i in range(80)] + [(100 + i, "same text of many", "x", 1, "y") for i in range(60)]
    assert run(spark, rows, 1)[0] == run(spark, rows, 7)[0]
