import random

import pytest
from helpers import awkward, frame
from pyspark.sql import functions as F

from pricelake.llm import token_counts as op

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def reference(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(library):
    rng = random.Random(3)
    signs = "aeiouthns'\"!.,#1234éÉüß<|>日 İΣ́ \t\n\x00\x1c\x85 "
    texts = ["<|endoftext|>a<|startoftext|>b <|EndOfText|> <|endof", "it's we'll I'LL 'r 'rex x'", "a" * 300, "ab" * 400 + "!" * 90]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice("thensaoir") for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    counter = op.counter(PATH)
    assert [int(counter.text(t)[1][-1]) for t in texts] == [reference(library, t) for t in texts]


def test_counts_at_every_prefix(library):
    counter = op.counter(PATH)
    for word in ("internationalisation", "unbelievable", "zzzzzz", "thethethe", "pneumonoultramicroscopic"):
        expected = [reference(library, word[:k]) for k in range(len(word) + 1)]
        assert counter.prefix_counts(word) == expected


def test_awkward_rows_and_cuts(spark, library):
    rows = awkward()
    found = frame(spark, rows).select("doc_id", "text", op.token_counts(F.col("text"), limit=40).alias("c")).collect()
    assert len(found) == len(rows)
    for row in found:
        text = row.text or ""
        assert row.c.n_bytes == len(text.encode()) and row.c.n_tokens == reference(library, text)
        assert row.c.cut_tokens == reference(library, text[:row.c.cut_at]) <= 40
        if row.c.cut_at < len(text):
            rest = text[row.c.cut_at:].lstrip(" \n")
            longer = text[:len(text) - len(rest)] + rest.replace("\n", " ").split(" ")[0]
            assert reference(library, longer) > 40


def test_limits_inside_words_give_the_longest_prefix(spark, library):
    rng = random.Random(5)
    signs = "aeiouthns'\"!.,#1234éÉüß<|>日本語の文İΣ" + "e\u0301o\u0302\u0323" + "\u1112\u1161\u11ab" + "\t\x85 \n"
    texts = ["日本語の文章を書く" * 40, "internationalisation" * 30, "ab!!<|endoftext|>cd<|endoftext|><|endof", "it's we'll I'LL don't'll",
             "a" * 300, "e\u0301" * 60 + "o\u0302\u0323" * 50, "\u1112\u1161\u11ab" * 50, "!'s!<|endoftext|>'re", "one two  three four"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 50))) for _ in range(300)]
    limits = (0, 1, 2, 3, 5, 8, 13, 40)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r for r in rows.select("doc_id", *(op.token_counts(F.col("text"), limit=n).alias(f"c{n}") for n in limits)).collect()}
    table = {r.doc_id: r for r in op.prefix_table(rows, "doc_id", inside=True).select(
        "doc_id", "counts", op.points_within(F.col("counts"), 5).alias("n")).collect()}
    for i, text in enumerate(texts):
        counts = [reference(library, text[:k]) for k in range(len(text) + 1)]
        assert table[i].counts == counts
        for n in limits:
            longest = max(k for k, c in enumerate(counts) if c <= n)
            assert (found[i][f"c{n}"].cut_at, found[i][f"c{n}"].cut_tokens) == (longest, counts[longest])
        assert table[i].n == max(k for k, c in enumerate(counts) if c <= 5)


def test_budgets_are_read_off_the_prefix_table(spark):
    rows = frame(spark, [(1, "one two three four five", *[None] * 6), (2, None, *[None] * 6)])
    found = op.prefix_table(rows, "doc_id").select("doc_id", "counts", op.words_within(F.col("counts"), 3).alias("n")).collect()
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].counts == [0, 1, 2, 3, 4, 5] and by_id[1].n == 3 and by_id[2].counts == [0, 0]
    assert frame(spark, []).select(op.token_counts(F.col("text"))).count() == 0
