"""Small tables with the awkward cases that every operator must bear, and plain versions of shared definitions."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _n_tokens string, size string, token string"


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=400, tag=""):
    return " ".join(f"{tag}w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def awkward(seed=1):
    """Rows with nulls in every column, empty and long texts, ties, repeated rows, copies and clashing extra columns."""
    rng = random.Random(seed)
    texts = [None, "", " \n\t ", "one", "One two THREE", "é ü ß 日本", "a b c d e", "\n\n", prose(rng, 30_000)]
    base = prose(rng, 120)
    texts += [base, base, base.upper(), base + " more words here", prose(rng, 60) + "\nshared line of all\n" + prose(rng, 5)]
    texts += [prose(rng, 80) + "\n  Shared Line of ALL \nanother\n" for _ in range(12)]
    rows = [(i, text, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], None if text is None else len(text), "x", "y", "z")
            for i, text in enumerate(texts)]
    rows += [rows[9], rows[9], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows


def frame(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)
