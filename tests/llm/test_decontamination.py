import hashlib
import random
import re
from collections import Counter

import numpy as np
from helpers import awkward, frame, lowered, prose
from pyspark.sql import functions as F

from pricelake.llm import decontamination as op

OWN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items, window=10):
    own = OWN.findall(lowered(text))
    hit, names = set(), set()
    for name, content in items:
        target = OWN.findall(lowered(content))
        n = min(window, len(target))
        wins = {tuple(target[i:i + n]) for i in range(len(target) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                names |= {str(name)} - {"None"}
    return len(own), len(hit), sorted(names)


def cases():
    rng = random.Random(4)
    items = [(k, prose(rng, rng.choice([3, 9, 10, 11, 40]), 60)) for k in range(12)]
    items += [(20, None), (21, " .,"), (None, "one two"), (22, "One two"), (22, "three words here"), (23, items[4][1])]
    rows = awkward()
    for k in range(40):
        item = rng.choice(items[:12])[1].split(" ")
        cut = item[rng.randrange(3):]
        rows.append((100 + k, prose(rng, rng.randrange(30), 60) + " " + ", ".join(cut).upper() + "! " + prose(rng, 20, 60), *[None] * 6))
    return rows, items


def test_awkward_rows_against_brute_force(spark, monkeypatch):
    rows, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for part_bytes in (op.PART_BYTES, 400):
        docs = frame(spark, rows)
        got = docs.select("doc_id", "text", op.find_windows(F.col("text"), benchmark, part_bytes=part_bytes).alias("f")).select(
            "doc_id", "text", "f.*", op.n_hit(F.col("f.ranges")).alias("n_hit"), op.without_ranges(F.col("text"), F.col("f.ranges")).alias("left"))
        for r in got.collect():
            n, hit, names = brute(r.text, items)
            assert (r.n_words, r.n_hit, r["items"]) == (n, hit, names)
            assert (r.left is None) == (r.text is None)
            assert len(OWN.findall(lowered(r.left))) == n - hit or hit == 0


def test_small_shards_and_long_rows(monkeypatch):
    monkeypatch.setattr(op, "SHARD_WORDS", 37)
    import pyarrow as pa

    rng = random.Random(9)
    items = [(k, prose(rng, 25, 30)) for k in range(4)]
    texts = [prose(rng, 200, 30) + " " + items[k % 4][1] + " " + prose(rng, 50, 30) for k in range(6)] + ["", None]
    phrases = op.phrases_of([str(k) for k, _ in items], [t for _, t in items])
    made = op._find(pa.array(texts), phrases)
    for k, text in enumerate(texts):
        n, hit, names = brute(text, items)
        ranges = made["ranges"][k].as_py()
        assert (made["n_words"][k].as_py(), sum(r["last"] - r["first"] for r in ranges), made["items"][k].as_py()) == (n, hit, names)


def test_index_counts_and_locates_every_phrase():
    rng = np.random.default_rng(3)
    for size in (3, 5, 40):
        text = rng.integers(1, size, 500)
        index = op.FmIndex(text, size)
        for length in (1, 2, 4, 9):
            starts = rng.integers(0, 500 - length, 20)
            phrases = np.stack([text[s:s + length] for s in starts])
            low, high = index.search(phrases, np.full(20, length))
            for phrase, a, b in zip(phrases, low, high, strict=True):
                expected = [i for i in range(501 - length) if (text[i:i + length] == phrase).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_empty_tables_and_query(spark, tmp_path):
    rows, items = cases()
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.f["items"] for r in frame(spark, rows).select(op.find_windows(F.col("text"), nothing).alias("f")).collect())
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                  for r in op.op10_decontamination(spark, str(tmp_path)).collect())
    expected = Counter()
    for r in rows:
        n, hit, names = brute(r[1], items)
        expected[(r[0], n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0)] += 1
    assert got == expected
