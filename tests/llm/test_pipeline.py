import random
from collections import Counter

import pytest
from helpers import awkward, frame, prose, words

import corpus_pipeline
from pricelake.llm import decontamination, source_mix

SHARED = "this line stands in very many of the texts here"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean texts, junk, a line of all, copies, near copies and benchmark passages, and the awkward rows."""
    rng, rows, labels = random.Random(3), [], []
    item = prose(rng, 30, 900, "b")
    for i in range(300):
        text = prose(rng, rng.randrange(60, 120), 3000)
        kind = ("clean", "junk", "line", "copy", "near", "leak")[i % 6]
        if kind == "junk":
            text = text.upper().replace(" ", "!! ")
        elif kind == "line":
            text = text + "\n" + SHARED + "\n" + prose(rng, 20, 3000)
        elif kind == "copy" and rows:
            text = rows[-3][1]
        elif kind == "near" and rows:
            text = rows[-4][1] + " onemore"
        elif kind == "leak":
            text = text + " " + item + " " + prose(rng, 10, 3000)
        rows.append((1000 + i, text, "en", f"s{i % 4}", len(text)))
        if i % 7:
            labels.append((1000 + i, int(kind != "junk"), 0))
    rows += [r[:5] for r in awkward()]
    path = tmp_path_factory.mktemp("pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame(spark, rows, schema).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), rows


def test_stages_one_by_one(spark, folder, tmp_path):
    path, rows = folder
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, path)
        made.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = docs.collect()
        if k < 4:
            assert docs.columns == columns
    texts = {r[0]: r[1] for r in rows}
    quality = {r.doc_id for r in seen["quality classifier"]}
    assert not [i for i in range(1001, 1300, 6) if i in quality]
    assert sum(i in quality for i in range(1000, 1300, 6)) >= 49
    assert Counter(r.text for r in seen["quality classifier"]) <= Counter(r[1] for r in rows)
    lines = {r.doc_id: r for r in seen["line dedup"]}
    assert len(seen["line dedup"]) == len(seen["quality classifier"])
    assert not [r for r in seen["line dedup"] if r.text and SHARED in r.text]
    assert all(r.n_chars == len(r.text) for r in seen["line dedup"] if (r.doc_id or 0) >= 1000)
    assert all(lines[i].text == texts[i] for i in range(1000, 1300, 6) if i in lines)
    near = {r.doc_id for r in seen["near duplicates"]}
    assert not [i for i in (*range(1003, 1300, 6), *range(1004, 1300, 6)) if i in near and i >= 1006]
    assert {i for i in range(1000, 1300, 6) if i in lines} <= near
    clean = {r.doc_id: r for r in seen["benchmark decontamination"]}
    assert set(clean) == near
    item = spark.read.parquet(f"{path}/benchmark.parquet").first().text
    window = " ".join(item.split(" ")[:10])
    assert not [r for r in clean.values() if r.text and window in r.text]
    assert all(set(words(clean[i].text)) < set(words(texts[i])) for i in range(1005, 1300, 6) if i in clean)
    assert all(clean[i].text == lines[i].text for i in range(1000, 1300, 6) if i in clean)
    mix = seen["source mix"]
    assert Counter(r.doc_id for r in mix) == Counter(r.doc_id for r in seen["benchmark decontamination"])
    per = Counter()
    for r in mix:
        per[r.source] += r["size"] * r.copies
    assert all(abs(per[r.source] - r.target) <= max(m["size"] for m in mix) for r in mix)


def test_run_agrees_with_itself(spark, folder):
    path, _ = folder
    one, two = (Counter((r.doc_id, r.source, r["size"], r.copies) for r in corpus_pipeline.run(spark, path).collect()) for _ in range(2))
    assert one == two and sum(one.values()) > 100


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_an_id_with_several_texts_is_judged_by_text(spark, tmp_path):
    import random

    rng = random.Random(3)
    one, two = prose(rng, 80), prose(rng, 80)
    rows = [(3, two, "en", "a", 1), (5, one, "en", "a", 1), (5, two, "en", "a", 1), (5, two, "en", "b", 1), (None, one, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_copies(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, two), (5, one)]


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "near duplicates", "benchmark decontamination", "source mix"]
    assert decontamination.WINDOW == 10 and source_mix.MOST_COPIES == 3
