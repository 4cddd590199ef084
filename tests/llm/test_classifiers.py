import random
import zlib

import pytest
from helpers import awkward, frame
from pyspark.sql import functions as F

from pricelake.llm import language_id, quality_classifier, toxicity

SYLLABLES = {"aa": "ka lo mi ne tu ra".split(), "bb": "sch ung eit ver ber ein".split(), "cc": "tion ment eur que oir aux".split()}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def crc(i, parts):
    return zlib.crc32(str(i).encode()) % parts


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    """Three languages, junk in a fifth of the texts, insults in a fifth, some of them misspelled; labels for most."""
    rng, docs, labels = random.Random(8), [], []
    for i in range(600):
        lang = ("aa", "bb", "cc")[i % 3]
        text = text_of(rng, lang, rng.randrange(10, 80))
        junk, toxic = i % 5 == 1, i % 5 == 2
        if junk:
            text = " | ".join(text.split(" ")) if i % 2 else text.upper().replace(" ", "!! ")
        if toxic:
            own = text.split(" ")
            for _ in range(2):
                own.insert(rng.randrange(len(own)), rng.choice(["grumpfi", "wobbelzot", "krakzeug"]))
            text = " ".join(own)
        docs.append((i, text, lang, "s", len(text)))
        if i % 10:
            labels.append((i, int(not junk), int(toxic)))
    docs += [r[:5] for r in awkward()[:4]]
    docs += [(900, "123 .. 45", None, None, None), (901, "z", None, None, None), (None, "ka lo", "aa", None, None)]
    labels += [(None, 1, 1), (3, None, None)]
    folder = tmp_path_factory.mktemp("classifiers")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder), docs, {r[0]: r for r in labels}


def test_language(spark, corpus):
    folder, docs, _ = corpus
    rows = language_id.op4_language_id(spark, folder).collect()
    assert len(rows) == len(docs)
    langs = {r[0]: r[2] for r in docs if r[0] is not None and r[2]}
    assert all(r.held_out == (r.doc_id is not None and crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and 4 <= (r.doc_id or 0) < 600]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)
    by_id = {r.doc_id: r.lang_pred for r in rows if r.doc_id and r.doc_id >= 900}
    assert by_id[900] == "und" and by_id[901] in langs.values()
    assert {r.lang_pred for r in rows} >= {"und", *SYLLABLES}


def test_language_of_awkward_rows_without_training(spark):
    rows = frame(spark, awkward()).drop("lang").withColumn("lang", F.lit(None).cast("string"))
    found = rows.select(language_id.identifier(spark, language_id.fit(rows))(F.col("text")).alias("f")).collect()
    assert len(found) == len(awkward()) and all(r.f.nearest == "und" and r.f.score == 0 for r in found)


def test_distance_rejects(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 600")
    identify = language_id.identifier(spark, language_id.fit(docs))
    strange = spark.createDataFrame([("zzzyx wwvx jjj pfpf xyxyx " * 4,), (text_of(random.Random(1), "bb", 40),)], "text string")
    assert [r.f.lang for r in strange.select(identify(F.col("text")).alias("f")).collect()] == ["und", "bb"]


def accuracy(rows, labels, column, parts, chosen):
    held = [r for r in rows if r.doc_id in labels and labels[r.doc_id][column] is not None and crc(r.doc_id, parts) == chosen]
    assert len(held) > 50 and all(r.held_out for r in held)
    return sum(r.predicted == labels[r.doc_id][column] for r in held) / len(held)


def test_quality(spark, corpus):
    folder, docs, labels = corpus
    rows = quality_classifier.op9_quality_classifier(spark, folder).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert accuracy(rows, labels, 1, 4, 2) >= 0.97


def test_toxicity(spark, corpus):
    folder, docs, labels = corpus
    rows = toxicity.op6_toxicity(spark, folder).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert accuracy(rows, labels, 2, 3, 1) >= 0.97


def test_toxicity_bears_inserted_letters(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    score = toxicity.scorer(spark, toxicity.fit(spark.read.parquet(f"{folder}/labels.parquet"), docs))
    lines = ["ka lo wobxbelzot mi", "ka w o b b e l z o t mi", "ka lo grummpfi ne", "ka lo mi ne tura", "", None]
    found = [r.s for r in spark.createDataFrame([(x,) for x in lines], "text string").select(score(F.col("text")).alias("s")).collect()]
    assert min(found[:3]) > 0.5 > max(found[3:])


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_no_labels_and_empty_tables(spark, module):
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, awkward())
    if module is toxicity:
        score = module.scorer(spark, module.fit(nothing, docs))
        assert {r.s for r in docs.select(score(F.col("text")).alias("s")).collect()} == {0.0}
    else:
        score = module.scorer(spark, *module.fit(nothing, docs, "quality"))
        assert {r.s for r in docs.select(score(F.col("text")).alias("s")).collect()} == {0.5}
    assert frame(spark, []).select(score(F.col("text"))).count() == 0
    one = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (None, 1, 0)], nothing.schema)
    fitted = module.fit(one, docs) if module is toxicity else module.fit(one, docs, "quality")
    score = module.scorer(spark, fitted) if module is toxicity else module.scorer(spark, *fitted)
    assert all(0 <= r.s <= 1 for r in docs.select(score(F.col("text")).alias("s")).collect())


def test_leader_learns_a_rule():
    import numpy as np

    rng = np.random.default_rng(1)
    examples = []
    for _ in range(400):
        at = rng.choice(50, 6, replace=False)
        examples.append((np.append(at, 1 << quality_classifier.BITS), np.append(np.full(6, 2.0), 1.0), float((at < 5).any())))
    weights, bias = quality_classifier.follow_leader(examples)
    right = [(quality_classifier.logistic(weights[at[:-1]].sum() * 2 + bias) > 0.5) == label for at, _, label in examples]
    assert np.mean(right) > 0.95
