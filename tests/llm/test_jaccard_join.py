import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, frame, lowered, prose, words

from pricelake import session
from pricelake.llm import jaccard_join as op
from pricelake.llm import spans


def shingles(text):
    own = words(lowered(text))
    return frozenset(tuple(own[i:i + 5]) for i in range(max(len(own) - 5, 0) + 1)) if own else frozenset()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if common and 100 * common >= 75 * (len(a) + len(b) - common):
                group[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return Counter((r[0], len(s), least.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def found(frame_):
    return Counter((r.doc, r.n_shingles, r.component_id) for r in op.near_duplicates(frame_).collect())


def edited(rng, text, share):
    return " ".join(f"new{rng.randrange(10 ** 6)}" if rng.random() < share else w for w in text.split(" "))


def corpus(seed, n):
    """Copies, near copies around the threshold, chains of edits, and a passage that many texts share."""
    rng = random.Random(seed)
    passage, texts = prose(rng, 40, tag="p"), []
    for i in range(n):
        base = prose(rng, rng.choice([3, 6, 20, 60, 150]), 5000)
        texts.append(base)
        for _ in range(rng.randrange(3)):
            base = edited(rng, base, rng.choice([0, 0.01, 0.03, 0.05, 0.06]))
            texts.append(base)
        if i % 3 == 0:
            texts.append(prose(rng, 15, 5000) + " " + passage + " " + prose(rng, 15, 5000))
    rng.shuffle(texts)
    return [(i * 7 % 1009, t, *[None] * 6) for i, t in enumerate(texts)]


def test_awkward_rows(spark):
    assert found(frame(spark, awkward())) == brute(awkward())


def test_random_corpus_in_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 4)
    monkeypatch.setattr(op, "CELL", 3)
    monkeypatch.setattr(op, "FAN_IN", 2)
    monkeypatch.setattr(op, "HELD", 500)
    rows = corpus(11, 120)
    assert found(frame(spark, rows, parts=4)) == brute(rows)


def test_empty_table(spark):
    assert found(frame(spark, [])) == Counter()


def test_bitmaps_never_rule_out_a_link():
    rng = random.Random(2)
    for _ in range(200):
        base = prose(rng, rng.randrange(5, 200), 3000)
        pair = [base, edited(rng, base, rng.choice([0.01, 0.04, 0.1]))]
        block = next(spans.blocks(pa.array(pair)))
        grams, firsts = op.shingle_sets(block)
        sets = [grams[firsts[i]:firsts[i + 1]] for i in (0, 1)]
        assert [len(s) for s in sets] == [len(shingles(t)) for t in pair]
        sizes = np.array([len(s) for s in sets])
        found_ = [list(op._tile_pairs(np.array([1, 2]), np.array(side), sizes, [op._signature(s) for s in sets])) for side in ([0, 0], [0, 1])]
        common = len(set(sets[0]) & set(sets[1]))
        if 100 * common >= 75 * (sizes.sum() - common):
            assert found_ == [[(0, 1)], [(0, 1)]]


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_components_of_chains(spark, n):
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a long, b long")
    found_ = {r.node: r.comp for r in op.components(links).collect()}
    assert found_ == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_a_small_cluster_sends_each_text_once(spark, monkeypatch):
    import pyarrow as pa

    def sent(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"a": batch.column(6), "b": batch.column(6)})

    texts = [(i, " ".join(f"w{i}x{j}" for j in range(8 + 3 * i))) for i in range(6)]
    sets = op.Sets(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text")
    shared = sets.nodes.selectExpr("1L as token", "node", "node as comp")
    monkeypatch.setattr(op, "_cell_work", sent)
    counts = sets.cell_links(shared).groupBy("a").count().collect()
    assert len(counts) == 6 and all(r["count"] == 1 for r in counts)


def test_bands_of_a_whole_cluster_miss_no_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.sort(rng.permutation(base)[:n]) for n in (3, 4, 30, 40, 300, 390, 395, 400)] + [np.sort(base[:k]) for k in (200, 260, 300)]
    size = np.array([len(x) for x in sets])
    passed = set(op._tile_pairs(np.arange(len(sets)), np.zeros(len(sets), int), size, [op._signature(x) for x in sets]))
    passed = {tuple(sorted(pair)) for pair in passed}
    linked = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if op._similar(sets[i], sets[j])}
    assert len(linked) > 5 and linked <= passed


def test_components_of_random_links_leave_one_table(spark, tmp_path, monkeypatch):
    """Against union-find, with self-links and both directions; tables of the levels are removed."""
    monkeypatch.setattr(op, "cut", lambda df, name: session.cut(df, name))
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    rng = random.Random(8)
    pairs = [(rng.randrange(400) * 7919 % 401, rng.randrange(400)) for _ in range(330)] + [(500, 500), (9, 3), (3, 9)]
    parent = {x: x for pair in pairs for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        one, two = root(a), root(b)
        parent[max(one, two)] = min(one, two)
    found = op.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.comp for r in found.collect()} == {x: root(x) for x in parent}
    left = [p.name for p in (tmp_path / "pricelake").glob("*/*")]
    assert left.count("labels") == 1 and left.count("edges") <= 1


def test_a_set_is_the_same_node_whatever_stands_before_it():
    rng = random.Random(4)
    texts = [prose(rng, 40, 5000) for _ in range(60)]
    ids = lambda rows: op.node_ids(*op.shingle_sets(next(spans.blocks(pa.array(rows)))))
    assert ids(texts).tolist() == [int(ids([t])[0]) for t in texts]
    assert ids(texts[::-1]).tolist() == ids(texts).tolist()[::-1]


def test_bounds_of_pairs_never_rule_out_a_link():
    rng, texts = random.Random(6), []
    for _ in range(150):
        base = prose(rng, rng.randrange(5, 300), 3000)
        texts += [base, edited(rng, base, rng.choice([0.01, 0.03, 0.05, 0.3]))]
    sets = list(op._sets(pa.array(texts)))
    size, bits = [len(x) for x in sets], [op._signature(x) for x in sets]
    pairs = [(i, i + 1) for i in range(0, 300, 2)] + [(rng.randrange(300), rng.randrange(300)) for _ in range(300)]
    a, b = (list(x) for x in zip(*pairs, strict=True))
    left = op._bounded(pa.RecordBatch.from_pydict({
        "a": a, "b": b, "n_a": [size[i] for i in a], "n_b": [size[i] for i in b],
        "bits_a": [bits[i] for i in a], "bits_b": [bits[i] for i in b]}))
    left = set(zip(left["a"].to_pylist(), left["b"].to_pylist(), strict=True))
    linked = {(i, j) for i, j in pairs if op._similar(sets[i], sets[j])}
    assert len(linked) > 40 and linked <= left and len(left) < len(linked) + 60


def test_a_large_cluster_sends_the_texts_of_possible_links_only(spark, monkeypatch):
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(12)]
    texts.append(texts[5] + " end")

    def sent(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"a": batch.column(6), "b": batch.column(6)})

    monkeypatch.setattr(op, "TILE", 3)
    sets = op.Sets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text")
    shared = sets.nodes.selectExpr("1L as token", "node", "node as comp")
    both = {r.node for r in sets.nodes.filter("doc in (5, 12)").collect()}
    assert {(r.a, r.b) for r in sets.cell_links(shared).collect()} == {(min(both), max(both))}
    monkeypatch.setattr(op, "_cell_work", sent)
    assert {r.a for r in sets.cell_links(shared).collect()} == both
