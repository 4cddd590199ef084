import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, frame, lowered, prose, words

from pricelake.llm import language_model as op
from pricelake.llm import spans


def corpus():
    rng = random.Random(2)
    texts = awkward()
    for i in range(250):
        topic = f"t{i % 4}"
        texts.append((1000 + i, prose(rng, rng.randrange(5, 150), 120, topic) + rng.choice(["", " Rare" + str(rng.random())]), *[None] * 6))
    return texts


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("model")
    frame(spark, corpus()).write.parquet(str(folder / "documents.parquet"))
    return op.op7_language_model(spark, str(folder)).collect()


def test_base_counts_are_exact(scored):
    rows = corpus()
    counts = Counter()
    for r in rows:
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10:
            counts.update(words(lowered(r[1])) + [None])
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for r in rows:
        own = words(lowered(r[1])) + [None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        held = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0
        expected[(r[0], held, len(own), sum(counts[w] > 0 for w in own), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored) == expected


def test_mixed_model_beats_the_base_on_held_out_texts(scored):
    held = [r for r in scored if r.held_out and (r.doc_id or 0) >= 1000]
    assert len(held) > 15 and all(r.score < 0 for r in scored)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    empty = [r for r in scored if r.n_tokens == 1 and r.bits_per_byte is None]
    assert len(empty) >= 3


def small_model(texts):
    column = pa.array(texts)
    hashed, letters = [], np.zeros(256)
    for block in spans.blocks(column):
        tokens = op.Tokens(block)
        hashed.append(tokens.hash)
        letters += np.bincount(tokens.data, minlength=256)
    names, n = np.unique(np.concatenate(hashed), return_counts=True)
    model = op.model_of(names[n > 1], n[n > 1], letters, int(n.sum()), len(names))
    counts = np.zeros(2 * (op.WORD_SLOTS + op.BYTE_SLOTS), np.uint32)
    for block in spans.blocks(column):
        op._fill(counts, op.Bits(op.Tokens(block), model))
    counts = counts.reshape(-1, 2).astype(float)
    model.slots = op.trusted(counts[:, 0], counts[:, 1])
    return model, names[n > 1]


def test_probabilities_of_the_next_word_sum_to_one():
    """Over all hot words, the end and the announcement of a spelled word, after the same beginning."""
    rng = random.Random(1)
    texts = [prose(rng, 60, 40) for _ in range(30)]
    model, _ = small_model(texts)
    beginning = " ".join(texts[0].split(" ")[:5])
    total = 0.0
    for word in [*sorted({w for t in texts for w in t.split(" ")}), "", "neverseen"]:
        tokens = op.Tokens(next(spans.blocks(pa.array([f"{beginning} {word}".strip()]))))
        bits = op.Bits(tokens, model)
        if bits.known[5]:
            total += 10 ** op.log_probabilities(bits, tokens, model)[5]
        elif word == "neverseen":   # without its letters
            bits.bit, bits.logit, bits.token = bits.bit[:bits.n_words], bits.logit[:bits.n_words], bits.token[:bits.n_words]
            bits.slots = [s[:bits.n_words] for s in bits.slots]
            total += 10 ** op.log_probabilities(bits, tokens, model)[5]
    assert 0.99 < total < 1 + 1e-6     # unused codes keep a little


def test_codes_are_prefix_free():
    counts = np.random.default_rng(0).integers(1, 1000, 300)
    code = op.Code.of(counts, 64)
    paths = {tuple(code.bit[code.first[i]:code.first[i + 1]]) for i in range(300)}
    assert len(paths) == 300
    assert all(p[:k] not in paths for p in paths for k in range(1, len(p)))
    cut = op.Code.of(counts, 5)
    shares = [np.log10(1 / (1 + np.exp(np.where(cut.bit[a:b] == 1, -1, 1) * cut.logit[a:b]))).sum() for a, b in zip(cut.first[:-1], cut.first[1:], strict=True)]
    assert np.allclose(10 ** (np.array(shares) + cut.rest), counts / counts.sum(), rtol=0.01)


def test_tables_merge_over_many_tasks(spark, monkeypatch):
    rows = [(r[1],) for r in corpus()[20:]]
    texts = spark.createDataFrame(rows, "text string")
    model, _ = op.fit(texts.repartition(9))
    monkeypatch.setattr(op, "FAN_IN", 2)
    again, _ = op.fit(texts.repartition(9))
    assert np.array_equal(model.slots, again.slots)


def test_empty_table(spark):
    nothing = frame(spark, [])
    model, counts = op.fit(nothing.select("text"))
    assert op.score(nothing, "text", model, counts).count() == 0 and model.total == 0


def plain_scores(text, model):
    """log10 probability of each token of one text, a bit at a time."""
    tokens = op.Tokens(next(spans.blocks(pa.array([text]))))
    bits = op.Bits(tokens, model)
    starts = sorted({0, *op.EARLY, *range(0, len(tokens.hash), op.STRIDE)})
    weights, moved = model.gates.weights.astype(float).copy(), np.zeros((2, op.KNOTS))
    found = model.words.rest[bits.leaf].copy()
    for low, high in zip(starts, [*starts[1:], len(tokens.hash)], strict=True):
        changes = {}
        for i in np.flatnonzero((bits.token >= low) & (bits.token < high)):
            part = int(i >= bits.n_words)
            seen = [int(model.slots[s[i]]) for s in bits.slots]
            gate = part * 25 + (seen[0] & 7) * 5 + (seen[1] & 7)
            x = np.array([bits.logit[i], (seen[0] >> 3) / 256, (seen[1] >> 3) / 256])
            place = np.clip(weights[gate] @ x, -op.CERTAIN, op.CERTAIN) / op.KNOT + op.KNOTS // 2
            knot, beyond = int(place), place - int(place)
            refined = model.gates.refined[gate]
            logit = refined[knot] * (1 - beyond) + refined[knot + 1] * beyond + moved[part, knot]
            p = 1 / (1 + math.exp(-min(max(logit, -16), 16)))
            found[bits.token[i]] += math.log10(p if bits.bit[i] else 1 - p)
            for key, change in ((gate, (bits.bit[i] - p) * x), ((part, knot), bits.bit[i] - p)):
                total, n = changes.get(key, (0, 0))
                changes[key] = total + change, n + 1
        for key, (total, n) in changes.items():
            if isinstance(key, tuple):
                moved[key] += op.REFINING_RATE * total / math.sqrt(n)
            else:
                weights[key] += op.RATE * total / math.sqrt(n)
    return found


def test_scores_are_those_of_a_plain_version(spark):
    """Texts shorter and longer than a stride, alone and beside others, with weights and refinements of `fit`."""
    rng = random.Random(4)
    texts = [prose(rng, n, 60, tag) + " Odd" + str(n) for n in (3, 20, 60, 150, 400) for tag in ("", "q")]
    model, _ = op.fit(spark.createDataFrame([(t,) for t in texts * 2], "text string"))
    tokens = op.Tokens(next(spans.blocks(pa.array(texts))))
    scores = op.log_probabilities(op.Bits(tokens, model), tokens, model)
    for row, text in enumerate(texts):
        own = scores[tokens.first[row]:tokens.first[row + 1]]
        assert np.allclose(own, plain_scores(text, model), rtol=1e-3, atol=2e-3)


def test_weights_move_inside_a_text_of_fewer_words_than_a_stride():
    rng = random.Random(1)
    model, _ = small_model([prose(rng, 60, 40) for _ in range(30)])
    text = " ".join(["w0 w39"] * 30)
    tokens = op.Tokens(next(spans.blocks(pa.array([text]))))
    moved = op.log_probabilities(op.Bits(tokens, model), tokens, model)
    assert len(tokens.hash) < op.STRIDE and moved[48:60].sum() > moved[8:20].sum() and moved[40:60].sum() > moved[10:30].sum()


def test_gates_are_learned_from_the_table():
    """Bits drawn from known weights give these weights back, and a miscalibrated logit is refined."""
    rng = np.random.default_rng(0)
    shape = (2, op.CLASSES, op.LEVELS, op.CLASSES, op.LEVELS, op.LEVELS)
    true, table = np.array([0.3, 0.9, -0.2]), np.zeros((*shape, 2))
    level = rng.integers(5, 12, (200_000, 3))
    x = (level - op.LEVELS // 2) * op.LEVEL
    ones = rng.random(len(x)) < 1 / (1 + np.exp(-x @ true))
    np.add.at(table, (0, 3, level[:, 1], 2, level[:, 2], level[:, 0], ones.astype(int)), 1)
    table[1, 0, op.LEVELS // 2, 0, op.LEVELS // 2, op.LEVELS // 2] = 1000, 9000  # of logit 0 nine tenths are set
    gates = op.learned(table.reshape(-1, 2))
    assert np.allclose(gates.weights[3 * op.CLASSES + 2], true, atol=0.05)
    assert abs(gates.refined[op.CLASSES ** 2, op.KNOTS // 2] - math.log(9)) < 0.05
    assert np.array_equal(gates.weights[7], op.untrained().weights[7])


def test_learned_gates_predict_held_out_texts_better(spark):
    rng = random.Random(5)
    texts = [" ".join(f"{'ab'[i % 2]}{int(30 * rng.random() ** 2)}" for i in range(120)) for _ in range(150)]
    model, _ = op.fit(spark.createDataFrame([(t,) for t in texts[:120]], "text string"))
    tokens = op.Tokens(next(spans.blocks(pa.array(texts[120:]))))
    bits = op.Bits(tokens, model)
    learned = op.log_probabilities(bits, tokens, model).sum()
    model.gates = None
    assert learned > op.log_probabilities(bits, tokens, model).sum()
