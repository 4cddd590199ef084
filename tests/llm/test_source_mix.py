from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward, frame, prose, words

from pricelake.llm import source_mix as op


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight; what is above a cap is shared again until none is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total, free = {}, sum(sizes.values()), set(names)
    while free:
        share = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] >= cap * sizes[s]}
        if not over:
            return {**target, **{s: share * weight[s] for s in free}}
        for s in over:
            target[s] = cap * sizes[s]
        free -= over
    return target


def check(rows, mixed):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    expected = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r["size"]) for r in mixed) == Counter((r[0], r[3], len(words(r[1]))) for r in rows)
    got, largest = defaultdict(int), defaultdict(int)
    for r in mixed:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source]) and 0 <= r.copies <= 3
        got[r.source] += r["size"] * r.copies
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(got[s] - expected[s]) <= largest[s]
    return got, expected


def test_awkward_rows(spark):
    check(awkward(), op.mix(frame(spark, awkward())).collect())
    assert op.mix(frame(spark, [])).count() == 0
    assert all(r.copies == 0 for r in op.mix(frame(spark, [(1, None, *[None] * 6), (2, " ", *[None] * 6)])).collect())


def test_many_blocks_come_near_and_agree(spark):
    import random

    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(1, 60)), None, rng.choice(["a", "b", "c", "d", "é", None]), *[None] * 4) for i in range(1500)]
    one = op.mix(frame(spark, rows, parts=3), block=64).collect()
    got, expected = check(rows, one)
    assert all(abs(got[s] - expected[s]) <= 5 for s in expected)
    two = op.mix(frame(spark, rows[::-1], parts=7), block=64).collect()
    assert Counter((r.doc_id, r.copies) for r in one) == Counter((r.doc_id, r.copies) for r in two)


def test_small_sources_are_capped(spark):
    rows = [(1, "w " * 10, None, "a", *[None] * 4), (2, "w " * 1000, None, "b", *[None] * 4), (3, "", None, "c", *[None] * 4)]
    mixed = {r.doc_id: r for r in op.mix(frame(spark, rows)).collect()}
    assert mixed[1].target == 30 and mixed[1].copies == 3 and mixed[2].target == 980 and mixed[3].target == 0


def test_flight_keeps_totals_and_inclusion():
    rng = np.random.default_rng(0)
    taken = np.zeros(30)
    size, p = rng.integers(1, 50, 30), rng.uniform(0.1, 0.9, 30)
    for _ in range(3000):
        q = op.flight(p, size, rng.random(70))
        assert abs(q.sum() - p.sum()) < 1e-6 and abs(q @ size - p @ size) < 1e-6 and ((q > 0) & (q < 1)).sum() <= 2
        taken += q
    assert np.abs(taken / 3000 - p).max() < 0.06
