import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, frame, prose, words

from pricelake.llm import outlier_rules as op


def base(text):
    own = words(text)
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(own), sum(map(len, own)), symbols, lines, len(covered), len(own) < 50 or 100 * len(covered) > 50 * len(own)


def corpus(seed=3, n=260):
    rng, rows = random.Random(seed), []
    for i in range(n):
        text = prose(rng, rng.randrange(60, 300), 3000)
        if i % 13 == 0:
            text = " | ".join(text.split(" "))
        elif i % 17 == 0:
            text = text + "\n" + "\n".join([text[:200]] * 2)
        rows.append((i, text, ("en", "fr")[i % 2], ("a", "b", None)[i % 3 % 2 if i % 2 else 0], *[None] * 4))
    return rows


def mcd_by_numpy(x, floors):
    """The same search for one group, with exact ranks of the same bins."""
    def estimate(d):
        bins = np.round(np.log(d + 1e-6) * op.BINS)
        order = np.unique(bins)
        before = np.array([(bins < b).sum() for b in order])
        near = np.isin(bins, order[before < op.SUBSET * len(x)])
        cov = np.cov(x[near].T, bias=True) + np.diag(np.square(floors)) / op.correction()
        return x[near].mean(0), cov

    def distance(mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    middle = np.median(x, 0)
    z = np.abs(x - middle) / np.maximum(1.4826 * np.median(np.abs(x - middle), 0), floors)
    states = [estimate(d) for d in ((z ** 2).sum(1), z.sum(1) ** 2, z.max(1) ** 2)]
    for _ in range(op.STEPS):
        fresh = [estimate(distance(*s)) for s in states]
        moved = any(np.linalg.slogdet(f[1])[1] / 2 < np.linalg.slogdet(s[1])[1] / 2 - 1e-3 for f, s in zip(fresh, states, strict=True))
        states = fresh
        if not moved:
            break
    mean, cov = min(states, key=lambda s: np.linalg.slogdet(s[1])[1])
    return np.sqrt(distance(mean, cov) / op.correction())


def test_statistics_of_awkward_rows(spark):
    rows = awkward()
    got = op.judged(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter(
        (r[0], *base(r[1])) for r in rows)
    assert all(not r.kept for r in got if r.base_failed) and "text" not in got[0].asDict()
    assert op.judged(frame(spark, [])).count() == 0


def test_distances_against_numpy(spark):
    rows = corpus()
    got = {r.doc_id: r for r in op.judged(frame(spark, rows)).collect()}
    assert all(base(r[1])[:5] == (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words)
               for r in rows for g in [got[r[0]]])
    groups = {}
    for r in rows:
        if not got[r[0]].base_failed:
            groups.setdefault((r[2], r[3]), []).append(r)
    tested = 0
    for own in groups.values():
        if len(own) < op.LEAST_ROWS:
            continue
        stats = np.array([base(r[1])[:5] for r in own], float)
        n_lines = np.array([sum(bool(words(x)) for x in r[1].split("\n")) for r in own])
        n, chars, symbols, dup, repeats = stats.T
        x = np.stack([np.log1p(n), np.log(chars / n), np.log1p(100 * symbols / chars), np.log1p(20 * dup / n_lines), repeats / n], 1)
        x = np.floor(x * op.GRID + 0.5) / op.GRID
        expected = mcd_by_numpy(x, np.array(op.FLOORS))
        assert np.allclose([got[r[0]].distance for r in own], expected, rtol=1e-6, atol=1e-9)
        tested += 1
    assert tested >= 2
    junk = [got[r[0]].kept for r in rows if r[0] % 13 == 0 and got[r[0]].distance is not None]
    clean = [got[r[0]].kept for r in rows if r[0] % 13 and r[0] % 17]
    assert len(junk) > 10 and sum(junk) == 0 and np.mean(clean) > 0.97


def test_each_statistic_rejects_alone(spark):
    rng = random.Random(7)
    texts = [prose(rng, rng.randrange(60, 300), 3000) for _ in range(200)]
    own = [f"x{i:03}" for i in range(200)]
    lines = [own[i] for i in [*range(33), *range(27)]]
    rng.shuffle(lines)
    far = {"size": " ".join(f"w{i % 97}{i}"[:4] + chr(97 + i % 26) for i in range(9000)), "length": " ".join(w * 4 for w in own[:120]),
           "symbols": " ".join(w + "#" * (i % 6 == 0) for i, w in enumerate(own)), "repeats": " ".join(own[:85] + own[60:85]),
           "lines": "\n".join(lines)}
    assert 0.4 < base(far["repeats"])[4] / 110 < 0.5 and base(far["lines"])[3:5] == (27, 0) and not any(base(t)[5] for t in far.values())
    rows = [(i, t, "en", "a", *[None] * 4) for i, t in enumerate([*texts, *far.values()])]
    kept = {r.doc_id: r.kept for r in op.judged(frame(spark, rows)).collect()}
    assert np.mean([kept[i] for i in range(200)]) > 0.97
    assert {name: kept[200 + i] for i, name in enumerate(far)} == dict.fromkeys(far, False)


def test_chi_square():
    assert op.chi_square_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-4)
    assert op.chi_square_quantile(0.75, 5) == pytest.approx(6.62568, abs=1e-4)
    assert op.chi_square(2.0, 2) == pytest.approx(1 - math.exp(-1), abs=1e-12)


def test_main_path_is_native(spark, tmp_path):
    frame(spark, corpus(n=80)).write.parquet(str(tmp_path / "documents.parquet"))
    plan = op.op2_outlier_rules(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
