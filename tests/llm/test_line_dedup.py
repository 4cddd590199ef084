import hashlib
import random
from collections import Counter

import pytest
from helpers import awkward, frame, lowered

from pricelake.llm import line_dedup as op

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, least, keep_first=False):
    key = lambda line: lowered(line.strip(BLANKS))
    held = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    first = {}
    for r in rows:
        for i, x in enumerate((r[1] or "").split("\n")):
            place = (r[0] is not None, r[0] or 0, i)
            first[key(x)] = min(first.get(key(x), place), place)
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for i, x in enumerate(lines) if not (key(x) and held[key(x)] >= least) or (
            keep_first and first[key(x)] == (r[0] is not None, r[0] or 0, i))]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def found(frame_, **options):
    rows = op.drop_repeated_lines(frame_, **options).select("doc_id", "_lines.*").collect()
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("broadcast_lines", [op.BROADCAST_LINES, 0])
def test_awkward_rows(spark, keep_first, broadcast_lines):
    rows = awkward()
    got = found(frame(spark, rows), least=3, keep_first=keep_first, broadcast_lines=broadcast_lines)
    assert got == brute(rows, 3, keep_first)


def test_filters_merge_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(op, "FAN_IN", 3)
    rng = random.Random(5)
    rows = [(i, "\n".join(f"line {rng.randrange(60)}" for _ in range(4)), *[None] * 6) for i in range(120)]
    assert found(frame(spark, rows, parts=11), least=10) == brute(rows, 10)


def test_empty_table_and_least(spark):
    assert op.drop_repeated_lines(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        op.drop_repeated_lines(frame(spark, []), least=1)


def test_digest_column(spark, tmp_path):
    frame(spark, awkward()).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op.op8_line_dedup(spark, str(tmp_path)).collect()
    expected = Counter((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for (d, n, k, t), c in brute(awkward(), 10).items() for _ in range(c))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows) == expected
