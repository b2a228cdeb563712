"""op11: threshold joins and the mined negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import hard_negatives as hn


@pytest.mark.parametrize("floor", [-5_000_000, 0, 20_000, 200_000, 1_000_000])
def test_threshold_join(floor):
    rng = np.random.default_rng(abs(floor) % 97)
    rows = np.floor(256 * rng.normal(size=(700, 20)) * np.linspace(2, 0.05, 20))
    anchors = np.concatenate([rows[:30], np.zeros((1, 20))])
    floors = np.full(31, floor) + rng.integers(0, 1000, 31)
    meets = rng.random((31, 700)) < 0.7
    got = set(zip(*(x.tolist() for x in hn.join(rows, anchors, floors, meets))))
    full = anchors @ rows.T
    want = {(i, j, int(full[i, j])) for i, j in zip(*np.nonzero(meets & (full >= floors[:, None])))}
    assert got == want


def test_rows_below_every_threshold_have_no_postings():
    y = hn.Side(np.array([[3.0, 4.0], [300.0, 400.0]]), np.array([0, 1]))
    assert np.allclose(y.norm, [[5, 0], [500, 0]])
    got = hn.threshold_join(np.array([[3.0, 4.0], [300.0, 400.0]]), np.array([[300.0, 400.0]]), np.array([100_000]), np.ones((1, 2), bool))
    assert [x.tolist() for x in got] == [[0], [1], [250_000]]


def _rows(n=420, d=12):
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(4, d))
    rows = []
    for i in range(n):
        v = (middle[rng.integers(0, 4)] * rng.uniform(0.2, 1) + rng.normal(size=d) * 0.5) * 0.3
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))))
    rows += [(1000 + i, rows[20][1], 1 + i % 2) for i in range(60)]  # ties
    rows += [(2000, None, 1), (2050, [0.1, None] * 6, 1), (2100, [float("nan")] * d, 0), (2150, [0.0] * d, 1), (2200, [], 1),
             (2250, [0.2] * d, None), (None, rows[0][1], 0), (2300, [0.5, 0.5, 0.5], 1), (2301, [0.9, 0.1, 0.2], 1),
             (2302, [0.4, 0.3, 0.3], 2), (2350, [0.3] * d, 9), (50, rows[50][1], rows[50][2]), (100, rows[7][1], 2),
             (2400, [1e16] * d, 1), (2401, [1e16] * (d - 1) + [-1e30], 1), (2402, [9e15] * d, 2), (2450, [1e308] * d, 7)]
    return rows


def _brute(rows, positives=5, negatives=3):
    ok = []
    for n, (i, v, label) in enumerate(rows):
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        top = 1.7976931348623157e308
        ok.append((n, i, label, [math.floor(min(max(256.0 * x, -top), top)) for x in v]))
    out = []
    for n, i, label, v in ok:
        if i % 50:
            continue
        score = [(min(max(sum(a * b for a, b in zip(v, w)), hn.LOW), hn.HIGH), j, m, lab) for m, j, lab, w in ok
                 if len(w) == len(v) and m != n]
        for p, pid, *_ in sorted((s for s in score if s[3] == label), key=lambda s: (-s[0], s[1]))[:positives]:
            inside = sorted((s for s in score if s[3] != label and 50 * p <= 100 * s[0] <= 95 * p), key=lambda s: (-s[0], s[1]))
            out += [(i, pid, rank + 1, s[1], p, s[0]) for rank, s in enumerate(inside[:negatives])]
    return sorted(out)


def _got(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                  for r in df.collect())


def test_mine(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 4)
    rows = _rows()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr(
        "*", "1 as id", "2 as row", "3 as anchor", "4 as v", "5 as rank").repartition(5)
    want = _brute(rows)
    assert _got(hn.mine(df, F.col("vec_id") % 50 == 0)) == want and len(want) > 60


def test_few_rows(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    rows = [(0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.7, 0.4], 2), (3, [-1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, schema)
    floats = [(r.vec_id, list(r.embedding), r.label) for r in df.collect()]
    assert _got(hn.mine(df, F.col("vec_id") % 50 == 0)) == _brute(floats) != []
    assert hn.mine(df, F.col("vec_id") < 0).count() == 0
    assert hn.mine(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
