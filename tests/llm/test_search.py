"""op3, op10: against brute force; op3 also on ties and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import ann, topk


def _vectors(spark, seed=3, n=300, d=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * 0.2
    x[50:90] = x[10]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [float("nan")] * d), (1002, [None] + [0.5] * (d - 1)), (1003, []), (None, x[0].tolist()),
             (1004, [0.0] * d), (1005, [float("inf")] * d), (7, x[7].tolist()), (1100, [0.1, 0.2, 0.3])]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("id", F.lit(0)), rows


def _usable(rows, zero_ok):
    out = []
    for i, v in rows:
        if i is None or not v or any(c is None or not np.isfinite(c) for c in v) or (not zero_ok and not any(v)):
            continue
        out.append((i, np.array(v)))
    return out


def _brute(rows, every, k, score):
    want = {}
    for q, x in {i: v for i, v in rows if i % every == 0}.items():
        best = sorted((-score(x, y), i) for i, y in rows if i != q and len(y) == len(x))[:k]
        want[q] = [(i, -s) for s, i in best]
    return {q: b for q, b in want.items() if b}


def _got(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


@pytest.mark.parametrize("group_rows", [64, 8192])
def test_top_k(spark, group_rows):
    df, rows = _vectors(spark)
    got = _got(topk.top_k(df, F.col("vec_id") % 10 == 0, k=10, group_rows=group_rows, block_queries=7))
    ints = lambda v: [int(np.floor(1024 * c)) for c in v]
    want = _brute(_usable(rows, True), 10, 10, lambda a, b: sum(x * y for x, y in zip(ints(a), ints(b))))
    assert got == want


def test_nearest(spark):
    df, rows = _vectors(spark)
    got = _got(ann.nearest(df, F.col("vec_id") % 10 == 0, k=5, group_rows=64, block_queries=7))
    want = _brute(_usable(rows, False), 10, 5, lambda a, b: float(ann.cosine(a[None], b[None])[0]))
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_empty(spark):
    df = _vectors(spark)[0].limit(0)
    assert topk.top_k(df, F.col("vec_id") % 10 == 0).count() == 0
    assert ann.nearest(df, F.col("vec_id") % 10 == 0).count() == 0


def test_slices_large_and_negative():
    rng = np.random.default_rng(1)
    x = rng.integers(-(1 << 20), 1 << 20, (130, 9))
    index = topk.Slices(x)
    q = rng.integers(-(1 << 20), 1 << 20, 9)
    slices, constant = index.score(q)
    got = [sum(int(s[r >> 6] >> np.uint64(r & 63) & np.uint64(1)) << p for p, s in enumerate(slices)) + constant
           for r in range(130)]
    assert got == (x @ q).tolist()


def test_query_rows_of_one_id_are_answered_each(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.2, 0.8])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for got in (topk.top_k(df, F.col("vec_id") == 100, k=1), ann.nearest(df, F.col("vec_id") == 100, k=1)):
        assert sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect()) == [(100, 1, 1), (100, 1, 2), (100, 1, 2)]


def test_components_too_large_for_a_score_are_named(spark):
    df = spark.createDataFrame([(100, [1e16, 1.0]), (1, [1e30, 2.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large for scores in 64 bits"):
        topk.top_k(df, F.col("vec_id") == 100).collect()
    assert [r.vec_id for r in ann.nearest(df, F.col("vec_id") == 100).collect()] == [1]
