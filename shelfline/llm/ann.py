"""Nearest neighbours by cosine: block matrix join on int8 tiles.

In a tile, unit vectors are quantised to int8 with a scale per row.  One matrix
product of the int8 tiles (exact in float32 up to 1,040 dimensions, float64
beyond) gives approximate cosines; each row's quantisation error norm gives a
bound for every pair.  Pairs whose upper bound reaches the k-th best lower bound
survive and are recomputed in double precision from the original vectors; a
heap per query keeps the best.  Each tile passes on at most k rows a query;
these are ranked per query, cut to k in every partition before the shuffle.
Because of the bounds the result is exact (recall 1).

Defined cases: vectors that are null, empty, all zero or hold null or non-finite
components take no part, nor do rows without an id; a query meets candidates of
its own length only; repeated rows are candidates each, but never for the query
of their own id; ties go to the smaller id; fewer candidates give fewer rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tiles import against

#: rows of candidates multiplied at once
TILE = 2048


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _quantise(unit: np.ndarray):
    """int8 codes, scale, norm of the coded vector, norm of the error."""
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    code = np.rint(unit / scale).astype(np.int8)
    coded = code * scale
    return (code, scale[:, 0], np.sqrt((coded * coded).sum(axis=1)),
            np.sqrt(((unit - coded) ** 2).sum(axis=1)))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision on the vectors as given."""
    sa, sb = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
    plain = (sa < 1e100) & (sb < 1e100) & (sa > 1e-100) & (sb > 1e-100)
    if not plain.all():
        a = np.where(plain[:, None], a, a / sa[:, None])
        b = np.where(plain[:, None], b, b / sb[:, None])
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def search(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(place of the query, id, cosine) of the k nearest rows of one tile for
    each query."""
    ok, asked = (matrix != 0).any(axis=1), np.flatnonzero((queries != 0).any(axis=1))
    ids, matrix, query_ids, queries = ids[ok], matrix[ok], query_ids[asked], queries[asked]
    kind = np.float32 if matrix.shape[1] <= 1040 else np.float64
    qc, qs, qn, qe = _quantise(_unit(queries)) if len(queries) else (queries, *[np.zeros(0)] * 3)
    heaps: list[list] = [[] for _ in query_ids]
    for at in range(0, len(ids), TILE):
        raw, own = matrix[at:at + TILE], ids[at:at + TILE]
        cc, cs, _, ce = _quantise(_unit(raw))
        near = (qc.astype(kind) @ cc.astype(kind).T).astype(np.float64) * qs[:, None] * cs
        slack = qe[:, None] + qn[:, None] * ce + 1e-9
        near[query_ids[:, None] == own] = -np.inf
        low = near - slack
        floor = (np.partition(low, len(own) - k, axis=1)[:, len(own) - k] if len(own) >= k
                 else np.full(len(query_ids), -np.inf))
        floor = np.maximum(floor, [h[0][0] if len(h) == k else -np.inf for h in heaps])
        qi, ci = np.nonzero((near + slack >= floor[:, None]) & np.isfinite(near))
        exact = cosine(queries[qi], raw[ci])
        for q, s, v in zip(qi.tolist(), exact.tolist(), own[ci].tolist()):
            heap = heaps[q]
            if len(heap) < k:
                heapq.heappush(heap, (s, -v))
            elif (s, -v) > heap[0]:
                heapq.heapreplace(heap, (s, -v))
    flat = [(q, -v, s) for q, h in enumerate(heaps) for s, v in h]
    return (asked[np.array([x[0] for x in flat], np.int64)], np.array([x[1] for x in flat], np.int64),
            np.array([x[2] for x in flat], np.float64))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vec_col: str = "embedding", **tiles) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k nearest other rows."""
    found = against(vectors, is_query, lambda i, m, qi, q: search(i, m, qi, q, k),
                    "query_id bigint, vec_id bigint, score double", id_col, vec_col, **tiles)
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
