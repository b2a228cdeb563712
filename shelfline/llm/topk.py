"""Exact top-k by integer inner product on a bit-sliced index.

Every component is quantised to floor(scale * x).  Inside a tile each dimension
of the candidates is stored as bit slices (one bitmap per binary digit, offset
so that all digits are of non-negative numbers).  A query's score is the sum of
its components times the dimensions: each set digit of a component adds the
dimension's slices, shifted (their complement where the component is negative).
Carry-save adders over whole bitmaps turn these into the slices of the scores.
The top rows are then selected from the most significant slice downward; rows
that tie at the boundary are resolved exactly, to the smaller id.  Scores are
read back from the slices, so they are exact integers.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows without an id; a query meets candidates of
its own length only; repeated rows are candidates each, but never for the query
of their own id, and of several query rows of one id each is answered; fewer
candidates than k give fewer rows; no rows give none; components whose scores
might not fit 64 bits are an error that says so.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tiles import against

SCALE = 1024


class Slices:
    """Bit-sliced index of an integer matrix (rows x dimensions)."""

    def __init__(self, matrix: np.ndarray):
        self.rows, self.dims = matrix.shape
        self.low = matrix.min(axis=0)
        shifted = (matrix - self.low).astype(np.uint64)
        self.bits = max(1, int(shifted.max()).bit_length())
        words = -(-self.rows // 64)
        planes = np.zeros((self.dims, self.bits, words * 64), bool)
        for b in range(self.bits):
            planes[:, b, :self.rows] = ((shifted >> np.uint64(b)) & np.uint64(1)).T.astype(bool)
        packed = np.packbits(planes, axis=2, bitorder="little").view(np.uint64)
        self.plus = packed.reshape(self.dims * self.bits, words)
        self.minus = ~self.plus
        self.full = (1 << self.bits) - 1

    def score(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of (score - constant), least significant first; the constant."""
        q = [int(x) for x in query]
        constant = sum(x * int(lo) for x, lo in zip(q, self.low))
        constant -= sum(-x * self.full for x in q if x < 0)
        at: dict[int, list] = {}
        digits = np.arange(self.bits)
        for d, x in enumerate(q):
            side, x = (self.minus, -x) if x < 0 else (self.plus, x)
            i = 0
            while x:
                if x & 1:
                    at.setdefault(i, []).append((side, d * self.bits + digits))
                x >>= 1
                i += 1
        # rows to add at each weight: digit i of the component x digit b of the slices
        want_plus: dict[int, list] = {}
        want_minus: dict[int, list] = {}
        for i, parts in at.items():
            for sign, want in ((self.plus, want_plus), (self.minus, want_minus)):
                base = [r[0] for s, r in parts if s is sign]
                if base:
                    base = np.array(base)
                    for b in range(self.bits):
                        want.setdefault(i + b, []).append(base + b)
        out, carries, p = [], [], 0
        top = max([*want_plus, *want_minus], default=-1)
        while p <= top or carries:
            stack = carries
            if p in want_plus:
                stack = [*stack, self.plus[np.concatenate(want_plus[p])]]
            if p in want_minus:
                stack = [*stack, self.minus[np.concatenate(want_minus[p])]]
            carries = []
            if not stack:
                out.append(np.zeros(self.plus.shape[1], np.uint64))
                p += 1
                continue
            s = np.concatenate(stack) if len(stack) > 1 else stack[0]
            while len(s) > 1:
                m = len(s) // 3
                if m:  # full adders
                    a, b, c = s[:m], s[m:2 * m], s[2 * m:3 * m]
                    x = a ^ b
                    carries.append((a & b) | (c & x))
                    s = np.concatenate([x ^ c, s[3 * m:]])
                else:  # a half adder
                    carries.append(s[:1] & s[1:2])
                    s = s[:1] ^ s[1:2]
            out.append(s[0])
            p += 1
        return out, constant

    def top(self, slices: list[np.ndarray], k: int, allowed: np.ndarray) -> np.ndarray:
        """Row numbers of the k largest; ties to the smaller row number."""
        sure, maybe = np.zeros_like(allowed), allowed
        for s in reversed(slices):
            up = maybe & s
            n = int(np.bitwise_count(sure | up).sum())
            if n > k:
                maybe = up
            elif n < k:
                sure, maybe = sure | up, maybe & ~s
            else:
                sure, maybe = sure | up, np.zeros_like(maybe)
                break
        got = self.positions(sure)
        return np.concatenate([got, self.positions(maybe)[:k - len(got)]])

    def positions(self, bitmap: np.ndarray) -> np.ndarray:
        words = np.flatnonzero(bitmap)
        bits = np.unpackbits(bitmap[words].view(np.uint8), bitorder="little").reshape(len(words), 64)
        w, b = np.nonzero(bits)
        return words[w] * 64 + b

    @property
    def every(self) -> np.ndarray:
        mask = np.zeros(self.plus.shape[1] * 64, bool)
        mask[:self.rows] = True
        return np.packbits(mask, bitorder="little").view(np.uint64)


def _whole(x: np.ndarray) -> np.ndarray:
    """Components rounded down, as integers; their sum of products must fit a long."""
    x = np.floor(x)
    if len(x) and np.abs(x).max() * np.sqrt(x.shape[1]) >= 2.0**31:
        raise ValueError("components are too large for scores in 64 bits: scale the vectors down")
    return x.astype(np.int64)


def search(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
           k: int, scale: float):
    """(place of the query, id, score) of the k best rows of one tile for each
    query; ``ids`` ascending."""
    index = Slices(_whole(matrix * scale))
    asked = _whole(queries * scale)
    out_q, out_v, out_s = [], [], []
    for place, (qid, q) in enumerate(zip(query_ids.tolist(), asked)):
        slices, constant = index.score(q)
        allowed = index.every
        for own in range(int(np.searchsorted(ids, qid, "left")), int(np.searchsorted(ids, qid, "right"))):
            allowed[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        rows = index.top(slices, k, allowed)
        for r in rows.tolist():
            score = sum(int(s[r >> 6] >> np.uint64(r & 63) & np.uint64(1)) << p for p, s in enumerate(slices))
            out_q.append(place)
            out_v.append(int(ids[r]))
            out_s.append(score + constant)
    return np.array(out_q, np.int64), np.array(out_v, np.int64), np.array(out_s, np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = SCALE,
          id_col: str = "vec_id", vec_col: str = "embedding", **tiles) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of
    each query row of ``vectors`` with all other rows."""
    found = against(vectors, is_query, lambda i, m, qi, q: search(i, m, qi, q, k, scale),
                    "query_id bigint, vec_id bigint, score bigint", id_col, vec_col, **tiles)
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


#: DuckDB form of op3 over ``embeddings`` (vectors of one length)
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 10
"""
