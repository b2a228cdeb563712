"""Hard negatives by threshold joins with suffix-norm bounds.

For every anchor: its positives are the best other rows of its label by integer
inner product; its negatives for a positive are the best rows of other labels
whose score lies in the positive's window.  Both come from threshold joins in
the manner of L2AP, in rounds:

* Each round has a score threshold per anchor (and, for negatives, per window).
  Anchors, thresholds and windows are written once as arrays in the shared
  folder and memory-mapped by the workers; every candidate is read once a round
  and streamed, a tile at a time, through all blocks of anchors.
* In a tile, dimensions are ordered by their energy and the rows indexed by
  dimension.  A row's postings stop at the first dimension from which on its
  suffix norm times the largest suffix norm of the block's anchors stays below
  the block's smallest threshold: the rest alone can't reach it.  A row that
  needs no posting is in no list.
* Scores are accumulated along the postings, a few dimensions at a time.  After
  each step a pair whose partial score plus the product of the remaining norms
  (Cauchy-Schwarz) is below the anchor's threshold is dropped.  Where few pairs
  are left they are followed one by one; the rest is completed exactly.
* Of a tile only an anchor's best rows per window travel.  Windows that the
  threshold fills are done: no row below it can enter.  The others come again
  with a lower threshold, until it has reached the window's lower end (for
  positives: until nothing is cut off).  So results are exact.

A task holds one tile and one block, both of bounded bytes; merging is a ranking
per anchor and window over at most a few rows a tile.  Rounds are written to the
shared folder, which also cuts the lineage.

Defined cases: rows with a null id, a null label or a vector that is null, empty
or holds null or non-finite components take no part; a row meets rows of its own
vector length only; a repeated row is a row of its own, so an anchor's copy with
the same id counts as another row, and each of several anchor rows of one id is
answered; ties go to the smaller id, then to the row read first; fewer rows give
fewer results; scores beyond the range of a long count as its end; extra columns
are ignored; no anchors or no rows give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import load, map_arrow, save, shared_dir
from .tiles import usable

SCALE = 256
#: parts of an anchor's own squared norm that serve as thresholds for positives;
#: the round after them has none
POSITIVE_STEPS = (0.8, 0.5, 0.2)
#: parts of a window from its upper end on that the rounds for negatives cover
NEGATIVE_STEPS = (0.1, 0.4, 1.0)

TILE_BYTES, BLOCK_BYTES, BLOCK_ANCHORS = 8 << 20, 8 << 20, 256
#: dimensions of one step, pairs completed at once, blocks that one task writes
STEP, PAIRS, WRITES = 8, 1 << 18, 32
LOW, HIGH = -(1 << 63), (1 << 63) - 1


class Side:
    """Integer vectors with the norms of what follows each step's start."""

    def __init__(self, x: np.ndarray, order: np.ndarray):
        self.x = np.ascontiguousarray(x[:, order])
        self.d = self.x.shape[1]
        self.starts = np.arange(0, self.d + STEP, STEP).clip(max=self.d)
        square = np.zeros((len(x), self.d + 1))
        square[:, :-1] = np.cumsum((self.x * self.x)[:, ::-1], axis=1)[:, ::-1]
        self.norm = np.sqrt(square[:, self.starts]) * (1 + 1e-9)


def _dot(q: Side, y: Side, qi: np.ndarray, ci: np.ndarray, a: int, b: int) -> np.ndarray:
    """Inner products of pairs over the dimensions a to b."""
    out = np.empty(len(qi))
    for i in range(0, len(qi), PAIRS):
        out[i:i + PAIRS] = np.einsum("ij,ij->i", q.x[qi[i:i + PAIRS], a:b], y.x[ci[i:i + PAIRS], a:b])
    return out


def threshold_join(rows: np.ndarray, anchors: np.ndarray, floor: np.ndarray, meets: np.ndarray):
    """(anchor index, row index, score) of all pairs allowed by ``meets``
    (anchors x rows) whose inner product is at least the anchor's ``floor``.
    Vectors hold integers as doubles; all partial sums stay below 2**53."""
    order = np.argsort(-(rows * rows).sum(axis=0), kind="stable")
    y, q = Side(rows, order), Side(anchors, order)
    floor = floor.astype(np.float64)
    if floor.min() > 0:
        # postings: the steps before the first whose rest can't reach the threshold
        steps = (y.norm * q.norm.max(axis=0) >= floor.min() - 0.5).argmin(axis=1)
        listed = np.argsort(-steps, kind="stable")
        listed = listed[steps[listed] > 0]
    else:  # a threshold that the empty sum reaches: all postings of all rows
        steps = np.full(len(rows), len(y.starts) - 1)
        listed = np.arange(len(rows))
    steps = steps[listed]
    alive = meets[:, listed]
    score = np.zeros(alive.shape)
    pairs = None
    for s, (a, b) in enumerate(zip(y.starts[:-1].tolist(), y.starts[1:].tolist())):
        if pairs is None:
            n = int(np.searchsorted(-steps, -s, "left"))  # rows with a posting in this step
            if not n:
                break
            score[:, :n] += q.x[:, a:b] @ y.x[listed[:n], a:b].T
            alive[:, :n] &= score[:, :n] + q.norm[:, s + 1, None] * y.norm[listed[:n], s + 1] >= floor[:, None] - 0.5
            if np.count_nonzero(alive) <= 0.05 * alive.size:
                pairs = np.nonzero(alive)
                part = score[pairs]
        else:
            qi, ci = pairs
            more = steps[ci] > s
            part[more] += _dot(q, y, qi[more], listed[ci[more]], a, b)
            at = np.minimum(steps[ci], s + 1)
            keep = part + q.norm[qi, at] * y.norm[listed[ci], at] >= floor[qi] - 0.5
            pairs, part = (qi[keep], ci[keep]), part[keep]
    if pairs is None:
        pairs = np.nonzero(alive)
        part = score[pairs]
    qi, ci = pairs
    # the dimensions behind each row's postings
    for s, (a, b) in enumerate(zip(y.starts[:-1].tolist(), y.starts[1:].tolist())):
        rest = np.flatnonzero(steps[ci] <= s)
        if len(rest):
            part[rest] += _dot(q, y, qi[rest], listed[ci[rest]], a, b)
    keep = part >= floor[qi]
    return qi[keep], listed[ci[keep]], part[keep].astype(np.int64)


def _exact_join(rows: np.ndarray, anchors: np.ndarray, floor: np.ndarray, meets: np.ndarray):
    """As threshold_join for vectors of any size, in integers of any length."""
    out = []
    whole = [[int(v) for v in r] for r in rows]
    for i, a in enumerate(anchors):
        a = [int(v) for v in a]
        for j in np.flatnonzero(meets[i]).tolist():
            s = min(max(sum(x * y for x, y in zip(a, whole[j])), LOW), HIGH)
            if s >= int(floor[i]):
                out.append((i, j, s))
    got = np.array(out, np.int64).reshape(-1, 3)
    return got[:, 0], got[:, 1], got[:, 2]


def join(rows: np.ndarray, anchors: np.ndarray, floor: np.ndarray, meets: np.ndarray):
    """threshold_join, with pairs of huge vectors joined in exact integers."""
    size = lambda x: np.sqrt((x / 2.0**20) ** 2 @ np.ones(x.shape[1])) * 2.0**20
    big_r, big_a = ~(size(rows) < 2.0**26), ~(size(anchors) < 2.0**26)
    parts = []
    for r, a, how in ((~big_r, ~big_a, threshold_join), (big_r, ~big_a, _exact_join), (~big_r, big_a, _exact_join),
                      (big_r, big_a, _exact_join)):
        r, a = np.flatnonzero(r), np.flatnonzero(a)
        if len(r) and len(a):
            qi, ci, s = how(rows[r], anchors[a], floor[a], meets[np.ix_(a, r)])
            parts.append((a[qi], r[ci], s))
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(3))


def first(groups: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first k of each group by score descending, then id."""
    order = np.lexsort((ids, ~scores, groups))  # ~x falls as x rises, without overflow
    g = groups[order]
    begin = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    rank = np.arange(len(g)) - np.maximum.accumulate(np.where(begin, np.arange(len(g)), 0))
    return order[rank < k]


def _blocks(asked: DataFrame, root: str) -> dict[int, list[int]]:
    """Write the anchors with their windows as arrays, in blocks of one vector
    length; returns the blocks of each length."""
    counts = asked.groupBy(F.size("v").alias("d")).count().collect()  # one row per vector length
    out = {}
    for d, n in sorted((r["d"], r["count"]) for r in counts):
        blocks = -(-n // max(1, min(BLOCK_ANCHORS, BLOCK_BYTES // (8 * d))))

        def write(batches):
            held: dict[int, list] = {}
            for batch in batches:
                t = pa.Table.from_batches([batch])
                for b in pc.unique(t["block"]).to_pylist():
                    held.setdefault(b, []).append(t.filter(pc.equal(t["block"], b)))
            for b, parts in held.items():
                t = pa.concat_tables(parts).combine_chunks().sort_by("row")
                for name in ("row", "label"):
                    save(f"{root}/{d}-{b}-{name}.npy", t[name].to_numpy())
                for name in ("v", "low", "high"):
                    flat = t[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                    save(f"{root}/{d}-{b}-{name}.npy", flat.reshape(len(t), -1))
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32())], names=["block"])

        rows = asked.filter(F.size("v") == d).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        written = map_arrow(rows.repartition(-(-blocks // WRITES), "block"), write, "block int")
        out[d] = sorted(r["block"] for r in written.collect())  # a number per block, no data
    return out


def _scan(table: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """(row, window, other, other_id, score): for each anchor row of ``asked``
    and each of its windows [low, high] the k first rows of every tile with a
    score in it, of the anchor's label (``same``) or of others."""
    root = shared_dir(table.sparkSession, "hard_negatives")
    blocks = _blocks(asked, root)

    def tile(ids, others, labels, x):
        d = x.shape[1]
        for b in blocks.get(d, ()):
            get = lambda name: np.asarray(load(f"{root}/{d}-{b}-{name}.npy"))
            row, label, v, low, high = (get(c) for c in ("row", "label", "v", "low", "high"))
            meets = label[:, None] == labels
            meets = (meets & (row[:, None] != others)) if same else ~meets
            qi, ci, score = join(x, v, low.min(axis=1), meets)
            for w in range(low.shape[1]):
                inside = np.flatnonzero((score >= low[qi, w]) & (score <= high[qi, w]))
                best = inside[first(qi[inside], ids[ci[inside]], score[inside], k)]
                if len(best):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row[qi[best]]), pa.array(np.full(len(best), w, np.int32)), pa.array(others[ci[best]]),
                         pa.array(ids[ci[best]]), pa.array(score[best])],
                        names=["row", "window", "other", "other_id", "score"])

    def run(batches):
        held: dict[int, list] = {}
        rows: dict[int, int] = {}

        def flush(d):
            t = pa.concat_tables(held.pop(d)).combine_chunks()
            x = t["v"].combine_chunks().flatten().to_numpy().reshape(-1, d)
            at = np.lexsort((t["row"].to_numpy(), t["id"].to_numpy()))
            rows.pop(d)
            yield from tile(t["id"].to_numpy()[at], t["row"].to_numpy()[at], t["label"].to_numpy()[at], x[at])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            size = pc.list_value_length(t["v"])
            for d in pc.unique(size).to_pylist():
                part = t.filter(pc.equal(size, d))
                step = max(64, TILE_BYTES // (8 * d))
                while len(part):
                    take = part.slice(0, step - rows.get(d, 0))
                    part = part.slice(len(take))
                    held.setdefault(d, []).append(take)
                    rows[d] = rows.get(d, 0) + len(take)
                    if rows[d] >= step:
                        yield from flush(d)
        for d in sorted(held):
            yield from flush(d)

    found = map_arrow(table.select("id", "row", "label", "v"), run,
                      "row bigint, window int, other bigint, other_id bigint, score bigint")
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "other_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: float = 0.5,
         high: float = 0.95, scale: float = SCALE, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor row and each of its ``positives`` best rows
    of its label, the first ``negatives`` rows of other labels whose score is
    between ``low`` and ``high`` (in hundredths) times the positive's."""
    spark = vectors.sparkSession
    root = shared_dir(spark, "hard_negatives")
    low, high = round(100 * low), round(100 * high)
    table = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                           F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    table = table.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("v"))
    top = float(np.finfo(np.float64).max)

    def whole(x):  # floor, kept as a double: from 2**52 on a double has no fraction
        x = F.least(F.greatest(x * F.lit(float(scale)), F.lit(-top)), F.lit(top))
        return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)

    rows = _kept(table.withColumn("v", F.transform("v", whole)).withColumn("row", F.monotonically_increasing_id()),
                 f"{root}/rows")
    anchors = rows.filter("anchor").select("row", "id", "label", "v")

    # positives: thresholds fall until each anchor has enough
    own = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    todo, found = anchors, []
    for i, step in enumerate((*POSITIVE_STEPS, None)):
        floor = F.lit(LOW) if step is None else F.greatest(F.ceil(own * step), F.lit(1))
        asked = todo.select("row", "label", "v", F.array(floor.cast("bigint")).alias("low"), F.array(F.lit(HIGH)).alias("high"))
        got = _kept(_scan(rows, asked, True, positives), f"{root}/positives-{i}")
        full = got.groupBy("row").agg(F.count("*").alias("n")).filter(F.col("n") >= positives).select("row")
        found.append(got if step is None else got.join(full, "row", "left_semi"))
        if step is not None:
            todo = _kept(todo.join(full, "row", "left_anti"), f"{root}/anchors-{i}")
            if todo.isEmpty():
                break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    # low * positive <= 100 * negative <= high * positive, in whole numbers
    p = F.col("score").cast("decimal(20,0)")
    pairs = pairs.select(
        "row", F.col("rank").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(p * low / 100).cast("bigint").alias("low"), F.floor(p * high / 100).cast("bigint").alias("high"))
    pairs = _kept(pairs, f"{root}/windows")

    # negatives: from each window's upper end down
    todo, found = pairs.filter("low <= high"), []
    place = F.struct("place", "bottom", "high")
    for i, step in enumerate(NEGATIVE_STEPS):
        bottom = F.greatest("low", F.col("high") - F.ceil((F.col("high") - F.col("low")) * F.lit(float(step))))
        lists = (todo.select("row", "place", "high", (F.col("low") if step >= 1 else bottom).alias("bottom"))
                 .groupBy("row").agg(F.array_sort(F.collect_list(place)).alias("w")))  # at most `positives` a row
        every = F.sequence(F.lit(1), F.lit(positives))
        at = lambda field, empty: F.transform(every, lambda j: F.coalesce(
            F.get(F.filter("w", lambda w: w["place"] == j), F.lit(0))[field].cast("bigint"), F.lit(empty)))
        asked = anchors.join(lists, "row").select("row", "label", "v", at("bottom", HIGH).alias("low"),
                                                  at("high", LOW).alias("high"))  # no window: an empty one
        got = _kept(_scan(rows, asked, False, negatives).withColumn("place", F.col("window") + 1), f"{root}/negatives-{i}")
        if step >= 1:
            found.append(got)
            break
        full = got.groupBy("row", "place").agg(F.count("*").alias("n")).filter(F.col("n") >= negatives).select("row", "place")
        found.append(got.join(full, ["row", "place"], "left_semi"))
        todo = _kept(todo.join(full, ["row", "place"], "left_anti"), f"{root}/open-{i}")
        if todo.isEmpty():
            break
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    return (hits.select("row", "place", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
                        F.col("score").alias("negative_score"))
            .join(pairs.select("row", "place", "positive_id", "positive_score"), ["row", "place"])
            .join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


#: DuckDB form of op11 over ``embeddings`` (vectors of one length)
ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         list_sum(list_transform(list_zip(a.x, o.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v o ON a.vec_id % 50 = 0 AND o.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other_id))::INTEGER AS rank,
       n.other_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY rank <= 3
"""
