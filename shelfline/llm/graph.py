"""Connected components of an edge table.

Edges are first contracted inside each partition (a partition's edges are
replaced by stars of the same connectivity), then large-star / small-star
rounds run on Spark until no edge changes.  A hub's edges are joined by a
shuffle join on two plain exchanges, which adaptive execution can split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, map_arrow

#: edges held at once by the in-partition contraction
CONTRACT_EDGES = 1_000_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component), without self edges."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inv[:len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        while not np.array_equal(nxt := new[new], new):
            new = nxt
        if np.array_equal(new, root):
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _contract(batches):
    a = b = np.zeros(0, np.int64)
    out = lambda x, y: pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["u", "v"])
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(a) > CONTRACT_EDGES:
            a, b = stars(a, b)
            if len(a) > CONTRACT_EDGES // 2:
                yield out(a, b)
                a = b = np.zeros(0, np.int64)
    if len(a):
        yield out(*stars(a, b))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v: bigint) that is
    not its component's smallest node; root is that smallest node."""
    e = cut(map_arrow(edges, _contract, "u bigint, v bigint").filter("u <> v").distinct())
    before = None
    while True:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(sym.groupBy("u").agg(F.min("v").alias("m"))
                  .select("u", F.least("u", "m").alias("m")))
        # larger neighbours move to the smallest one
        e = (sym.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .filter("u <> v").distinct())
        e = cut(e)
        low = cut(e.groupBy("u").agg(F.min("v").alias("m")))  # v < u in every edge
        # smaller neighbours, and the node itself, move to the smallest one
        moved = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(now)
