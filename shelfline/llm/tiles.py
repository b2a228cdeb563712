"""Query blocks against candidate blocks of a vector table.

Candidates are dealt evenly into G groups and queries into H blocks; a task
holds one group and one block, both of bounded size, whatever the table's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow

GROUP_ROWS, BLOCK_QUERIES = 8192, 1024


def usable(vector: str | Column) -> Column:
    """Neither null nor empty nor with null or non-finite components."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad


def against(vectors: DataFrame, is_query: Column, search, schema: str, id_col: str = "vec_id",
            vec_col: str = "embedding", group_rows: int = GROUP_ROWS,
            block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Rows of ``search(ids, matrix, query_ids, query_matrix)`` for every query
    block x candidate group, by vector length.  Its first column is the place of
    the query among those it was given; instead of it come the query row's
    number (``query_row``) and id, then its other columns by ``schema``.  Query
    rows of one id are asked each."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                          is_query.alias("q")).filter(F.col("id").isNotNull() & usable("v"))
    # numbered by content: repeated rows share a number, and a lost task gives the same ones again
    asked = (rows.filter("q").groupBy("id", "v").agg(F.count("*").alias("times"))
             .select("id", "v", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth")))
    number = F.when(F.col("q"), F.xxhash64("id", "v", "nth"))
    n, nq = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).first()
    groups, blocks = max(1, -(-n // group_rows)), max(1, -(-nq // block_queries))
    dealt = lambda k: F.pmod(F.monotonically_increasing_id(), F.lit(k)).cast("int")
    cand = (rows.select("id", "v", dealt(groups).alias("g"))
            .withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("q", F.lit(False))
            .withColumn("nth", F.lit(0)))
    ask = (asked.select("id", "v", "nth", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("h"))
           .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("q", F.lit(True)))
    both = cand.unionByName(ask).select((F.col("g") * blocks + F.col("h")).cast("int").alias("tile"), "q", "id", "v",
                                        number.alias("row"))
    own = f"query_row bigint, {schema}"

    def run(batches):
        tiles: dict[int, list] = {}
        for b in batches:
            for t in np.unique(b.column(0).to_numpy()).tolist():
                tiles.setdefault(t, []).append(b.filter(pc.equal(b.column(0), t)))
        for t in sorted(tiles):
            part = pa.Table.from_batches(tiles[t])
            lengths = pc.list_value_length(part["v"]).to_numpy()
            is_q = part["q"].to_numpy()
            ids = part["id"].to_numpy()
            number = part["row"].to_numpy()
            for d in np.unique(lengths).tolist():
                c, q = np.flatnonzero((lengths == d) & ~is_q), np.flatnonzero((lengths == d) & is_q)
                if not len(c) or not len(q):
                    continue
                pick = lambda at: (part["v"].take(pa.array(at)).combine_chunks()
                                   .flatten().to_numpy().reshape(-1, d))
                c = c[np.argsort(ids[c], kind="stable")]
                out = search(ids[c], pick(c), ids[q], pick(q))
                if len(out[0]):
                    at = q[out[0]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(number[at].astype(np.int64)), pa.array(ids[at]), *[pa.array(x) for x in out[1:]]],
                        names=[f.split()[0] for f in own.split(", ")])

    return map_arrow(both.repartitionById(groups * blocks, "tile"), run, own)
