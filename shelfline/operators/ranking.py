"""Global ranking kernels without a single-partition window (WIN3, WIN4, WIN9).

A plain ``ntile(5) over (order by x)`` or ``sum(x) over (order by x desc)``
makes Spark move every row into one partition.  Here the total order is cut
into ranges instead, at every input size alike:

1. ``repartitionByRange`` on the whole key (the tie-breaking id included, so a
   hot value is split) and a sort inside each partition;
2. each row keeps its partition and its position in it, in one id; the result
   is materialized, so the ids never change;
3. per-partition totals (one row per partition) give the prefix offsets;
4. a row number is offset + position, with no window at all; a running sum is
   offset + an ordinary window inside the range.

The number of ranges is the session's shuffle width, or more where a range
would exceed ``rows_per_bucket`` rows.  Ranges only decide balance, never the
answer.  All keys must be non-null and ascending; callers encode direction and
null placement into the keys (negate for descending, a 0/1 flag for nulls).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ROWS_PER_BUCKET = 2_000_000

#: monotonically_increasing_id: partition above these bits, position below
_POSITION_BITS = 33


def n_buckets(df: DataFrame, n: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Ranges for ``n`` rows: the session's shuffle width at least."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, math.ceil(n / max(rows_per_bucket, 1)))


def global_prefix(df: DataFrame, key_names: list[str], out: str, measure: str | None = None,
                  n: int | None = None,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, int, object]:
    """Inclusive prefix over the total order of ``key_names``.

    ``measure=None`` gives the 1-based global row number; otherwise the running
    sum of ``measure`` (ROWS frame).  Returns (frame with ``out``, n, total):
    ``total`` is n for row numbers, else the sum of the measure (0 if there is
    none).  ``df`` is read several times; give ``n`` only with a frame that is
    cheap to read again, otherwise it is materialized first.
    """
    if n is None:
        df = materialize(df)
        n = df.count()
    keys = [F.col(k) for k in key_names]
    ranged = materialize(df.repartitionByRange(n_buckets(df, n, rows_per_bucket), *keys)
                         .sortWithinPartitions(*keys)
                         .withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_bucket", F.shiftright("_at", _POSITION_BITS))
    agg = F.count(F.lit(1)) if measure is None else F.sum(measure)
    totals = ranged.groupBy("_bucket").agg(agg.alias("_offset"))
    offsets, run = [], 0
    for bucket, t in sorted(tuple(r) for r in totals.collect()):
        offsets.append((bucket, run if run or t is None else t - t))
        run = run + (t if t is not None else 0)
    # one row per range: as bounded as the number of partitions
    before = F.broadcast(df.sparkSession.createDataFrame(offsets, totals.schema))
    if measure is None:
        inner = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)) + 1
    else:
        inner = F.sum(measure).over(Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(
            Window.unboundedPreceding, Window.currentRow))
    res = (ranged.withColumn("_in", inner).join(before, "_bucket")
           .withColumn(out, F.col("_offset") + F.col("_in"))
           .drop("_at", "_bucket", "_in", "_offset"))
    return res, n, run


def ntile_from_rank(rn: Column, n: int, k: int) -> Column:
    """Standard ntile: the first n % k tiles hold one extra row."""
    q, r = divmod(n, k)
    big = (rn - 1) / F.lit(q + 1)
    if q == 0:
        return rn.cast("int")
    small = (rn - 1 - F.lit(r)) / F.lit(q)
    return (F.when(rn <= F.lit(r * (q + 1)), F.floor(big)).otherwise(F.floor(small)) + 1).cast("int")


def global_ntile(df: DataFrame, k: int, key_names: list[str], out: str, n: int | None = None,
                 **kw) -> DataFrame:
    """``ntile(k) over (order by key_names)`` computed range-partitioned."""
    tmp = f"_rn_{out}"
    ranked, n, _ = global_prefix(df, key_names, tmp, None, n=n, **kw)
    return ranked.withColumn(out, ntile_from_rank(F.col(tmp), n, k)).drop(tmp)
