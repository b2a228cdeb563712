"""Inventory balances from unit in/out events (AGG3-AGG5, SET1-SET2, JN5-JN6, WIN5).

The reference builds a product x centre x day grid (cross join with the date
spine) and left-joins daily deltas onto it.  Here the same rows come from the
events alone:

* one scan of the units, ``explode`` into (in, +1, +cost), (out, -1, -cost) and
  a zero event at the first spine day, so every pair starts on that day;
* dates before the window start are moved to the window start: that *is* the
  opening balance; dates outside the spine are dropped;
* sum per (pair, day) with map-side partial aggregation;
* per pair, a running sum and ``lead`` over at most one row per spine day,
  then ``explode(sequence(day, next_day - 1))`` fills the quiet days.

No cross join and no grid join; a hot pair only ever holds one row per spine
day before the explode, so it cannot overload a task.

A later run need not read the units' history again: ``movements`` keeps their
in/out events as sums per pair and day, and ``carried_balances`` adds those
since a day to the balances stored for the day before.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("product_id", "distribution_center_id")


def _events(units: DataFrame, window_start: dt.date, lo: dt.date, hi: dt.date) -> DataFrame:
    """units: product_id, distribution_center_id, cost, in_date, out_date."""
    ws = F.lit(window_start)
    keyed = F.col("product_id").isNotNull() & F.col("distribution_center_id").isNotNull()
    # a null key never matched the reference's delta join: its balances stay 0
    cost = F.when(keyed, F.coalesce(F.col("cost").cast("decimal(12,2)"), F.lit(0).cast("decimal(12,2)")))\
        .otherwise(F.lit(0).cast("decimal(12,2)"))
    one = F.when(keyed, F.lit(1)).otherwise(F.lit(0))
    ev = F.array(
        F.struct(F.col("in_date").alias("d"), one.alias("du"), cost.alias("dc")),
        F.struct(F.col("out_date").alias("d"), (-one).alias("du"), (-cost).alias("dc")),
        F.struct(F.lit(lo).alias("d"), F.lit(0).alias("du"),
                 F.lit(0).cast("decimal(12,2)").alias("dc")),
    )
    e = units.select(*KEYS, F.explode(ev).alias("e")).select(*KEYS, "e.*")
    e = e.filter(F.col("d").isNotNull())
    e = e.withColumn("d", F.when(F.col("d") < ws, ws).otherwise(F.col("d")))
    return e.filter((F.col("d") >= F.lit(lo)) & (F.col("d") <= F.lit(hi)))


def spine_bounds(window_start: dt.date, as_of: dt.date, cal_start: dt.date, cal_end: dt.date):
    return max(window_start, cal_start), min(as_of, cal_end)


def daily_balances(units: DataFrame, window_start: dt.date, as_of: dt.date,
                   cal_start: dt.date, cal_end: dt.date) -> DataFrame:
    """Dense (product, centre, day) running balance: units_on_hand, inventory_cost_on_hand."""
    lo, hi = spine_bounds(window_start, as_of, cal_start, cal_end)
    if lo > hi:
        return units.sparkSession.createDataFrame(
            [], "product_id long, distribution_center_id long, snapshot_date date, "
                "units_on_hand long, inventory_cost_on_hand decimal(22,2)")
    e = _events(units, window_start, lo, hi)
    daily = e.groupBy(*KEYS, "d").agg(F.sum("du").alias("du"), F.sum("dc").alias("dc"))
    return _dense(daily, hi)


def _dense(daily: DataFrame, hi: dt.date) -> DataFrame:
    """Running balances of every pair from its first day in ``daily`` to ``hi``."""
    w = Window.partitionBy(*KEYS).orderBy("d")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = daily.select(
        *KEYS, "d",
        F.sum("du").over(run).alias("units_on_hand"),
        F.sum("dc").over(run).alias("inventory_cost_on_hand"),
        F.lead("d").over(w).alias("next_d"))
    last = F.coalesce(F.date_sub("next_d", 1), F.lit(hi))
    return cum.select(
        *KEYS,
        F.explode(F.sequence(F.col("d"), last)).alias("snapshot_date"),
        F.col("units_on_hand").cast("long").alias("units_on_hand"),
        "inventory_cost_on_hand")


def latest_balances(units: DataFrame, window_start: dt.date, as_of: dt.date,
                    cal_start: dt.date, cal_end: dt.date) -> DataFrame:
    """Balance on the last spine day only: one aggregation, no window, no explode.

    Equals ``daily_balances`` filtered to its max ``snapshot_date``.
    """
    lo, hi = spine_bounds(window_start, as_of, cal_start, cal_end)
    e = _events(units, window_start, lo, hi)
    return e.groupBy(*KEYS).agg(
        F.lit(hi).alias("snapshot_date"),
        F.sum("du").cast("long").alias("units_on_hand"),
        F.sum("dc").alias("inventory_cost_on_hand"))


def unit_moves(units: DataFrame) -> DataFrame:
    """Each unit's changes: du units and dc cost on ``move_date``.  A unit
    without any date still leaves its pair, with a null day and no change."""
    keyed = F.col("product_id").isNotNull() & F.col("distribution_center_id").isNotNull()
    nothing = F.lit(0).cast("decimal(12,2)")
    cost = F.when(keyed, F.coalesce(F.col("cost").cast("decimal(12,2)"), nothing)).otherwise(nothing)
    one = F.when(keyed, F.lit(1)).otherwise(F.lit(0))
    moves = F.filter(F.array(
        F.struct(F.col("in_date").alias("move_date"), one.alias("du"), cost.alias("dc")),
        F.struct(F.col("out_date").alias("move_date"), (-one).alias("du"), (-cost).alias("dc"))),
        lambda m: m["move_date"].isNotNull())
    dateless = F.array(F.struct(F.lit(None).cast("date").alias("move_date"), F.lit(0).alias("du"), nothing.alias("dc")))
    e = units.select(*KEYS, F.explode(F.when(F.size(moves) > 0, moves).otherwise(dateless)).alias("e"))
    return e.select(*KEYS, "e.move_date", "e.du", "e.dc")


def sum_moves(moves: DataFrame) -> DataFrame:
    """Changes summed per pair and day."""
    return moves.groupBy(*KEYS, "move_date").agg(F.sum("du").alias("du"), F.sum("dc").alias("dc"))


def movements(units: DataFrame) -> DataFrame:
    """Daily changes per pair."""
    return sum_moves(unit_moves(units))


def carried_balances(opening: DataFrame, moves: DataFrame, since: dt.date, as_of: dt.date,
                     cal_start: dt.date, cal_end: dt.date) -> DataFrame:
    """Balances from ``since`` on: the stored ones of the day before (``opening``)
    plus the movements of later days.  Equals the same days of
    ``daily_balances`` as long as no movement before ``since`` came late."""
    lo, hi = spine_bounds(since, as_of, cal_start, cal_end)
    if lo > hi:
        return opening.select(*KEYS, F.lit(lo).alias("snapshot_date"), "units_on_hand", "inventory_cost_on_hand").limit(0)
    start = opening.select(*KEYS, F.lit(lo).alias("d"), F.col("units_on_hand").alias("du"),
                           F.col("inventory_cost_on_hand").alias("dc"))
    day = F.greatest("move_date", F.lit(lo))
    inside = (F.col("move_date") >= F.lit(since)) & (F.col("move_date") <= F.lit(hi))
    # a pair known only by a later or dateless movement starts with nothing
    kept = moves.filter(inside | F.col("move_date").isNull() | (F.col("move_date") > F.lit(hi)))
    late = kept.select(*KEYS, F.when(inside, day).otherwise(F.lit(lo)).alias("d"),
                       F.when(inside, F.col("du")).otherwise(F.lit(0)).alias("du"),
                       F.when(inside, F.col("dc")).otherwise(F.lit(0)).alias("dc"))
    pairs = kept.select(*KEYS, F.lit(lo).alias("d"), F.lit(0).alias("du"), F.lit(0).cast("decimal(12,2)").alias("dc"))
    daily = start.unionByName(late).unionByName(pairs).groupBy(*KEYS, "d").agg(
        F.sum("du").alias("du"), F.sum("dc").alias("dc"))
    return _dense(daily, hi).withColumn("inventory_cost_on_hand", F.col("inventory_cost_on_hand").cast("decimal(32,2)"))
