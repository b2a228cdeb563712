"""Runs that read a slice of the sources (FLT10, MOD7-MOD9, STR2).

``DatedSources`` holds the sources as tables laid out by day: a folder per
month, files sorted by day inside.  A run from a cutoff, or over a batch's
days, then reads the folders of its months only (``PartitionFilters``) and, by
the files' statistics, the row groups of its days.

Inventory units have no order day, so they are cut at run time: the slice's
smallest and largest unit id reach the scan as scalar subqueries (row groups
outside are skipped where ids grow with time), and a semi join on the slice's
ids leaves only its units before the join with the lines.  The semi join is a
broadcast only if adaptive execution measures the ids as small.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import incremental, inventory
from . import core


def _dated(df: DataFrame, day: Column, name: str) -> DataFrame:
    return df.withColumn(name, day).withColumn(f"{name}_month", F.trunc(name, "month"))


def lay_out(df: DataFrame, path: str, day: str, then: str) -> DataFrame:
    """Write ``df`` by month of ``day``, sorted by (day, then); read it back."""
    return _write_dated(df.repartitionByRange(F.col(day), F.col(then)), path, day, then)


def _write_dated(df: DataFrame, path: str, day: str, then: str) -> DataFrame:
    """``lay_out`` of rows that lie in ranges of (day, then) already."""
    month = f"{day}_month"
    (df.sortWithinPartitions(month, day, then)
       .write.mode("overwrite").option("compression", "zstd").partitionBy(month).parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def since(df: DataFrame, day: str, cutoff: dt.date) -> DataFrame:
    """Rows from ``cutoff`` on; the month's condition is one of folders."""
    return df.filter((F.col(f"{day}_month") >= F.lit(cutoff.replace(day=1))) & (F.col(day) >= F.lit(cutoff)))


def on_days(df: DataFrame, day: str, days: DataFrame) -> DataFrame:
    """Rows of the days in ``days`` (column ``day``).  Only the distinct months
    come to the driver, at most as many as the calendar has."""
    months = [r[0] for r in days.select(F.trunc(day, "month")).distinct().collect() if r[0] is not None]
    return (df.filter(F.col(f"{day}_month").isin(months) if months else F.lit(False))
            .join(days.select(day).distinct(), day, "left_semi"))


def only_units_of(units: DataFrame, lines: DataFrame) -> DataFrame:
    """The inventory units that occur in ``lines``."""
    ids = lines.select(F.col("inventory_item_id").alias("_line_unit")).filter("_line_unit IS NOT NULL")
    low, high = (ids.select(f("_line_unit")).scalar() for f in (F.min, F.max))
    near = units.filter((F.col("inventory_item_id") >= low) & (F.col("inventory_item_id") <= high))
    return near.join(ids, near.inventory_item_id == ids._line_unit, "left_semi")


class DatedSources:
    """Staged orders and lines by order day, unit movements by day, units and
    the product history as they are.  Each is laid out when it is first read: a
    run of one fact writes no copy that only another fact reads."""

    def __init__(self, stg_orders: DataFrame, stg_items: DataFrame, stg_units: DataFrame,
                 product_versions: DataFrame, root: str):
        self._stg_orders, self._stg_items, self._root = stg_orders, stg_items, root
        self.units, self.product_versions = stg_units, product_versions

    @classmethod
    def build(cls, spark: SparkSession, stg_orders: DataFrame, stg_items: DataFrame, stg_units: DataFrame,
              product_versions: DataFrame, root: str) -> "DatedSources":
        return cls(stg_orders, stg_items, stg_units, product_versions, root)

    @cached_property
    def orders(self) -> DataFrame:
        return lay_out(_dated(self._stg_orders, X.to_day("created_at"), "order_date"), f"{self._root}/orders",
                       "order_date", "order_id")

    @cached_property
    def lines(self) -> DataFrame:
        return lay_out(_dated(self._stg_items, X.to_day("created_at"), "order_date"), f"{self._root}/lines",
                       "order_date", "order_item_id")

    @cached_property
    def movements(self) -> DataFrame:
        # dealt by the ranges they are stored in before they are summed: a pair's day
        # lies in one range, so the sums need no shuffle of their own
        moves = inventory.unit_moves(core.inventory_units(self.units)).repartitionByRange("move_date", "product_id")
        return _write_dated(_dated(inventory.sum_moves(moves), F.col("move_date"), "move_date"), f"{self._root}/movements",
                            "move_date", "product_id")

    # ---- facts of a slice ----------------------------------------------------

    def _line_fact(self, lines: DataFrame) -> DataFrame:
        return core.fct_order_items(core.order_items_enriched(lines, only_units_of(self.units, lines),
                                                              self.product_versions))

    def fct_order_items(self, cutoff: dt.date) -> DataFrame:
        """MOD7 from the cutoff on."""
        return self._line_fact(since(self.lines, "order_date", cutoff))

    def fct_order_items_on(self, days: DataFrame) -> DataFrame:
        """MOD7 of the days in ``days`` (column order_date)."""
        return self._line_fact(on_days(self.lines, "order_date", days))

    def fct_orders(self, line_fact: DataFrame, cutoff: dt.date, line_lead_days: int = 1) -> DataFrame:
        """MOD8 from the cutoff on, with totals from the stored line fact."""
        return core.fct_orders(since(self.orders, "order_date", cutoff), line_fact, cutoff, line_lead_days)

    def fct_inventory_snapshot(self, spark: SparkSession, path: str, cutoff: dt.date, as_of: dt.date,
                               cal_start: dt.date, cal_end: dt.date) -> DataFrame | None:
        """MOD9 from the cutoff on, carried forward from the stored balances of
        the day before; None if that day is not stored (then build in full).
        Movements dated before the cutoff that came after the last run are not
        seen: a full refresh brings them in."""
        opening = cutoff - dt.timedelta(days=1)
        if opening.isoformat() not in (incremental.partition_values(spark, path, "snapshot_date") or []):
            return None
        stored = spark.read.schema(incremental.table_schema(spark, path)).parquet(
            f"{path}/snapshot_date={opening.isoformat()}")
        month = F.col("move_date_month")
        moves = self.movements.filter(((month >= F.lit(cutoff.replace(day=1))) & (F.col("move_date") >= F.lit(cutoff)))
                                      | month.isNull())
        b = inventory.carried_balances(stored, moves, cutoff, as_of, cal_start, cal_end)
        return b.select("product_id", "distribution_center_id", "snapshot_date", "units_on_hand", "inventory_cost_on_hand")
