"""Structured Streaming forms of two batch models (STR1, STR2).

* ``weekly_event_counts``: web events -> Monday-aligned 7-day windows with a
  watermark for late data (the streaming form of the weekly event signal);
* ``upkeep_partitions``: a change feed triggers micro-batches; each batch
  recomputes the touched fact dates *in full* from the sources and replaces
  just those partitions (an overwrite with only the batch's rows would lose
  the rest of the day).  Sources laid out by day (``plans.slices``) are read in
  the batch's months only.  A ledger beside the checkpoint names the batches
  whose partitions are in place: a batch that comes again after that is left
  out, one that failed before it writes the same partitions again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental

# 1970-01-01 is a Thursday; a 4-day offset aligns 7-day windows to Mondays
WEEK = "7 days"
MONDAY_OFFSET = "4 days"


def as_event_time(ntz_col: str) -> F.Column:
    """Wall-clock UTC (TIMESTAMP_NTZ) -> TIMESTAMP for watermarks, independent
    of the session time zone."""
    return F.from_utc_timestamp(F.col(ntz_col).cast("timestamp"), F.current_timezone())


def weekly_event_counts(events: DataFrame, ts_col: str = "created_at",
                        late: str = "3 days") -> DataFrame:
    """STR1: events per Monday week, late rows accepted up to ``late``."""
    e = events.withColumn("_et", as_event_time(ts_col)).withWatermark("_et", late)
    g = e.groupBy(F.window("_et", WEEK, WEEK, MONDAY_OFFSET).alias("w")).agg(
        F.count(F.lit(1)).alias("events_total"),
        F.count_if(F.col("event_type") == "purchase").alias("events_purchase"),
        F.count_if(F.col("event_type") == "cart").alias("events_cart"))
    start = F.to_date(F.to_utc_timestamp(F.col("w.start"), F.current_timezone()))
    return g.select(start.alias("week_start_date"),
                    "events_total", "events_purchase", "events_cart")


def write_touched_weeks(result: DataFrame, path: str, checkpoint: str):
    """Keep the weekly table current: every micro-batch replaces the weeks it
    touched (update mode, so the watermark drops old state and later rows; a
    repeated batch writes the same weeks again)."""
    def sink(batch: DataFrame, batch_id: int):
        batch.persist()  # the range layout reads it twice
        incremental.write_partitions(batch, path, "week_start_date")
        batch.unpersist()
    return (result.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


class BatchLedger:
    """The ids of the batches that are in place, an empty file each."""

    def __init__(self, spark: SparkSession, root: str):
        self._root = root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self._root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, batch_id: int):
        return self._path(f"{self._root}/{batch_id:012d}")

    def holds(self, batch_id: int) -> bool:
        return self._fs.exists(self._file(batch_id))

    def record(self, batch_id: int) -> None:
        self._fs.create(self._file(batch_id), True).close()

    def batches(self) -> list[int]:
        if not self._fs.exists(self._path(self._root)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self._root))]
        return sorted(int(n) for n in names if n.isdigit())


def upkeep_batch(batch: DataFrame, batch_id: int, touched_dates: Callable[[DataFrame], DataFrame],
                 rebuild: Callable[[DataFrame], DataFrame], path: str, part_col: str, cluster_cols=(),
                 ledger: BatchLedger | None = None) -> bool:
    """One batch of the upkeep; False if the ledger holds it already."""
    if ledger is not None and ledger.holds(batch_id):
        return False
    dates = touched_dates(batch).select(part_col).distinct().persist()
    try:
        incremental.write_partitions(rebuild(dates), path, part_col, cluster_cols)
    finally:
        dates.unpersist()
    if ledger is not None:
        ledger.record(batch_id)
    return True


def upkeep_partitions(changes: DataFrame, touched_dates: Callable[[DataFrame], DataFrame],
                      rebuild: Callable[[DataFrame], DataFrame], path: str, part_col: str,
                      checkpoint: str, cluster_cols=()):
    """STR2: for every micro-batch of changes, rebuild the touched partitions.

    ``touched_dates(batch)`` -> one column ``part_col`` (the dates a batch
    touches); ``rebuild(dates)`` -> the full fact rows of those dates.  Dynamic
    overwrite replaces exactly them, each batch once.
    """
    ledger = BatchLedger(changes.sparkSession, f"{checkpoint.rstrip('/')}.ledger")

    def sink(batch: DataFrame, batch_id: int):
        upkeep_batch(batch, batch_id, touched_dates, rebuild, path, part_col, cluster_cols, ledger)
    return (changes.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
