"""Generated calendar sources (SRC10-SRC12).

The calendar is bounded by its parameters (one row per day of the configured
range), so it is safe to broadcast; its size does not grow with the facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X


def dim_dates(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """SRC10 / MOD6: one row per day in [start, end] with calendar attributes."""
    n_days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    base = spark.range(0, max(n_days, 0), 1, numPartitions=1).select(d.alias("date_day"))
    return base.select(
        "date_day",
        F.date_sub("date_day", 1).alias("prior_date_day"),
        F.date_add("date_day", 1).alias("next_date_day"),
        X.iso_day_of_week("date_day").cast("long").alias("day_of_week"),
        F.dayofmonth("date_day").cast("long").alias("day_of_month"),
        F.dayofyear("date_day").cast("long").alias("day_of_year"),
        X.week_start("date_day").alias("week_start_date"),
        F.date_add(X.week_start("date_day"), 6).alias("week_end_date"),
        X.iso_week("date_day").cast("long").alias("iso_week_of_year"),
        F.month("date_day").cast("long").alias("month_of_year"),
        X.month_start("date_day").alias("month_start_date"),
        F.last_day("date_day").alias("month_end_date"),
        F.quarter("date_day").cast("long").alias("quarter_of_year"),
        F.trunc("date_day", "quarter").alias("quarter_start_date"),
        F.year("date_day").cast("long").alias("year_number"),
        F.trunc("date_day", "year").alias("year_start_date"),
    )


def time_spine(dates: DataFrame) -> DataFrame:
    """SRC11: the day grain of the calendar."""
    return dates.select("date_day")
