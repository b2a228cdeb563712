"""Dashboard report tables (BI1-BI8): small aggregates over the marts.

Top-k reports keep ``orderBy().limit()`` (TakeOrderedAndProject: each task
keeps its own top k, the driver merges k per task) with the group key as a
tiebreak so the cut is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import stats as S


def kpis(fct_orders: DataFrame) -> DataFrame:
    """BI1: order-fact KPIs; orders = all order rows (F11)."""
    return fct_orders.agg(
        F.sum("gross_revenue").alias("revenue"),
        F.sum("gross_margin_amount").alias("gross_margin"),
        F.sum("n_line_items").alias("units"),
        F.count(F.lit(1)).alias("orders"),
    ).withColumn("aov", X.ratio("revenue", "orders"))


def category_performance(mart_pp: DataFrame, top: int = 15) -> DataFrame:
    """BI2: revenue, margin, units and margin pct by category, top by revenue."""
    g = mart_pp.groupBy("category").agg(
        F.sum("gross_revenue").alias("revenue"), F.sum("gross_margin_amount").alias("margin"),
        F.sum("units_sold").alias("units"))
    g = g.withColumn("margin_pct", X.ratio("margin", "revenue"))
    return g.orderBy(F.col("revenue").desc_nulls_last(), F.col("category").asc_nulls_first()).limit(top)


def monthly_trend(mart_pp: DataFrame) -> DataFrame:
    """BI3."""
    return mart_pp.groupBy("month_start_date").agg(
        F.sum("gross_revenue").alias("revenue"), F.sum("units_sold").alias("units")) \
        .orderBy("month_start_date")


def abc_summary(health: DataFrame) -> DataFrame:
    """BI4: SKUs, capital and dead-stock count per ABC class."""
    return health.groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("skus"), F.sum("inventory_cost_on_hand").alias("capital"),
        X.countif(F.col("is_dead_stock")).alias("dead_stock")).orderBy("abc_class")


def rfm_segments(rfm: DataFrame) -> DataFrame:
    """BI5: customers and value per segment."""
    return rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("value")) \
        .orderBy(F.col("customers").desc(), "segment")


def sla_by_centre(sla: DataFrame) -> DataFrame:
    """BI6: unweighted mean of the monthly means per centre (rounded to 1e-6,
    as a mean of floats depends on summation order)."""
    g = sla.filter(F.col("distribution_center_name").isNotNull()) \
        .groupBy("distribution_center_name").agg(
            S.mean("avg_hours_to_ship").alias("hrs_ship"),
            S.mean("avg_hours_to_deliver").alias("hrs_deliver"))
    return g.select("distribution_center_name",
                    S.round_half_away(F.col("hrs_ship"), 6).alias("hrs_ship"),
                    S.round_half_away(F.col("hrs_deliver"), 6).alias("hrs_deliver")) \
        .orderBy("hrs_ship")


def recommendation_status(recs: DataFrame) -> DataFrame:
    """BI7."""
    return recs.groupBy("inventory_status").agg(
        F.count(F.lit(1)).alias("skus"), F.sum("inventory_cost_on_hand").alias("capital")) \
        .orderBy(F.col("skus").desc(), "inventory_status")


def forecast_by_category(forecast: DataFrame, top: int = 15) -> DataFrame:
    """BI8: total forecast units over the horizon, top categories."""
    return forecast.groupBy("category").agg(F.sum("predicted_units").alias("forecast_8w")) \
        .orderBy(F.col("forecast_8w").desc(), "category").limit(top)
