"""Core dimensions and facts (MOD1-MOD9).

Each function is ``DataFrame(s) -> DataFrame`` and lazy; money stays
DECIMAL inside so totals are exact whatever the task order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import inventory, scd2


def customer_orders(stg_orders: DataFrame) -> DataFrame:
    """MOD1 / AGG1: every order counts, cancelled included."""
    return stg_orders.groupBy("user_id").agg(
        F.min("created_at").alias("first_order_at"),
        F.max("created_at").alias("most_recent_order_at"),
        F.count(F.lit(1)).alias("lifetime_orders"))


def dim_products(stg_products: DataFrame) -> DataFrame:
    """MOD3 / PRJ8: margin amount and pct (pct null when the price is 0)."""
    margin = F.col("retail_price") - F.col("cost")
    return stg_products.select(
        "product_id", "distribution_center_id", "product_name", "category", "brand",
        "department", "sku", "cost", "retail_price",
        margin.alias("base_margin_amount"),
        X.ratio(margin, "retail_price").alias("base_margin_pct"))


def dim_customers(stg_users: DataFrame, cust_orders: DataFrame) -> DataFrame:
    """MOD4 / JN4 / PRJ10: customers without orders stay, with 0 orders."""
    u = stg_users.alias("u")
    c = cust_orders.alias("c")
    return u.join(c, F.col("u.user_id") == F.col("c.user_id"), "left").select(
        F.col("u.user_id").alias("customer_id"),
        "u.first_name", "u.last_name", "u.email", "u.age", "u.gender", "u.country",
        "u.state", "u.city", "u.postal_code", "u.traffic_source",
        F.col("u.created_at").alias("signed_up_at"),
        "c.first_order_at", "c.most_recent_order_at",
        F.coalesce(F.col("c.lifetime_orders"), F.lit(0)).alias("lifetime_orders"),
        F.col("c.first_order_at").isNotNull().alias("has_ordered"))


def dim_distribution_centers(stg_dcs: DataFrame) -> DataFrame:
    """MOD5 / PRJ9: geometry dropped."""
    return stg_dcs.select("distribution_center_id", "distribution_center_name",
                          "latitude", "longitude")


def order_items_enriched(stg_items: DataFrame, stg_units: DataFrame,
                         product_history: DataFrame) -> DataFrame:
    """MOD2: unit cost from the inventory unit (JN1), product cost valid at the
    time of sale from the versioned history (JN2), and both margins (PRJ12)."""
    units = stg_units.select(F.col("inventory_item_id").alias("_unit_id"),
                             "distribution_center_id", "cost")
    j = stg_items.join(units, stg_items.inventory_item_id == units._unit_id, "left")
    j = scd2.as_of_value(j, product_history, "created_at", "product_id", "cost",
                         "product_cost_at_sale")
    return j.select(
        "order_item_id", "order_id", "user_id", "product_id", "inventory_item_id",
        "distribution_center_id", "status", "sale_price", "cost",
        (F.col("sale_price") - F.col("cost")).alias("gross_margin_amount"),
        "product_cost_at_sale",
        (F.col("sale_price") - F.col("product_cost_at_sale")).alias("gross_margin_at_sale"),
        "created_at", "shipped_at", "delivered_at", "returned_at")


def fct_order_items(enriched: DataFrame, since: dt.date | None = None) -> DataFrame:
    """MOD7 / PRJ11; ``since`` is the incremental cutoff (FLT10), None = full."""
    df = enriched.select(
        "order_item_id", "order_id", "user_id", "product_id", "distribution_center_id",
        "inventory_item_id", X.to_day("created_at").alias("order_date"), "status",
        F.col("created_at").alias("ordered_at"), "shipped_at", "delivered_at",
        "returned_at", "sale_price", "cost", "gross_margin_amount",
        "product_cost_at_sale", "gross_margin_at_sale")
    if since is not None:
        df = df.filter(F.col("order_date") >= F.lit(since))
    return df


def order_totals(enriched: DataFrame) -> DataFrame:
    """AGG2: per-order line count and money totals.  The few lines of an order
    seldom meet in one map task, so three plain columns a line are shuffled
    instead of partial sums, which would be three wide decimals and a count."""
    lines = enriched.select("order_id", "sale_price", "cost").repartition("order_id")
    return lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_line_items"),
        F.sum("sale_price").alias("gross_revenue"),
        F.sum("cost").alias("total_cost"),
        F.sum(F.col("sale_price") - F.col("cost")).alias("gross_margin_amount"))


def fct_orders(stg_orders: DataFrame, enriched: DataFrame,
               since: dt.date | None = None, line_lead_days: int = 1) -> DataFrame:
    """MOD8 / JN3: orders without lines keep null totals; ``since`` is the
    incremental cutoff: only lines of the slice's orders are summed.  Where the
    lines carry their ``order_date``, those dated more than ``line_lead_days``
    before the cutoff are not read (a line may be entered so long before its
    order)."""
    o = stg_orders
    if since is not None:
        o = o.filter(X.to_day("created_at") >= F.lit(since))
        if "order_date" in enriched.columns:
            first = since - dt.timedelta(days=line_lead_days)
            enriched = enriched.filter(F.col("order_date") >= F.lit(first))
        ids = o.select(F.col("order_id").alias("_slice"))
        enriched = enriched.join(ids, enriched.order_id == ids._slice, "left_semi")
    t = order_totals(enriched).withColumnRenamed("order_id", "_oid")
    j = o.join(t, o.order_id == t._oid, "left")
    return j.select(
        "order_id", "user_id", X.to_day("created_at").alias("order_date"), "status",
        "gender", F.col("created_at").alias("ordered_at"), "shipped_at", "delivered_at",
        "returned_at", "num_of_items", "n_line_items", "gross_revenue", "total_cost",
        "gross_margin_amount")


def inventory_units(stg_units: DataFrame) -> DataFrame:
    return stg_units.select("product_id", "distribution_center_id", "cost",
                            X.to_day("created_at").alias("in_date"),
                            X.to_day("sold_at").alias("out_date"))


def fct_inventory_snapshot(stg_units: DataFrame, window_start: dt.date, as_of: dt.date,
                           cal_start: dt.date, cal_end: dt.date) -> DataFrame:
    """MOD9: dense product x centre x day balances from ``window_start`` to ``as_of``.

    For an incremental run pass ``window_start = cutoff``: the opening balance
    keeps the running totals exact (F6).
    """
    b = inventory.daily_balances(inventory_units(stg_units), window_start, as_of,
                                 cal_start, cal_end)
    return b.select("product_id", "distribution_center_id", "snapshot_date",
                    "units_on_hand", "inventory_cost_on_hand")


def inventory_latest(stg_units: DataFrame, window_start: dt.date, as_of: dt.date,
                     cal_start: dt.date, cal_end: dt.date) -> DataFrame:
    """FLT6 shortcut: the snapshot's last day without building the dense grid."""
    return inventory.latest_balances(inventory_units(stg_units), window_start, as_of,
                                     cal_start, cal_end)
