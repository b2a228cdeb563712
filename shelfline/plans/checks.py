"""The project's data-quality suite: column tests (DQ1-DQ6) and the five
singular business tests (DQ7-DQ11), each with a Spark and a SQL form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.quality import Check


def _uq_nn(table, col):
    return [Check(f"unique_{table}_{col}", table, "unique", (col,)),
            Check(f"not_null_{table}_{col}", table, "not_null", (col,))]


def _rel(table, col, parent, pcol):
    return Check(f"relationships_{table}_{col}__{parent}", table, "relationships", (col,),
                 parent=parent, parent_column=pcol)


def _combo(table, *cols):
    return Check(f"unique_combination_{table}", table, "unique_combination", tuple(cols))


def _between(table, col, lo=None, hi=None):
    return Check(f"between_{table}_{col}", table, "between", (col,), min_value=lo, max_value=hi)


def _accepted(table, col, values):
    return Check(f"accepted_values_{table}_{col}", table, "accepted_values", (col,),
                 values=tuple(values))


STAGING = (
    _uq_nn("stg_orders", "order_id") + _uq_nn("stg_order_items", "order_item_id")
    + _uq_nn("stg_products", "product_id") + _uq_nn("stg_users", "user_id")
    + _uq_nn("stg_inventory_items", "inventory_item_id")
    + _uq_nn("stg_distribution_centers", "distribution_center_id")
    + _uq_nn("stg_events", "event_id")
)

SNAPSHOT = _uq_nn("snap_products", "scd_id") + [
    Check("not_null_snap_products_product_id", "snap_products", "not_null", ("product_id",))]

CORE = (
    _uq_nn("dim_products", "product_id") + _uq_nn("dim_customers", "customer_id")
    + _uq_nn("dim_distribution_centers", "distribution_center_id") + _uq_nn("dim_dates", "date_day")
    + _uq_nn("fct_order_items", "order_item_id")
    + [_rel("fct_order_items", "user_id", "dim_customers", "customer_id"),
       _rel("fct_order_items", "product_id", "dim_products", "product_id"),
       _rel("fct_order_items", "distribution_center_id", "dim_distribution_centers",
            "distribution_center_id"),
       _rel("fct_order_items", "order_date", "dim_dates", "date_day"),
       _between("fct_order_items", "sale_price", 0)]
    + _uq_nn("fct_orders", "order_id")
    + [_rel("fct_orders", "user_id", "dim_customers", "customer_id"),
       _rel("fct_orders", "order_date", "dim_dates", "date_day"),
       _combo("fct_inventory_snapshot", "snapshot_date", "product_id", "distribution_center_id"),
       _rel("fct_inventory_snapshot", "product_id", "dim_products", "product_id"),
       _rel("fct_inventory_snapshot", "distribution_center_id", "dim_distribution_centers",
            "distribution_center_id"),
       _rel("fct_inventory_snapshot", "snapshot_date", "dim_dates", "date_day")]
)

MARTS = [
    _combo("mart_product_performance", "product_id", "month_start_date"),
    _between("mart_product_performance", "units_sold", 0),
    _combo("mart_inventory_health", "product_id", "distribution_center_id"),
    _accepted("mart_inventory_health", "abc_class", ["A", "B", "C"]),
    _between("mart_inventory_health", "sell_through_90d", 0, 1),
    *_uq_nn("mart_customer_rfm", "customer_id"),
    _accepted("mart_customer_rfm", "segment",
              ["Champions", "Loyal", "New", "At Risk", "Hibernating", "Others"]),
    _between("mart_customer_rfm", "r_score", 1, 5),
    _combo("mart_demand_features", "category", "week_start_date"),
    _between("mart_demand_features", "units_sold", 0),
    _combo("mart_inventory_recommendations", "product_id", "distribution_center_id"),
    _between("mart_inventory_recommendations", "category_share", 0, 1),
    _between("mart_inventory_recommendations", "suggested_reorder_qty", 0),
    _accepted("mart_inventory_recommendations", "inventory_status",
              ["Stockout risk", "Reorder", "Healthy", "Overstock"]),
    _combo("mart_fulfillment_sla", "distribution_center_id", "month_start_date"),
    _between("mart_fulfillment_sla", "pct_delivered", 0, 1),
]


# ---- singular tests: failing rows (pass = 0 rows) ---------------------------

def historical_cost_differs(fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    """DQ7 (warn): one row only if no sale was priced at a cost other than today's."""
    p = dim_products.select(F.col("product_id").alias("_p"), F.col("cost").alias("_cur"))
    n = (fct.join(p, fct.product_id == p._p, "inner")
            .filter(F.col("product_cost_at_sale").isNotNull()
                    & (F.col("product_cost_at_sale") != F.col("_cur")))
            .agg(F.count(F.lit(1)).alias("n_different")))
    return n.filter(F.col("n_different") == 0)


def margin_within_range(fct: DataFrame) -> DataFrame:
    """DQ8: unit cost above three times the sale price."""
    return fct.filter((F.col("sale_price") > 0) & F.col("cost").isNotNull()
                      & (F.col("cost") > F.col("sale_price") * 3)) \
        .select("order_item_id", "sale_price", "cost", "gross_margin_amount")


def no_orphan_order_items(fct: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """DQ9: lines whose order is missing from the order fact."""
    o = fct_orders.select(F.col("order_id").alias("_o"))
    return fct.join(o, fct.order_id == o._o, "left_anti").select("order_item_id", "order_id")


def revenue_reconciles(mart_pp: DataFrame, fct: DataFrame) -> DataFrame:
    """DQ10: mart revenue equals fact revenue within 1."""
    fact = fct.select(F.sum("sale_price")).scalar()
    m = mart_pp.agg(F.sum("gross_revenue").alias("mart_revenue")).withColumn("fact_revenue", fact)
    return m.filter(F.abs(F.col("mart_revenue") - F.col("fact_revenue")) > 1)


def sales_have_cost(fct: DataFrame) -> DataFrame:
    """DQ11: sold lines without a unit cost."""
    return fct.filter(F.col("sale_price").isNotNull() & F.col("cost").isNull()) \
        .select("order_item_id", "order_id", "sale_price", "cost")


SINGULAR_SQL = {
    "dq_historical_cost_differs": """
      SELECT n_different FROM (
        SELECT CAST(count(*) AS BIGINT) AS n_different FROM fct_order_items f
        JOIN dim_products p ON f.product_id = p.product_id
        WHERE f.product_cost_at_sale IS NOT NULL AND f.product_cost_at_sale <> p.cost)
      WHERE n_different = 0""",
    "dq_margin_within_range": """
      SELECT order_item_id, sale_price, cost, gross_margin_amount FROM fct_order_items
      WHERE sale_price > 0 AND cost IS NOT NULL AND cost > sale_price * 3""",
    "dq_no_orphan_order_items": """
      SELECT oi.order_item_id, oi.order_id FROM fct_order_items oi
      LEFT JOIN fct_orders o ON oi.order_id = o.order_id WHERE o.order_id IS NULL""",
    "dq_revenue_reconciles": """
      SELECT m.mart_revenue, f.fact_revenue
      FROM (SELECT sum(gross_revenue) AS mart_revenue FROM mart_product_performance) m
      CROSS JOIN (SELECT sum(sale_price) AS fact_revenue FROM fct_order_items) f
      WHERE abs(m.mart_revenue - f.fact_revenue) > 1""",
    "dq_sales_have_cost": """
      SELECT order_item_id, order_id, sale_price, cost FROM fct_order_items
      WHERE sale_price IS NOT NULL AND cost IS NULL""",
}


#: severity of a singular test that finds rows (the others: error)
SINGULAR_SEVERITY = {"dq_historical_cost_differs": "warn"}


def singular_status(found: dict[str, DataFrame]) -> DataFrame:
    """One row per singular test: failing rows, severity and status."""
    parts = [rows.agg(F.count(F.lit(1)).alias("n_failed")).select(
        F.lit(name).alias("test_name"), F.lit(SINGULAR_SEVERITY.get(name, "error")).alias("severity"), "n_failed")
        for name, rows in found.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", quality.status(F.col("n_failed"), F.col("severity")))


#: every kind of check on inputs that violate it: a line fact against the orders
#: that were not cancelled, with bounds tighter than the data
VIOLATED = [
    Check("orphan_lines", "lines", "relationships", ("order_id",), parent="orders_kept",
                  parent_column="order_id"),
    Check("order_repeats", "lines", "unique", ("order_id",), severity="warn"),
    Check("order_status_repeats", "lines", "unique_combination", ("order_id", "status")),
    Check("delivered_missing", "lines", "not_null", ("delivered_at",), severity="warn"),
    Check("status_not_final", "lines", "accepted_values", ("status",), values=("Complete", "Returned")),
    Check("price_out_of_bounds", "lines", "between", ("sale_price",), min_value=1000.0, max_value=2000.0),
    Check("cost_over_half", "lines", "expression", expression="cost > sale_price * 0.5"),
]
