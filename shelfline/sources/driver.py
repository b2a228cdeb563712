"""Role mapping: present the driver's TPC-H-style tables as the retail sources.

The retail models expect seven source tables (orders, order_items, products,
users, inventory_items, distribution_centers, events) plus the versioned
product history.  The test data ships TPC-H-style tables instead, so this
module derives each role with plain DataFrame operations.  The same mapping is
written once more as SQL for the DuckDB oracle (``shelfline.oracle``); both use
integer and DECIMAL arithmetic only so the two agree exactly.

Fixed values of the mapping (chosen for the test data, not taken from anywhere):
  status: o_orderkey % 10 = 0 -> 'Cancelled'; else o_orderstatus F -> 'Complete',
          O -> 'Shipped', P -> 'Processing'
  product centre: p_partkey % 5; department: p_size <= 25 -> 'Women' else 'Men'
  product cost: retail_price * 0.60; sku: 'SKU-' || p_partkey
  line id: l_orderkey * 1000 + row number within the order
  units: one per line, cost = product cost + id % 7, in at order date minus
         l_quantity days, sold at the order date when l_linestatus = 'F';
         units with id % 97 = 0 are missing (lines without a unit cost)
  product versions: 1 + p_partkey % 3 versions from 1996-01-01, 1998-01-01,
         2000-01-01; version k costs the current cost - (versions - k) * 10
  events: created_at = ts - 8218 days, 'click' is read as 'cart'
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expr as X

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

VERSION_STARTS = (dt.datetime(1996, 1, 1), dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1))
VERSION_COST_STEP = Decimal("10")
EVENT_SHIFT_DAYS = 8218
MISSING_UNIT_MODULUS = 97
USER_SIGNUP_BASE = dt.datetime(1994, 1, 1)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """(table, bytes, time of the last change) of the tables' files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(sf_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for name in DRIVER_TABLES:
        where = path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        files = list(fs.listStatus(where)) if fs.exists(where) else []
        out.append((name, sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)))
    return tuple(out)


def _minutes(ts, n):
    return F.timestamp_add("MINUTE", n, ts)


def distribution_centers(region: DataFrame) -> DataFrame:
    return region.select(
        F.col("r_regionkey").cast("long").alias("id"),
        F.col("r_name").alias("name"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.lit(None).cast("string").alias("distribution_center_geom"),
    )


def products(part: DataFrame) -> DataFrame:
    retail = F.col("p_retailprice").cast("decimal(12,2)")
    return part.select(
        F.col("p_partkey").cast("long").alias("id"),
        (F.col("p_partkey") % 5).cast("long").alias("distribution_center_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("p_size") <= 25, "Women").otherwise("Men").alias("department"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        (retail * F.lit(Decimal("0.60"))).cast("decimal(12,2)").alias("cost"),
        retail.alias("retail_price"),
    )


def product_versions(part: DataFrame) -> DataFrame:
    """Versioned product history (the SCD2 table as of the last run)."""
    cur = products(part)
    n = (F.col("id") % 3 + 1).cast("int")
    starts = F.array(*[X.ntz(s) for s in VERSION_STARTS])
    v = cur.withColumn("n_versions", n).withColumn("k", F.explode(F.sequence(F.lit(1), n)))
    return v.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category", "brand", "department", "sku", "distribution_center_id",
        (F.col("cost") - (F.col("n_versions") - F.col("k")) * F.lit(VERSION_COST_STEP))
        .cast("decimal(12,2)").alias("cost"),
        "retail_price",
        F.element_at(starts, F.col("k")).alias("valid_from"),
        F.when(F.col("k") < F.col("n_versions"), F.element_at(starts, F.col("k") + 1))
        .alias("valid_to"),
    ).withColumn("scd_id", F.md5(F.concat_ws("|", F.col("product_id").cast("string"),
                                             F.col("valid_from").cast("string"))))


def users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    null_s = F.lit(None).cast("string")
    return c.select(
        F.col("c_custkey").cast("long").alias("id"),
        F.lit("Customer").alias("first_name"),
        F.col("c_custkey").cast("string").alias("last_name"),
        null_s.alias("email"),
        F.lit(None).cast("long").alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        null_s.alias("state"),
        null_s.alias("street_address"),
        null_s.alias("postal_code"),
        null_s.alias("city"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.col("c_mktsegment").alias("traffic_source"),
        F.timestamp_add("DAY", (F.col("c_custkey") % 365).cast("int"),
                        X.ntz(USER_SIGNUP_BASE)).alias("created_at"),
        null_s.alias("user_geom"),
    )


def _order_status() -> F.Column:
    return (F.when(F.col("o_orderkey") % 10 == 0, "Cancelled")
            .when(F.col("o_orderstatus") == "F", "Complete")
            .when(F.col("o_orderstatus") == "O", "Shipped")
            .when(F.col("o_orderstatus") == "P", "Processing"))


def orders(orders_t: DataFrame) -> DataFrame:
    o = orders_t.select("o_orderkey", "o_custkey", "o_orderstatus",
                        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"))
    o = o.withColumn("status", _order_status())
    shipped = F.when(F.col("status").isin("Complete", "Shipped"),
                     _minutes(F.col("created_at"), 60 * (6 + F.col("o_orderkey") % 60)))
    o = o.withColumn("shipped_at", shipped)
    delivered = F.when(F.col("status") == "Complete",
                       _minutes(F.col("shipped_at"), 60 * (24 + F.col("o_orderkey") % 72)))
    return o.select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.col("o_custkey").cast("long").alias("user_id"),
        "status",
        F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        "created_at",
        "shipped_at",
        delivered.alias("delivered_at"),
        F.lit(None).cast("timestamp_ntz").alias("returned_at"),
        (F.lit(1) + F.col("o_orderkey") % 4).cast("long").alias("num_of_item"),
    )


def lines(lineitem: DataFrame, orders_t: DataFrame) -> DataFrame:
    """Lines with their order attributes and a unique line id.

    The row number is partitioned by the order key, which is also the join key
    with orders, so the window and the join share one shuffle.  The ship date, last
    in the order of an order's lines, is left out of it: lines that tie before it
    are equal in all that the roles read.
    """
    others = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    w = Window.partitionBy("l_orderkey").orderBy(*[F.col(c).asc_nulls_first() for c in others])
    li = lineitem.select("l_orderkey", *others).withColumn("rn", F.row_number().over(w))
    o = orders_t.select(F.col("o_orderkey"), "o_custkey", "o_orderstatus",
                        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"))
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")
    j = j.withColumn("o_orderkey", F.col("l_orderkey"))
    return (j.withColumn("id", F.when(F.col("rn") > 999, F.raise_error(F.lit("an order of over 999 lines")).cast("long"))
                         .otherwise(F.col("l_orderkey").cast("long") * 1000 + F.col("rn")))
             .withColumn("status", _order_status())
             .select("id", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_returnflag", "l_linestatus", "o_custkey", "created_at", "status"))


def order_items(base_lines: DataFrame) -> DataFrame:
    """Order lines from the shared line base (``lines``)."""
    j = base_lines
    shipped = F.when(
        F.col("status").isin("Complete", "Shipped"),
        _minutes(F.col("created_at"),
                 60 * (6 + (7 * F.col("l_linenumber") + F.col("l_orderkey")) % 60)
                 + F.col("l_partkey") % 60))
    j = j.withColumn("shipped_at", shipped)
    delivered = F.when(F.col("status") == "Complete",
                       _minutes(F.col("shipped_at"),
                                60 * (24 + F.col("id") % 72) + F.col("l_partkey") % 53))
    j = j.withColumn("delivered_at", delivered)
    returned = F.when((F.col("status") == "Complete") & (F.col("l_returnflag") == "R"),
                      F.timestamp_add("DAY", F.lit(7), F.col("delivered_at")))
    return j.select(
        F.col("id"),
        F.col("l_orderkey").cast("long").alias("order_id"),
        F.col("o_custkey").cast("long").alias("user_id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        F.col("id").alias("inventory_item_id"),
        "status",
        "created_at", "shipped_at", "delivered_at",
        returned.alias("returned_at"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("sale_price"),
    )


def inventory_items(base_lines: DataFrame, part: DataFrame, supplier: DataFrame,
                    nation: DataFrame) -> DataFrame:
    """One inventory unit per line (from the shared line base).  What comes from
    the line is computed before the joins, and the product's names come last, so
    a shuffle of the joins moves five numbers a unit."""
    j = base_lines.filter(F.col("id") % MISSING_UNIT_MODULUS != 0).select(
        "id", "l_partkey", "l_suppkey",
        F.timestamp_add("DAY", -F.col("l_quantity").cast("int"), F.col("created_at")).alias("in_at"),
        F.when(F.col("l_linestatus") == "F", F.col("created_at")).alias("sold_at"))
    prod = products(part).select(
        F.col("id").alias("p_id"), F.col("cost").alias("p_cost"), "category", "name",
        "brand", "department", "sku", "retail_price")
    sup = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left") \
        .select("s_suppkey", F.col("n_regionkey").cast("long").alias("centre"))
    j = (j.join(sup, j.l_suppkey == sup.s_suppkey, "left")
          .join(prod, j.l_partkey == prod.p_id, "left"))
    return j.select(
        F.col("id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        F.col("in_at").alias("created_at"),
        "sold_at",
        (F.col("p_cost") + (F.col("id") % 7)).cast("decimal(12,2)").alias("cost"),
        F.col("category").alias("product_category"),
        F.col("name").alias("product_name"),
        F.col("brand").alias("product_brand"),
        F.col("retail_price").alias("product_retail_price"),
        F.col("department").alias("product_department"),
        F.col("sku").alias("product_sku"),
        F.col("centre").alias("product_distribution_center_id"),
    )


def events(events_t: DataFrame) -> DataFrame:
    null_s = F.lit(None).cast("string")
    return events_t.select(
        F.col("event_id").cast("long").alias("id"),
        F.col("user_id").cast("long").alias("user_id"),
        null_s.alias("session_id"),
        F.lit(None).cast("long").alias("sequence_number"),
        F.timestamp_add("DAY", F.lit(-EVENT_SHIFT_DAYS), F.col("ts").cast("timestamp_ntz"))
        .alias("created_at"),
        null_s.alias("ip_address"), null_s.alias("city"), null_s.alias("state"),
        null_s.alias("postal_code"), null_s.alias("browser"), null_s.alias("traffic_source"),
        null_s.alias("uri"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type"))
        .alias("event_type"),
    )
