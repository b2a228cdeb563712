"""Edge fixtures for the dims, facts and marts (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from shelfline.functions import expr as X
from shelfline.functions import stats as S
from shelfline.plans import core, marts, metrics, reports

TS = dt.datetime


def test_hours_truncate_toward_zero(spark):
    df = spark.createDataFrame([(TS(2000, 1, 1, 0, 0), TS(2000, 1, 1, 0, 59)),
                                (TS(2000, 1, 1, 0, 0), TS(2000, 1, 1, 1, 0)),
                                (TS(2000, 1, 1, 5, 0), TS(2000, 1, 1, 2, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = [r.h for r in df.select(X.whole_hours_between("b", "a").alias("h")).collect()]
    assert got == [0, 1, -2]


def test_week_functions(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 12, 29),)], "d date")
    r = df.select(X.week_start("d").alias("w"), X.iso_week("d").alias("iw"), F.year("d").alias("y")).collect()
    assert r[0].w == dt.date(2024, 12, 30) and r[0].iw == 1 and r[0].y == 2024  # F9
    assert r[1].w == dt.date(2024, 12, 23)


def test_safe_divide_and_ratio(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("0.00")), (Decimal("1.00"), Decimal("4.00"))],
                               "a decimal(12,2), b decimal(12,2)")
    got = [r.q for r in df.select(X.ratio("a", "b").alias("q")).collect()]
    assert got == [None, 0.25]


def test_dim_customers_keeps_customers_without_orders(spark):
    users = spark.createDataFrame([(1, "x", "y", "F"), (2, "p", "q", "M")],
                                  "user_id long, first_name string, last_name string, gender string")
    for c in ("email", "country", "state", "city", "postal_code", "traffic_source"):
        users = users.withColumn(c, F.lit(None).cast("string"))
    users = users.withColumn("age", F.lit(None).cast("long")).withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    orders = spark.createDataFrame([(10, 1, TS(2001, 1, 1)), (11, 1, TS(2001, 2, 1))],
                                   "order_id long, user_id long, created_at timestamp_ntz")
    dc = {r.customer_id: r for r in core.dim_customers(users, core.customer_orders(orders)).collect()}
    assert dc[1].lifetime_orders == 2 and dc[1].has_ordered
    assert dc[2].lifetime_orders == 0 and not dc[2].has_ordered and dc[2].first_order_at is None


def test_zero_price_margin_pct_is_null(spark):
    p = spark.createDataFrame([(1, 0, "n", None, "b", "d", "s", Decimal("5.00"), Decimal("0.00"))],
                              "product_id long, distribution_center_id long, product_name string, "
                              "category string, brand string, department string, sku string, "
                              "cost decimal(12,2), retail_price decimal(12,2)")
    r = core.dim_products(p).first()
    assert r.base_margin_pct is None and r.base_margin_amount == Decimal("-5.00")


def test_fct_orders_without_lines_have_null_totals(spark):
    o = spark.createDataFrame([(1, 7, "Complete", "F", TS(2001, 1, 1), None, None, None, 1),
                               (2, 7, "Shipped", "F", TS(2001, 1, 2), None, None, None, 1)],
                              "order_id long, user_id long, status string, gender string, created_at timestamp_ntz, "
                              "shipped_at timestamp_ntz, delivered_at timestamp_ntz, returned_at timestamp_ntz, "
                              "num_of_items long")
    items = spark.createDataFrame([(1, Decimal("10.00"), Decimal("4.00")), (1, Decimal("5.00"), None)],
                                  "order_id long, sale_price decimal(12,2), cost decimal(12,2)")
    got = {r.order_id: r for r in core.fct_orders(o, items).collect()}
    assert got[2].n_line_items is None and got[2].gross_revenue is None
    assert got[1].n_line_items == 2 and got[1].gross_revenue == Decimal("15.00")
    assert got[1].total_cost == Decimal("4.00") and got[1].gross_margin_amount == Decimal("6.00")


def test_rfm_segment_ladder(spark):
    df = spark.createDataFrame([(5, 5), (3, 3), (4, 1), (2, 4), (1, 1), (3, 2)], "r int, f int")
    got = [r.s for r in df.select(marts.rfm_segment(F.col("r"), F.col("f")).alias("s")).collect()]
    assert got == ["Champions", "Loyal", "New", "At Risk", "Hibernating", "Others"]


def test_window_stats_equal_definitions(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([3, 1, 4, 1, 5, 9, 2, 6])],
                               "c string, t int, u long")
    w = Window.partitionBy("c").orderBy("t").rowsBetween(-4, -1)
    r = df.select("t", S.window_mean("u", w).alias("m"), S.window_stddev_pop("u", w).alias("s"),
                  F.stddev_pop("u").over(w).alias("ref")).orderBy("t").collect()
    assert r[0].m is None and r[0].s is None and r[1].s == 0.0
    for row in r[1:]:
        assert abs(row.s - row.ref) < 1e-9


def test_metrics_query_matches_manual(spark):
    fct = spark.createDataFrame([
        (1, 1, dt.date(2001, 1, 5), "Complete", Decimal("10.00"), Decimal("3.00")),
        (2, 1, dt.date(2001, 1, 6), "Complete", Decimal("20.00"), Decimal("5.00")),
        (3, 2, dt.date(2001, 2, 1), "Shipped", Decimal("30.00"), Decimal("7.00")),
    ], "order_item_id long, order_id long, order_date date, status string, sale_price decimal(12,2), "
       "gross_margin_amount decimal(12,2)")
    r = {(x.metric_time, x.status): x for x in
         metrics.query(fct, ["revenue", "orders", "units_sold", "aov"], by=["status"], grain="month").collect()}
    jan = r[(dt.date(2001, 1, 1), "Complete")]
    assert jan.revenue == Decimal("30.00") and jan.orders == 1 and jan.units_sold == 2 and jan.aov == 30.0


def test_kpi_report_counts_orders_without_lines(spark):
    o = spark.createDataFrame([(Decimal("10.00"), Decimal("2.00"), 1), (None, None, None)],
                              "gross_revenue decimal(22,2), gross_margin_amount decimal(22,2), n_line_items long")
    r = reports.kpis(o).first()
    assert r.orders == 2 and r.aov == 5.0 and r.units == 1


def test_hours_and_literals_do_not_depend_on_session_zone(spark):
    """Inside a DST gap ``timestamp_diff`` on NTZ follows the session zone;
    interval arithmetic does not.  NTZ literals must not shift either."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2000-04-02 00:00:00", "2000-04-02 02:30:00"),
                                    ("2000-04-02 02:30:00", "2000-04-03 02:10:00")], "a string, b string") \
            .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        got = [r.h for r in df.select(X.whole_hours_between("b", "a").alias("h")).collect()]
        assert got == [2, 23]
        lit = spark.range(1).select(X.ntz(TS(1996, 1, 1)).alias("t")).first().t
        assert lit == TS(1996, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
