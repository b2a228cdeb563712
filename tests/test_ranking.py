"""K1 / K2: range-partitioned ntile and cumulative share equal the plain
single-partition windows (WIN3, WIN4, WIN9)."""

import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.operators import ranking
from shelfline.plans import marts


def _plain_ntile(df, k, keys):
    return df.withColumn("t", F.ntile(k).over(Window.orderBy(*keys)))


def test_ntile_formula_matches_for_small_and_odd_n(spark):
    for n in (1, 2, 4, 5, 6, 7, 11, 59, 101):
        df = spark.range(n).withColumn("v", (F.col("id") * 7) % 5)
        got = ranking.global_ntile(df, 5, ["v", "id"], "t", rows_per_bucket=3)
        want = _plain_ntile(df, 5, ["v", "id"])
        assert got.select("id", "t").exceptAll(want.select("id", "t")).count() == 0, n


def test_ntile_many_buckets_with_hot_value(spark):
    rnd = random.Random(3)
    rows = [(i, 7 if rnd.random() < 0.4 else rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v long")
    got = ranking.global_ntile(df, 5, ["v", "id"], "t", rows_per_bucket=100)
    want = _plain_ntile(df, 5, ["v", "id"])
    assert got.select("id", "t").exceptAll(want.select("id", "t")).count() == 0


def test_prefix_sum_rows(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(500)], "k long, x long")
    got, n, total = ranking.global_prefix(df, ["k"], "cum", measure="x", rows_per_bucket=37)
    want = df.withColumn("cum", F.sum("x").over(Window.orderBy("k").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)))
    assert n == 500 and total == sum(i % 3 for i in range(500))
    assert got.exceptAll(want).count() == 0


def test_rfm_quintiles_match_plain_windows_with_null_monetary(spark):
    rows = [(i, i % 13, 1 + i % 4, None if i % 50 == 0 else Decimal(i % 17)) for i in range(400)]
    base = spark.createDataFrame(rows, "customer_id long, recency_days int, frequency long, monetary decimal(22,2)")
    got = marts.scored_quintiles(base, rows_per_bucket=23)
    want = base.select(
        "customer_id",
        F.ntile(5).over(Window.orderBy(F.col("recency_days").desc_nulls_last(), "customer_id")).alias("r_score"),
        F.ntile(5).over(Window.orderBy(F.col("frequency").asc_nulls_first(), "customer_id")).alias("f_score"),
        F.ntile(5).over(Window.orderBy(F.col("monetary").asc_nulls_first(), "customer_id")).alias("m_score"))
    g = got.select("customer_id", "r_score", "f_score", "m_score")
    assert g.count() == 400
    assert g.exceptAll(want).count() == 0


def _plain_abc(rev):
    pct = (F.sum("revenue_12m").over(Window.orderBy(F.col("revenue_12m").desc())).cast("double")
           / F.sum("revenue_12m").over(Window.partitionBy()).cast("double"))
    return rev.select("product_id", F.when(pct <= 0.8, "A").when(pct <= 0.95, "B")
                      .otherwise("C").alias("abc_class"))


def test_abc_matches_plain_range_window_with_ties(spark):
    rnd = random.Random(5)
    rows = [(i, Decimal(rnd.choice([5, 10, 10, 10, 20, 40, 80, 160]))) for i in range(600)]
    rev = spark.createDataFrame(rows, "product_id long, revenue_12m decimal(22,2)")
    got = marts.abc_classes(rev, rows_per_bucket=3)
    assert got.exceptAll(_plain_abc(rev)).count() == 0


def test_abc_edges(spark):
    one = spark.createDataFrame([(1, Decimal(10))], "product_id long, revenue_12m decimal(22,2)")
    assert marts.abc_classes(one).first().abc_class == "C"  # single item crosses 100 %
    zero = spark.createDataFrame([(1, Decimal(0)), (2, Decimal(0))], "product_id long, revenue_12m decimal(22,2)")
    assert {r.abc_class for r in marts.abc_classes(zero).collect()} == {"C"}
    # equal revenues straddling the 80 % line share one class
    eq = spark.createDataFrame([(i, Decimal(10)) for i in range(10)], "product_id long, revenue_12m decimal(22,2)")
    assert {r.abc_class for r in marts.abc_classes(eq).collect()} == {"C"}
    two = spark.createDataFrame([(1, Decimal(80)), (2, Decimal(15)), (3, Decimal(5))],
                                "product_id long, revenue_12m decimal(22,2)")
    got = {r.product_id: r.abc_class for r in marts.abc_classes(two).collect()}
    assert got == {1: "A", 2: "B", 3: "C"}


def test_rankings_at_default_settings_use_many_partitions(spark):
    rows = [(i, i % 13, 1 + i % 4, Decimal(i % 17)) for i in range(2000)]
    base = spark.createDataFrame(rows, "customer_id long, recency_days int, frequency long, monetary decimal(22,2)")
    got = marts.scored_quintiles(base)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 1000
    abc = marts.abc_classes(spark.createDataFrame([(i, Decimal(i)) for i in range(2000)],
                                                  "product_id long, revenue_12m decimal(22,2)"))
    assert "SinglePartition" not in abc._jdf.queryExecution().executedPlan().toString()


def test_prefix_of_empty_table(spark):
    empty = spark.createDataFrame([], "k long, x long")
    got, n, total = ranking.global_prefix(empty, ["k"], "cum", measure="x")
    assert (got.count(), n, total) == (0, 0, 0)
    assert ranking.global_ntile(empty, 5, ["k"], "t").count() == 0


def test_ntile_property_random(spark):
    """Any data, any bucket size: the bucketed ntile equals the plain one."""
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.integers(0, 6), min_size=1, max_size=120), st.integers(2, 40), st.integers(2, 7))
    def check(vals, rpb, k):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v long")
        got = ranking.global_ntile(df, k, ["v", "id"], "t", rows_per_bucket=rpb)
        want = _plain_ntile(df, k, ["v", "id"])
        assert got.select("id", "t").exceptAll(want.select("id", "t")).count() == 0
    check()
