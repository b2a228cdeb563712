"""SNK7 snapshot runs and the JN2 as-of lookup."""

import datetime as dt

from pyspark.sql import functions as F

from shelfline.operators import scd2

T0, T1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
SCHEMA = "product_id long, product_name string, cost double, retail_price double"


def test_snapshot_runs(spark):
    s0 = spark.createDataFrame([(1, "a", 10.0, 20.0), (2, "b", 5.0, 9.0), (3, "c", None, 7.0),
                                (4, "d", 1.0, 2.0)], SCHEMA)
    h0 = scd2.apply_snapshot(s0, None, T0)
    assert h0.filter("valid_to is null").count() == 4
    s1 = spark.createDataFrame([(1, "a", 11.0, 20.0),      # cost changed
                                (2, "B-renamed", 5.0, 9.0),  # name only: no new version
                                (3, "c", 4.0, 7.0),          # NULL -> value
                                (5, "e", 3.0, 6.0)],         # new key; 4 vanished
                               SCHEMA)
    h1 = scd2.apply_snapshot(s1, h0, T1)
    rows = {(r.product_id, r.valid_from, r.valid_to): r for r in h1.collect()}
    assert rows[(1, T0, T1)].cost == 10.0 and rows[(1, T1, None)].cost == 11.0
    assert (2, T0, None) in rows and rows[(2, T0, None)].product_name == "b"
    assert rows[(3, T0, T1)].cost is None and rows[(3, T1, None)].cost == 4.0
    assert (4, T0, None) in rows            # vanished key stays open
    assert (5, T1, None) in rows
    assert h1.count() == 7
    # rerun with the same state and time changes nothing
    h2 = scd2.apply_snapshot(s1, h1, T1)
    assert h2.exceptAll(h1).count() == 0 and h1.exceptAll(h2).count() == 0
    # no overlap: one open version per key
    assert h1.filter("valid_to is null").groupBy("product_id").count().filter("count > 1").count() == 0
    assert h1.select("scd_id").distinct().count() == 7


def test_as_of_lookup(spark):
    hist = spark.createDataFrame([
        (1, 10.0, dt.datetime(1996, 1, 1), dt.datetime(1998, 1, 1)),
        (1, 20.0, dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1)),
        (1, 30.0, dt.datetime(2000, 1, 1), None),
        (2, 5.0, dt.datetime(1996, 1, 1), None),
    ], "product_id long, cost double, valid_from timestamp_ntz, valid_to timestamp_ntz")
    sales = spark.createDataFrame([
        (1, 1, dt.datetime(1995, 6, 1)),   # before the first version -> version 1
        (2, 1, dt.datetime(1998, 1, 1)),   # exactly at valid_from -> version 2
        (3, 1, dt.datetime(1999, 12, 31, 23, 59)),
        (4, 1, dt.datetime(2000, 1, 1)),   # at valid_to of v2 -> v3
        (5, 2, dt.datetime(2005, 1, 1)),
        (6, 9, dt.datetime(2005, 1, 1)),   # no history
        (7, 1, None),                      # no time
    ], "line long, product_id long, created_at timestamp_ntz")
    got = {r.line: r.cost_at for r in scd2.as_of_value(sales, hist, "created_at", out="cost_at").collect()}
    assert got == {1: 10.0, 2: 20.0, 3: 20.0, 4: 30.0, 5: 5.0, 6: None, 7: None}


def test_history_as_of_reopens_versions(spark):
    hist = spark.createDataFrame([
        (1, 10.0, dt.datetime(1996, 1, 1), dt.datetime(2000, 1, 1)),
        (1, 30.0, dt.datetime(2000, 1, 1), None),
    ], "product_id long, cost double, valid_from timestamp_ntz, valid_to timestamp_ntz")
    before = scd2.history_as_of(hist, dt.datetime(2000, 1, 1)).collect()
    assert len(before) == 1 and before[0].valid_to is None


def test_as_of_join_splits_a_hot_product(spark):
    """80 % of the events on one product: the final plan splits that partition."""
    from pyspark.sql import functions as F
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        day = F.lit("2024-01-01").cast("timestamp_ntz")
        history = spark.range(50).select(F.col("id").alias("product_id"), F.col("id").cast("double").alias("cost"),
                                         day.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
        facts = spark.range(0, 60_000, 1, 16).select(
            "id", F.when(F.col("id") % 5 < 4, 7).otherwise(F.col("id") % 50).alias("product_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("note"), day.alias("at"))
        got = scd2.as_of_value(facts, history, "at")
        assert got.filter("value_at_event = product_id").count() == 60_000
        got.write.format("noop").mode("overwrite").save()
        rows = got.collect()
        assert len(rows) == 60_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
