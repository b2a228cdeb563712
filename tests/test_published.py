"""SNK6, SNK11, SNK12, SRC8: published tables, the controlled copy and its drift."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline import sources
from shelfline.operators import controlled_copy
from shelfline.operators.versioned import TableExists, VersionedTable
from shelfline.plans import forecast
from shelfline.sources.schemas import SCHEMAS

WEEK = dt.date(2001, 8, 6)


def _forecast(spark, units):
    return spark.createDataFrame([("a", WEEK, 1, u, None, "m") for u in units],
                                 "category string, forecast_week date, week_ahead int, predicted_units double, "
                                 "generated_at timestamp_ntz, model string")


def test_a_forecast_is_replaced_whole_and_read_by_its_schema(spark, tmp_table, monkeypatch):
    assert sources.read_forecast(spark, tmp_table) is None
    forecast.write_forecast(_forecast(spark, [1.0, 2.0]), tmp_table)
    forecast.write_forecast(_forecast(spark, [3.0]).withColumn("extra", F.lit(1)), tmp_table)
    got = sources.read_forecast(spark, tmp_table)
    assert [f.dataType for f in got.schema] == [f.dataType for f in SCHEMAS["ml_forecast_demand"]]
    assert [r.predicted_units for r in got.collect()] == [3.0]
    monkeypatch.setattr(VersionedTable, "_switch", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        forecast.write_forecast(_forecast(spark, [9.0]), tmp_table)
    assert [r.predicted_units for r in sources.read_forecast(spark, tmp_table).collect()] == [3.0]


def test_the_copy_is_made_once(spark, tmp_table):
    t = VersionedTable(spark, tmp_table)
    assert controlled_copy.create_once(t, spark.range(3))
    assert not controlled_copy.create_once(t, spark.range(9))
    with pytest.raises(TableExists):
        t.create(spark.range(9))
    assert t.read().count() == 3 and len(t.versions()) == 1


def test_drift(spark):
    old = spark.createDataFrame([(1, "a", 1.0, 5), (2, "b", None, 5), (3, "c", 3.0, 5), (4, None, 4.0, 5)],
                                "id long, name string, cost double, old_only int")
    new = spark.createDataFrame([(1, "a", 1.0, 7), (2, "B", 2.0, 7), (4, None, None, 7), (5, "e", 1.0, 7)],
                                "id long, name string, cost double, new_only int")
    got = {tuple(r) for r in controlled_copy.drift(old, new, "id").collect()}
    assert got == {(2, "changed", "name,cost"), (3, "vanished", None), (4, "changed", "cost"), (5, "added", None)}
    assert controlled_copy.drift(old, old, "id").isEmpty()
    assert {r.change for r in controlled_copy.drift(old.limit(0), new, "id").collect()} == {"added"}


def test_metrics_report_is_read_back(spark, tmp_table):
    scores = spark.createDataFrame([("1", 2.5, 0.1, 4, WEEK), ("2", 3.5, 0.2, 4, WEEK), ("overall", 3.0, 0.15, 8, WEEK)],
                                   "horizon string, mae double, wape double, n_points long, valid_start date")
    forecast.write_metrics(scores, tmp_table, 2, dt.datetime(2001, 8, 2, 7))
    got = {tuple(r) for r in forecast.read_metrics(spark, tmp_table).collect()}
    assert got == {(1, 2.5, 0.1, WEEK, 8, 2), (2, 3.5, 0.2, WEEK, 8, 2), (None, 3.0, 0.15, WEEK, 8, 2)}
