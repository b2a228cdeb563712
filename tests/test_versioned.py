"""SNK3, SNK7: tables that are rebuilt from themselves and switched atomically."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.operators import scd2
from shelfline.operators.versioned import ConcurrentRun, VersionedTable


def _ids(table):
    return sorted(r.id for r in table.read().collect())


def test_a_table_is_rebuilt_from_itself(spark, tmp_table):
    t = VersionedTable(spark, tmp_table)
    assert t.current() is None and t.read() is None
    assert t.replace(lambda old: spark.range(3)) == 1
    for n in (2, 3):
        assert t.replace(lambda old: old.unionByName(spark.range(n * 10, n * 10 + 1))) == n
    assert _ids(t) == [0, 1, 2, 20, 30]
    assert sorted(r.id for r in t.read(1).collect()) == [0, 1, 2]
    again = VersionedTable(spark, tmp_table)  # another session's view of it
    assert _ids(again) == [0, 1, 2, 20, 30]
    assert len(again.vacuum(keep=2)) == 1 and _ids(t) == [0, 1, 2, 20, 30]
    assert [n for n, _ in t.versions()] == [2, 3] and t.read(1) is None
    assert t.replace(lambda old: old.limit(0)) == 4 and _ids(t) == [] and t.read().columns == ["id"]


def test_a_run_killed_before_the_switch_changes_nothing(spark, tmp_table, monkeypatch):
    t = VersionedTable(spark, tmp_table)
    t.replace(lambda old: spark.range(3))

    def killed(number, folder):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(t, "_switch", killed)
        with pytest.raises(KeyboardInterrupt):
            t.replace(lambda old: old.filter("id > 0"))
    assert _ids(t) == [0, 1, 2]
    with pytest.raises(Exception, match="boom"):  # and one that fails while writing
        t.replace(lambda old: old.select(F.when(F.col("id") > 1, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id")))
    assert _ids(t) == [0, 1, 2]
    assert t.replace(lambda old: old.filter("id > 1")) == 2 and _ids(t) == [2]
    assert len(t.vacuum()) == 3 and _ids(t) == [2]


def test_of_two_runs_at_once_one_fails(spark, tmp_table):
    a, b = VersionedTable(spark, tmp_table), VersionedTable(spark, tmp_table)
    a.replace(lambda old: spark.range(1))

    def slow(old):
        b.replace(lambda o: o.unionByName(spark.range(5, 6)))
        return old.unionByName(spark.range(9, 10))
    with pytest.raises(ConcurrentRun):
        a.replace(slow)
    assert _ids(a) == [0, 5]


def test_stored_snapshot_over_runs(spark, tmp_table):
    """Insert, change, vanish, return, re-run: each run reads what the last stored."""
    t = VersionedTable(spark, tmp_table)
    schema = "product_id long, product_name string, cost double, retail_price double"
    day = lambda n: dt.datetime(2020, 1, n)
    states = {1: [(1, "a", 1.0, 2.0), (2, "b", 1.0, 2.0)], 2: [(1, "a", 5.0, 2.0), (2, "B", 1.0, 2.0), (3, "c", 1.0, 2.0)],
              3: [(1, "a", 5.0, 2.0), (3, "c", 1.0, 9.0)], 4: [(1, "a", 1.0, 2.0), (2, "b", 7.0, 2.0), (3, "c", 1.0, 9.0)]}
    for n in (1, 2, 2, 3, 4, 4):
        scd2.run_snapshot(t, spark.createDataFrame(states[n], schema), day(n))
    got = {(r.product_id, r.product_name, r.cost, r.retail_price, r.valid_from.day, r.valid_to and r.valid_to.day)
           for r in t.read().collect()}
    assert got == {(1, "a", 1.0, 2.0, 1, 2), (1, "a", 5.0, 2.0, 2, 4), (1, "a", 1.0, 2.0, 4, None),
                   (2, "b", 1.0, 2.0, 1, 4), (2, "b", 7.0, 2.0, 4, None), (3, "c", 1.0, 2.0, 2, 3), (3, "c", 1.0, 9.0, 3, None)}
    assert t.read().count() == len(got) and t.current()[0] == 6
