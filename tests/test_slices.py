"""FLT10, MOD7-MOD9: runs that read a slice equal the full build and prune their scans."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfline.operators import incremental, inventory
from shelfline.plans import core, slices

T = dt.datetime
LINE = ("order_item_id long, order_id long, user_id long, product_id long, inventory_item_id long, status string, "
        "created_at timestamp_ntz, shipped_at timestamp_ntz, delivered_at timestamp_ntz, returned_at timestamp_ntz, "
        "sale_price decimal(12,2)")
ORDER = ("order_id long, user_id long, status string, gender string, created_at timestamp_ntz, returned_at timestamp_ntz, "
         "shipped_at timestamp_ntz, delivered_at timestamp_ntz, num_of_items long")
UNIT = ("inventory_item_id long, product_id long, distribution_center_id long, cost decimal(12,2), "
        "created_at timestamp_ntz, sold_at timestamp_ntz")
VERSION = "product_id long, cost decimal(12,2), valid_from timestamp_ntz, valid_to timestamp_ntz"


@pytest.fixture(scope="module")
def tables(spark):
    """A year of orders with 0 to 3 lines each; ids grow with time; some lines
    without a unit, one dated the day before its order."""
    rnd = random.Random(6)
    lines, orders, units = [], [], []
    for o in range(400):
        at = T(2001, 1, 1) + dt.timedelta(hours=20 * o)
        orders.append((o, o % 9, "Shipped", "F", at, None, None, None, 1))
        for k in range(o % 4):
            i = 10 * o + k
            day = at - dt.timedelta(days=1) if i == 3010 else at
            lines.append((i, o, o % 9, i % 7, None if i % 13 == 0 else i, "Shipped", day, None, None, None, rnd.randint(5, 90) + 0.5))
            if i % 11:
                units.append((i, i % 7, i % 3, rnd.randint(1, 50) + 0.25, at - dt.timedelta(days=rnd.randint(1, 40)),
                              at if i % 2 else None))
    frame = lambda rows, schema: spark.createDataFrame(rows, schema.replace("decimal(12,2)", "double")).select(
        *[F.col(c.split()[0]).cast(c.split()[1]) for c in re.split(r", (?=\w+ )", schema)])
    versions = [(p, 3.0 + p, T(2000, 1, 1), T(2001, 6, 1)) for p in range(7)] + [(p, 5.0 + p, T(2001, 6, 1), None) for p in range(7)]
    return frame(orders, ORDER), frame(lines, LINE), frame(units, UNIT), frame(versions, VERSION)


@pytest.fixture(scope="module")
def dated(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dated"))
    orders, lines, units, versions = tables
    units.sort("inventory_item_id").coalesce(1).write.option("parquet.block.size", 4096).parquet(f"{root}/units")
    return slices.DatedSources.build(spark, orders, lines, spark.read.parquet(f"{root}/units"), versions, root)


def _same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


CUTOFF = dt.date(2001, 11, 20)


def test_line_slice_equals_the_full_build_and_prunes(tables, dated):
    _, lines, units, versions = tables
    got = dated.fct_order_items(CUTOFF)
    _same(got, core.fct_order_items(core.order_items_enriched(lines, units, versions), CUTOFF))
    plan = got._jdf.queryExecution().executedPlan().toString()
    folders = re.findall(r"PartitionFilters: \[(.*?)\]", plan)
    assert any("order_date_month" in f and ">= 2001-11-01" in f for f in folders)
    assert "LeftSemi" in plan
    unit_scan = [x for x in re.findall(r"PushedFilters: \[(.*?)\]", plan) if "inventory_item_id" in x or "Subquery" in x]
    assert unit_scan


def test_units_outside_the_slice_are_not_read(dated):
    ids = dated.lines.filter(F.col("order_date") >= F.lit(CUTOFF)).select("inventory_item_id")
    few = slices.only_units_of(dated.units, slices.since(dated.lines, "order_date", CUTOFF))
    assert few.count() == dated.units.join(ids, "inventory_item_id", "left_semi").count() < dated.units.count() / 4


def test_order_slice_and_a_line_dated_before_its_order(tables, dated):
    orders, lines, units, versions = tables
    enriched = core.order_items_enriched(lines, units, versions)
    fact = core.fct_order_items(enriched)
    early = lines.filter("order_item_id = 3010").first().created_at.date()
    cutoff = early + dt.timedelta(days=1)  # the order's own day
    assert orders.filter("order_id = 301").first().created_at.date() == cutoff
    full = core.fct_orders(orders, enriched).filter(F.col("order_date") >= F.lit(cutoff))
    got = dated.fct_orders(fact, cutoff)
    _same(got, full)
    missed = dated.fct_orders(fact, cutoff, line_lead_days=0)
    assert missed.filter("order_id = 301").first().n_line_items is None
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert any("order_date_month" in f for f in re.findall(r"PartitionFilters: \[(.*?)\]", plan))


def test_lines_of_days(spark, tables, dated):
    days = spark.createDataFrame([(dt.date(2001, 2, 4),), (dt.date(2001, 8, 30),), (dt.date(1999, 1, 1),), (None,)], "order_date date")
    _, lines, units, versions = tables
    full = core.fct_order_items(core.order_items_enriched(lines, units, versions))
    _same(dated.fct_order_items_on(days), full.filter("order_date IN (DATE'2001-02-04', DATE'2001-08-30')"))
    assert dated.fct_order_items_on(days.limit(0)).isEmpty()


def _units(spark, seed, n=400):
    rnd = random.Random(seed)
    day = lambda lo, hi: dt.date(2001, 1, 1) + dt.timedelta(days=rnd.randint(lo, hi))
    rows = []
    for _ in range(n):
        a = rnd.choice([None, 1, 2, 3, 4])
        rows.append((a, rnd.choice([None, 1, 2]), rnd.choice([None, 1.25, 7.5]), rnd.choice([None, day(0, 70)]),
                     rnd.choice([None, day(10, 90)])))
    return spark.createDataFrame(rows, "product_id long, distribution_center_id long, cost double, in_date date, out_date date") \
        .withColumn("cost", F.col("cost").cast("decimal(12,2)"))


@pytest.mark.parametrize("seed", [1, 2])
def test_carried_balances_equal_the_full_run(spark, seed):
    units = _units(spark, seed)
    ws, as_of, cal = dt.date(2001, 1, 20), dt.date(2001, 3, 10), (dt.date(2001, 1, 1), dt.date(2001, 12, 31))
    full = inventory.daily_balances(units, ws, as_of, *cal)
    since = dt.date(2001, 2, 14)
    opening = full.filter(F.col("snapshot_date") == F.lit(since - dt.timedelta(days=1))).drop("snapshot_date")
    moves = inventory.movements(units).filter((F.col("move_date") >= F.lit(since)) | F.col("move_date").isNull())
    _same(inventory.carried_balances(opening, moves, since, as_of, *cal), full.filter(F.col("snapshot_date") >= F.lit(since)))
    # a pair that only a later unit brings
    some = opening.filter("product_id <> 3")
    got = inventory.carried_balances(some, moves, since, as_of, *cal)
    assert not got.filter("product_id = 3").isEmpty()
    assert inventory.carried_balances(opening, moves, since, since - dt.timedelta(days=3), *cal).isEmpty()


def test_snapshot_run_reads_only_later_movements(spark, tables, dated, tmp_path):
    _, _, units, _ = tables
    path, cal = str(tmp_path / "snapshot"), (dt.date(2001, 1, 1), dt.date(2002, 12, 31))
    ws = dt.date(2001, 10, 1)
    full = lambda as_of, start=ws: core.fct_inventory_snapshot(units, start, as_of, *cal)
    assert dated.fct_inventory_snapshot(spark, path, CUTOFF, CUTOFF, *cal) is None  # nothing stored
    incremental.build_incremental(spark, lambda _: full(CUTOFF), path, "snapshot_date")
    seen = []

    def run(cutoff):
        seen.append(dated.fct_inventory_snapshot(spark, path, cutoff, dt.date(2001, 12, 5), *cal))
        return seen[0]
    incremental.build_incremental(spark, run, path, "snapshot_date")
    _same(incremental.read_table(spark, path), full(dt.date(2001, 12, 5)))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "move_date_month" in " ".join(re.findall(r"PartitionFilters: \[(.*?)\]", plan))
    assert "inventory_item_id" not in plan  # the units are not scanned
