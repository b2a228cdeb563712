"""What the landed and laid-out tables move and write."""

import datetime as dt
import os
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfline import sources
from shelfline.operators import inventory
from shelfline.plans import core, marts, slices
from shelfline.plans.warehouse import Warehouse
from shelfline.session import land
from shelfline.sources import driver

T = dt.datetime


def _files(path):
    return [pq.ParquetFile(f"{path}/{n}") for n in sorted(os.listdir(path)) if n.endswith(".parquet")]


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x.strip() for x in plan.splitlines() if "Exchange " in x and "Broadcast" not in x]


def test_landing_keeps_rows_in_their_tasks_and_sorts_each_file(spark, tmp_path):
    df = spark.range(0, 300, 1, 3).select(((F.col("id") * 77) % 101).alias("day"), "id")
    got = land(df, f"{tmp_path}/t", ("day", "id"))
    files = [f.read().to_pylist() for f in _files(f"{tmp_path}/t")]
    assert len(files) == 3  # one per task: no range shuffle
    assert all(rows == sorted(rows, key=lambda r: (r["day"], r["id"])) for rows in files)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_landing_bounds_the_rows_of_a_file(spark, tmp_path):
    got = land(spark.range(0, 1000, 1, 2), f"{tmp_path}/t", rows_per_file=200)
    assert max(f.metadata.num_rows for f in _files(f"{tmp_path}/t")) <= 200
    assert got.count() == 1000


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Driver-shaped tables: lines that come twice, that differ in the ship date
    only, and without part or supplier."""
    root, rnd = str(tmp_path_factory.mktemp("raw")), random.Random(4)
    day = lambda: T(1998, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))
    orders = [(o, o % 7, rnd.choice("FOP"), 1.0, day(), "5-LOW") for o in range(60)]
    lines = [(rnd.randint(0, 70), rnd.choice([None, *range(12)]), rnd.choice([None, *range(5)]), rnd.randint(1, 3),
              float(rnd.randint(1, 9)), 10.5, 0.01, 0.02, rnd.choice("NRA"), rnd.choice("OF"), day()) for _ in range(300)]
    lines += lines[:40] + [(*x[:-1], day()) for x in lines[40:80]]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                           "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                            "l_linestatus string, l_shipdate timestamp_ntz"),
        "part": ([(p, f"p{p}", f"b{p % 3}", f"c{p % 2}", p, 100.0 + p) for p in range(10)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "supplier": ([(s, f"s{s}", s % 2, 0.0) for s in range(4)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R0"), (1, "R1")], "r_regionkey int, r_name string"),
        "customer": ([(c, f"c{c}", 0, 0.0, "m") for c in range(7)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "events": ([(e, day(), 1, "click", 0.0, "") for e in range(9)],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_units_and_lines_equal_a_plain_derivation(spark, raw):
    """The line base and the units against the mapping worked out row by row."""
    s = sources.from_driver_tables(spark, raw)
    rows = {n: [r.asDict() for r in spark.read.parquet(f"{raw}/{n}.parquet").collect()] for n in ("lineitem", "orders", "part", "supplier")}
    orders, parts = {o["o_orderkey"]: o for o in rows["orders"]}, {p["p_partkey"]: p for p in rows["part"]}
    centre = {x["s_suppkey"]: x["s_nationkey"] for x in rows["supplier"]}  # nation n lies in region n
    order_of = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                "l_linestatus", "l_shipdate"]
    key = lambda r: [(r[c] is not None, r[c] if r[c] is not None else 0) for c in order_of]
    units, items = [], []
    for o in sorted(orders):
        for n, r in enumerate(sorted((x for x in rows["lineitem"] if x["l_orderkey"] == o), key=key), 1):
            i, at = o * 1000 + n, orders[o]["o_orderdate"]
            items.append((i, o, r["l_partkey"], at, Decimal("10.50")))
            if i % 97:
                p = parts.get(r["l_partkey"])
                cost = Decimal(str(p["p_retailprice"])) * Decimal("0.60") + i % 7 if p else None
                units.append((i, r["l_partkey"], at - dt.timedelta(days=int(r["l_quantity"])), at if r["l_linestatus"] == "F" else None,
                              cost, p["p_name"] if p else None, centre.get(r["l_suppkey"])))
    got = s.inventory_items.select("id", "product_id", "created_at", "sold_at", "cost", "product_name", "product_distribution_center_id")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == units
    got = s.order_items.select("id", "order_id", "product_id", "created_at", "sale_price")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == items


def test_line_base_carries_only_what_the_roles_read(spark, raw):
    t = {n: driver.read(spark, raw, n) for n in ("lineitem", "orders")}
    base = driver.lines(t["lineitem"], t["orders"])
    assert not {"l_discount", "l_tax", "l_shipdate", "rn", "o_orderkey", "o_orderstatus"} & set(base.columns)
    assert base._jdf.queryExecution().optimizedPlan().toString().count("l_shipdate") == 1  # in the relation, not read


def test_sources_and_facts_are_landed_without_a_range_or_bucket_shuffle(spark, raw, tmp_path):
    w = Warehouse(sources.LandedSources(spark, raw, f"{tmp_path}/raw"), table_root=f"{tmp_path}/models")
    plans = [w.s.order_items, w.s.inventory_items, w.fct_order_items, w.fct_orders, w.fct_inventory_snapshot()]
    assert "Bucketed: true" not in "".join(d._jdf.queryExecution().executedPlan().toString() for d in plans)
    plain = Warehouse(sources.from_driver_tables(spark, raw), materialize_facts=False)
    for a, b in ((w.fct_order_items, plain.fct_order_items), (w.fct_orders, plain.fct_orders),
                 (w.fct_inventory_snapshot(), plain.fct_inventory_snapshot())):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_sources_by_day_are_laid_out_on_first_use(spark, raw, tmp_path):
    w = Warehouse(sources.from_driver_tables(spark, raw), materialize_facts=False)
    dated = slices.DatedSources.build(spark, w.stg_orders, w.stg_order_items, w.stg_inventory_items, w.s.product_versions, f"{tmp_path}/dated")
    dated.fct_orders(w.fct_order_items, dt.date(1999, 1, 1)).count()
    assert os.listdir(f"{tmp_path}/dated") == ["orders"]  # neither the lines nor the movements
    dated.fct_order_items(dt.date(1999, 1, 1)).count()
    assert sorted(os.listdir(f"{tmp_path}/dated")) == ["lines", "orders"]
    assert dated.lines is dated.lines and not dated.movements.isEmpty()


def test_order_totals_shuffle_plain_lines_once(spark, raw):
    w = Warehouse(sources.from_driver_tables(spark, raw), materialize_facts=False)
    lines = w.fct_order_items.select("order_id", "sale_price", "cost").localCheckpoint()
    got = core.order_totals(lines)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(_exchanges(got)) == 1
    assert plan.index("partial_sum") < plan.index("Exchange ")  # printed top down: summed after the exchange
    r = {x.order_id: x for x in got.collect()}
    for o, n in lines.groupBy("order_id").count().collect():
        mine = [x for x in lines.filter(F.col("order_id") == o).collect()]
        assert (r[o].n_line_items, r[o].gross_revenue) == (n, sum(x.sale_price for x in mine))
        break


def test_demand_panel_does_not_shuffle_by_product_and_week(spark):
    day = lambda n: dt.date(2001, 1, 1) + dt.timedelta(days=n)
    items = spark.createDataFrame([(p, day(3 * k), Decimal(k + p)) for p in (1, 2, 3, 4) for k in range(20)] + [(None, day(0), Decimal(1))],
                                  "product_id long, order_date date, sale_price decimal(12,2)")
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "product_id long, category string")
    events = spark.createDataFrame([(1, T(2001, 1, 2), "cart")], "event_id long, created_at timestamp_ntz, event_type string")
    panel = marts.mart_demand_features(items, dim, events)
    assert not any("_w" in x and "product_id" in x for x in _exchanges(panel))
    assert panel.schema["revenue"].dataType.simpleString() == "decimal(32,2)"
    got = {(r.category, r.week_start_date): (r.units_sold, r.revenue) for r in panel.collect()}
    want = {}
    for p, c in ((1, "a"), (2, "a"), (3, "b")):
        for k in range(20):
            week = day(3 * k - (3 * k) % 7)  # 2001-01-01 is a Monday
            n, s = want.get((c, week), (0, Decimal(0)))
            want[c, week] = n + 1, s + Decimal(k + p)
    assert {k: v for k, v in got.items() if v[0]} == want


def test_movements_are_summed_where_they_are_stored(spark, raw, tmp_path, monkeypatch):
    w = Warehouse(sources.from_driver_tables(spark, raw), materialize_facts=False)
    dated = slices.DatedSources.build(spark, w.stg_orders, w.stg_order_items, w.stg_inventory_items, w.s.product_versions, f"{tmp_path}/dated")
    written = []
    monkeypatch.setattr(slices, "_write_dated", lambda df, *a, f=slices._write_dated: written.append(df) or f(df, *a))
    got = dated.movements
    by = [x for x in _exchanges(written[0]) if "move_date" in x]
    assert len(by) == 1 and "rangepartitioning" in by[0]
    want = inventory.movements(core.inventory_units(w.stg_inventory_items))
    got = got.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not want.isEmpty()
