"""DQ1-DQ13: each check kind fails on a planted violation and passes on clean data;
contracts reject drift (SNK10)."""

import datetime as dt
import re

import pytest

from shelfline.operators import contracts, quality
from shelfline.operators.quality import Check


def _tables(spark):
    child = spark.createDataFrame(
        [(1, 10, "A", 0.5), (2, 10, "B", 1.5), (2, 11, "Z", None), (None, 99, None, 0.1)],
        "id long, parent_id long, cls string, pct double")
    parent = spark.createDataFrame([(10,), (11,)], "parent_id long")
    return {"child": child, "parent": parent}


CHECKS = [
    Check("u", "child", "unique", ("id",)),
    Check("nn", "child", "not_null", ("id",)),
    Check("rel", "child", "relationships", ("parent_id",), parent="parent", parent_column="parent_id"),
    Check("combo", "child", "unique_combination", ("id", "parent_id")),
    Check("acc", "child", "accepted_values", ("cls",), values=("A", "B")),
    Check("btw", "child", "between", ("pct",), min_value=0, max_value=1),
    Check("expr", "child", "expression", expression="pct > 1", severity="warn"),
]


def test_run_checks_counts_planted_violations(spark):
    res = {r.check_name: (r.n_failed, r.status)
           for r in quality.run_checks(CHECKS, _tables(spark)).collect()}
    assert res == {"u": (1, "fail"), "nn": (1, "fail"), "rel": (1, "fail"), "combo": (0, "pass"),
                   "acc": (1, "fail"), "btw": (1, "fail"), "expr": (1, "warn")}


def test_failing_rows_and_sql_agree(spark):
    import duckdb
    t = _tables(spark)
    con = duckdb.connect()
    for name, df in t.items():
        con.register(name, df.toPandas())
    got = {r[0]: r[3] for r in con.execute(quality.checks_sql(CHECKS)).fetchall()}
    spark_counts = {c.name: quality.failing_rows(c, t).count() for c in CHECKS}
    assert got == spark_counts


def test_freshness_thresholds(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 8, 1),)], "created_at timestamp_ntz")
    def status(now):
        return quality.freshness(df, "orders", "created_at", now).first().status
    assert status(dt.datetime(2001, 8, 1, 23)) == "pass"
    assert status(dt.datetime(2001, 8, 2, 7)) == "warn"
    assert status(dt.datetime(2001, 8, 5, 1)) == "error"


def test_contract_rejects_drift(spark):
    good = spark.createDataFrame([(1, "x")], "product_id long, name string")
    c = contracts.Contract("t", (("product_id", contracts.L, True), ("name", contracts.S, False)))
    assert contracts.enforce(good, c).count() == 1
    with pytest.raises(contracts.ContractError):
        contracts.enforce(good.withColumn("extra", good.name), c)
    with pytest.raises(contracts.ContractError):
        contracts.enforce(good.withColumn("product_id", good.product_id.cast("int")), c)
    bad = spark.createDataFrame([(None, "x")], "product_id long, name string")
    with pytest.raises(Exception):
        contracts.enforce(bad, c).collect()


def test_singular_tests_fire_on_planted_violations(spark):
    from decimal import Decimal as Dm
    from shelfline.plans import checks as C
    fct = spark.createDataFrame([
        (1, 10, 5, Dm("10.00"), Dm("40.00"), Dm("-30.00"), Dm("3.00")),   # cost > 3 x price
        (2, 11, 5, Dm("10.00"), None, None, Dm("4.00")),                  # no unit cost
        (3, 99, 6, Dm("10.00"), Dm("1.00"), Dm("9.00"), None),            # order 99 missing
    ], "order_item_id long, order_id long, product_id long, sale_price decimal(12,2), "
       "cost decimal(12,2), gross_margin_amount decimal(12,2), product_cost_at_sale decimal(12,2)")
    orders = spark.createDataFrame([(10,), (11,)], "order_id long")
    prods_same = spark.createDataFrame([(5, Dm("3.00")), (6, Dm("1.00"))], "product_id long, cost decimal(12,2)")
    prods_diff = spark.createDataFrame([(5, Dm("9.99")), (6, Dm("1.00"))], "product_id long, cost decimal(12,2)")
    assert C.margin_within_range(fct).count() == 1
    assert C.sales_have_cost(fct).count() == 1
    assert [r.order_id for r in C.no_orphan_order_items(fct, orders).collect()] == [99]
    # DQ7 warns (one row) only when no sale was priced at a different cost
    assert C.historical_cost_differs(fct.filter("order_item_id = 3"), prods_same).count() == 1
    assert C.historical_cost_differs(fct, prods_diff).count() == 0
    mart = spark.createDataFrame([(Dm("25.00"),)], "gross_revenue decimal(22,2)")
    assert C.revenue_reconciles(mart, fct).count() == 1          # 25 vs 30
    ok = spark.createDataFrame([(Dm("29.50"),)], "gross_revenue decimal(22,2)")
    assert C.revenue_reconciles(ok, fct).count() == 0            # within 1


def test_checks_scan_each_table_once_and_match_the_failing_rows(spark, tmp_path):
    """Keys of several types, null parts, a parent that repeats and a column named like a slot."""
    child = spark.createDataFrame(
        [(1, "a", dt.date(2001, 1, 1), 1, 7), (1, "a", dt.date(2001, 1, 1), 2, 7), (2, None, None, 3, 8), (2, None, None, 4, 8),
         (3, "b", dt.date(2001, 1, 2), None, 9), (4, "1", dt.date(2001, 1, 3), 5, 9)],
        "id int, code string, day date, ref long, l0 int")
    parent = spark.createDataFrame([("a", 1), ("a", 2), (None, None), ("1", 3)], "code string, id long")
    child.write.parquet(f"{tmp_path}/child")
    parent.write.parquet(f"{tmp_path}/parent")
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("child", "parent")}
    checks = [Check("u_id", "child", "unique", ("id",)), Check("u_code", "child", "unique", ("code",)),
              Check("combo", "child", "unique_combination", ("id", "code", "day")),
              Check("combo2", "child", "unique_combination", ("l0", "day")),
              Check("r_code", "child", "relationships", ("code",), parent="parent", parent_column="code"),
              Check("r_ref", "child", "relationships", ("ref",), parent="parent", parent_column="id"),
              Check("r_mixed", "child", "relationships", ("id",), parent="parent", parent_column="code"),
              Check("r_self", "child", "relationships", ("id",), parent="child", parent_column="ref"),
              Check("nn", "child", "not_null", ("ref",)), Check("u_parent", "parent", "unique", ("id",))]
    result = quality.run_checks(checks, tables)
    got = {r.check_name: r.n_failed for r in result.collect()}
    assert got.pop("r_mixed") == 4  # compared as text: only the id 1 has a parent
    assert got == {c.name: quality.failing_rows(c, tables).count() for c in checks if c.name != "r_mixed"}
    assert got["combo"] == 2 and got["r_code"] == 1 and got["u_parent"] == 0
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2  # one relation per table
    none = quality.run_checks(checks, {n: t.limit(0) for n, t in tables.items()})
    assert {r.n_failed for r in none.collect()} == {0} and none.count() == len(checks)


def test_a_key_that_should_not_repeat_is_counted_in_tasks_of_bounded_rows(spark, monkeypatch):
    """No combine in the scan, a task for so many rows, and the same failures whatever the bound."""
    monkeypatch.setattr(quality, "ROWS_PER_TASK", 1000, raising=False)
    ids = spark.range(20_000).selectExpr(
        "IF(id % 50 = 0, NULL, IF(id < 300, id DIV 3, id)) AS id", "IF(id % 70 = 1, NULL, id % 9) AS ref",
        "CASE id % 11 WHEN 0 THEN NULL WHEN 1 THEN 'Z' ELSE 'A' END AS cls", "DOUBLE(id) / 100 AS pct")
    tables = {"t": ids, "bare": ids.select("id", "cls"), "p": spark.range(7).selectExpr("id AS pid", "id % 2 AS half")}
    checks = [Check("u", "t", "unique", ("id",)), Check("nn", "t", "not_null", ("id",)),
              Check("acc", "t", "accepted_values", ("cls",), values=("A",)), Check("btw", "t", "between", ("pct",), min_value=1, max_value=150),
              Check("rel", "t", "relationships", ("ref",), parent="p", parent_column="pid"),
              Check("combo", "bare", "unique_combination", ("id", "cls")), Check("rule", "p", "expression", expression="half = 1")]
    want = {c.name: quality.failing_rows(c, tables).count() for c in checks}
    assert min(want.values()) > 0
    result = quality.run_checks(checks, tables)
    assert {r.check_name: r.n_failed for r in result.collect()} == want
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    dealt = [int(n) for n in re.findall(r"RepartitionByExpression \[[^\]]*\], (\d+)", plan)]
    assert sorted(dealt) == [1, 20, 20]  # t and bare by rows, the small parent in one task
    below = [plan.splitlines()[i + 1:i + 3] for i, line in enumerate(plan.splitlines()) if "RepartitionByExpression" in line]
    assert not any("Aggregate" in line for lines in below for line in lines)
    for bound in (1, 100_000):  # the bound only numbers the tasks
        got = quality.run_checks(checks, tables, lambda name, bound=bound: bound).collect()
        assert {r.check_name: r.n_failed for r in got} == want


def test_newest_comes_from_the_footers(spark, tmp_path):
    from shelfline import sources
    late = dt.datetime(2001, 8, 1, 7, 30, 15, 123456)
    rows = [(900 + i, late - dt.timedelta(hours=i), dt.date(2001, 1, 1) + dt.timedelta(days=i), "x") for i in range(50)] + [(1, None, None, "y")]
    df = spark.createDataFrame(rows, "id long, at timestamp_ntz, day date, name string")
    df.repartition(3).write.parquet(f"{tmp_path}/flat")
    df.selectExpr("*", "array(id) as ids").write.parquet(f"{tmp_path}/nested")
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    for table in ("flat", "nested"):
        assert sources.newest(spark, f"{tmp_path}/{table}", "at").collect() == [(late,)]
        assert sources.newest(spark, f"{tmp_path}/{table}", "day").collect() == [(dt.datetime(2001, 2, 19),)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == listed
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    plan = sources._newest_plan(spark, f"{tmp_path}/flat", "at")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(at)]" in plan
    df.limit(0).write.parquet(f"{tmp_path}/empty")
    assert sources.newest(spark, f"{tmp_path}/empty", "at").collect() == [(None,)]
