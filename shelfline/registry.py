"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Every builder reads the driver tables under ``sf_dir`` through the role
mapping and returns a lazy DataFrame (a few bounded scalars may be computed
eagerly, e.g. the cut points of the global ranking).  Output columns are
aliased identically on both sides; DECIMAL money leaves as DOUBLE.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle
from .params import DEFAULT
from .plans.warehouse import Warehouse
from .session import materialize


def publish(df: DataFrame) -> DataFrame:
    """Edge types: DECIMAL money -> DOUBLE (the published float64 contract)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


_WAREHOUSES: dict[tuple, Warehouse] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    """Names a session, a directory and the state of its files: what was landed
    from other files is not taken again."""
    from .sources import driver
    return id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), driver.fingerprint(spark, sf_dir)


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One warehouse per session and directory: sources are landed once and
    each fact is built once, then every model reads them (a full build)."""
    from . import sources
    key = _key(spark, sf_dir)
    if key not in _WAREHOUSES:
        import uuid
        from .session import table_root
        root = f"{table_root(spark)}/shelfline_models_{uuid.uuid4().hex[:12]}"
        _WAREHOUSES[key] = Warehouse(sources.landed(spark, sf_dir), DEFAULT, materialize_facts=True,
                                     table_root=root)
    return _WAREHOUSES[key]


_SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None, money_cols: tuple[str, ...] = ()):
    def deco(fn):
        _SPARK[name] = lambda spark, sf_dir: publish(fn(spark, sf_dir))
        if sql is not None:
            if money_cols:
                rep = ", ".join(f"{oracle.money(c)} AS {c}" for c in money_cols)
                final = f"SELECT * REPLACE ({rep}) FROM ({sql})"
            else:
                final = sql
            _SQL[name] = oracle.build(final)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---- staging ----------------------------------------------------------------

@register("stg_orders", "SELECT * FROM stg_orders")
def _q(spark, d): return _wh(spark, d).stg_orders


@register("stg_order_items", "SELECT * FROM stg_order_items", ("sale_price",))
def _q(spark, d): return _wh(spark, d).stg_order_items


@register("stg_products", "SELECT * FROM stg_products", ("cost", "retail_price"))
def _q(spark, d): return _wh(spark, d).stg_products


@register("stg_users", "SELECT * FROM stg_users")
def _q(spark, d): return _wh(spark, d).stg_users


@register("stg_inventory_items", "SELECT * FROM stg_inventory_items", ("cost", "retail_price"))
def _q(spark, d): return _wh(spark, d).stg_inventory_items


@register("stg_distribution_centers", "SELECT * FROM stg_distribution_centers")
def _q(spark, d): return _wh(spark, d).stg_distribution_centers


@register("stg_events", """
    SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS BIGINT) AS sequence_number,
           created_at, CAST(NULL AS VARCHAR) AS ip_address, CAST(NULL AS VARCHAR) AS city,
           CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS VARCHAR) AS browser,
           CAST(NULL AS VARCHAR) AS traffic_source, CAST(NULL AS VARCHAR) AS uri, event_type
    FROM stg_events""")
def _q(spark, d): return _wh(spark, d).stg_events


# ---- dims and facts ---------------------------------------------------------

@register("customer_orders", "SELECT * FROM customer_orders")
def _q(spark, d): return _wh(spark, d).customer_orders


@register("dim_products", "SELECT * FROM dim_products", ("cost", "retail_price", "base_margin_amount"))
def _q(spark, d): return _wh(spark, d).dim_products


@register("dim_customers", "SELECT * FROM dim_customers")
def _q(spark, d): return _wh(spark, d).dim_customers


@register("dim_distribution_centers", "SELECT * FROM dim_distribution_centers")
def _q(spark, d): return _wh(spark, d).dim_distribution_centers


_ENRICHED_MONEY = ("sale_price", "cost", "gross_margin_amount", "product_cost_at_sale",
                   "gross_margin_at_sale")


@register("order_items_enriched", "SELECT * FROM enriched", _ENRICHED_MONEY)
def _q(spark, d): return _wh(spark, d).order_items_enriched


@register("fct_order_items", "SELECT * FROM fct_order_items", _ENRICHED_MONEY)
def _q(spark, d): return _wh(spark, d).fct_order_items


@register("fct_orders", "SELECT * FROM fct_orders",
          ("gross_revenue", "total_cost", "gross_margin_amount"))
def _q(spark, d): return _wh(spark, d).fct_orders


@register("product_versions",
          "SELECT product_id, product_name, category, brand, department, sku, "
          "distribution_center_id, cost, retail_price, valid_from, valid_to FROM r_versions",
          ("cost", "retail_price"))
def _q(spark, d): return _wh(spark, d).s.product_versions.drop("scd_id")


@register("fct_inventory_snapshot", "SELECT * FROM fct_inventory_snapshot",
          ("inventory_cost_on_hand",))
def _q(spark, d): return _wh(spark, d).fct_inventory_snapshot()


@register("inventory_latest", "SELECT * FROM inventory_latest", ("inventory_cost_on_hand",))
def _q(spark, d): return _wh(spark, d).inventory_latest


@register("weekly_events", "SELECT * FROM weekly_events")
def _q(spark, d):
    from .plans.marts import weekly_events
    return weekly_events(_wh(spark, d).stg_events)


# ---- marts ------------------------------------------------------------------

@register("mart_product_performance", "SELECT * FROM mart_product_performance",
          ("gross_revenue", "total_cost", "gross_margin_amount"))
def _q(spark, d): return _wh(spark, d).mart_product_performance()


@register("mart_fulfillment_sla", "SELECT * FROM mart_fulfillment_sla")
def _q(spark, d): return _wh(spark, d).mart_fulfillment_sla()


@register("mart_customer_rfm", "SELECT * FROM mart_customer_rfm", ("monetary",))
def _q(spark, d): return _wh(spark, d).mart_customer_rfm()


@register("mart_inventory_health", "SELECT * FROM mart_inventory_health",
          ("inventory_cost_on_hand",))
def _q(spark, d): return _wh(spark, d).mart_inventory_health()


@register("mart_demand_features", "SELECT * FROM mart_demand_features", ("revenue",))
def _q(spark, d): return _wh(spark, d).mart_demand_features()


@register("mart_inventory_recommendations", "SELECT * FROM mart_inventory_recommendations",
          ("inventory_cost_on_hand",))
def _q(spark, d): return _wh(spark, d).mart_inventory_recommendations()


# ---- forecast input, SCD2, incremental, contracts ---------------------------

@register("forecast_standin", "SELECT * FROM forecast_standin")
def _q(spark, d): return _wh(spark, d).forecast


@register("scd2_snapshot_apply", "SELECT * FROM snap_products", ("cost", "retail_price"))
def _q(spark, d):
    """Replay the last snapshot run: history as of 2000-01-01 + current products."""
    from .operators import scd2
    from .plans import staging
    w = _wh(spark, d)
    run = dt.datetime(2000, 1, 1)
    before = scd2.history_as_of(w.s.product_versions, run)
    return scd2.apply_snapshot(staging.snapshot_projection(w.s.products), before, run)


# four states of the catalogue: what a run at that time finds (FIXTURES.md)
_SNAPSHOT_RUNS = (
    (dt.datetime(1996, 1, 1), "id % 5 <> 0", "cost", "retail_price", "name"),
    (dt.datetime(1997, 1, 1), "true", "CASE WHEN id % 3 = 0 THEN cost + 5 ELSE cost END", "retail_price",
     "CASE WHEN id % 7 = 0 THEN concat(name, ' II') ELSE name END"),
    (dt.datetime(1998, 1, 1), "id % 11 <> 0", "CASE WHEN id % 3 = 0 THEN cost + 5 ELSE cost END",
     "CASE WHEN id % 4 = 0 THEN retail_price + 1 ELSE retail_price END", "name"),
    (dt.datetime(1998, 1, 1), "id % 11 <> 0", "CASE WHEN id % 3 = 0 THEN cost + 5 ELSE cost END",
     "CASE WHEN id % 4 = 0 THEN retail_price + 1 ELSE retail_price END", "name"),  # the same run again
    (dt.datetime(1999, 1, 1), "true", "CASE WHEN id % 6 = 0 THEN cost ELSE cost + 5 END", "retail_price", "name"),
)
_SNAPSHOT_STATES = " UNION ALL ".join(
    f"SELECT id AS product_id, CAST({name} AS VARCHAR) AS product_name, category, brand, department, sku, distribution_center_id, "
    f"CAST({cost} AS DECIMAL(12,2)) AS cost, CAST({price} AS DECIMAL(12,2)) AS retail_price, TIMESTAMP '{at}' AS seen_at "
    f"FROM r_products WHERE {there}" for at, there, cost, price, name in dict.fromkeys(_SNAPSHOT_RUNS))


@register("scd2_stored_snapshot", f"""
    SELECT product_id, product_name, category, brand, department, sku, distribution_center_id, cost, retail_price,
           seen_at AS valid_from, lead(seen_at) OVER (PARTITION BY product_id ORDER BY seen_at) AS valid_to,
           md5(CAST(product_id AS VARCHAR) || '|' || CAST(seen_at AS VARCHAR)) AS scd_id
    FROM (SELECT *, lag(cost) OVER w AS cost_before, lag(retail_price) OVER w AS price_before,
                 row_number() OVER w AS nth
          FROM ({_SNAPSHOT_STATES}) WINDOW w AS (PARTITION BY product_id ORDER BY seen_at))
    WHERE nth = 1 OR cost IS DISTINCT FROM cost_before OR retail_price IS DISTINCT FROM price_before""",
          ("cost", "retail_price"))
def _q(spark, d):
    """SNK7, MOD16: five runs on the stored history: first rows, changes and new
    products, products that vanish, the same run again, products that return."""
    from .operators import scd2
    from .operators.versioned import VersionedTable
    from .plans import staging
    products = _wh(spark, d).s.products
    table = VersionedTable(spark, _scratch(spark, "snap_products")[0])
    for at, there, cost, price, name in _SNAPSHOT_RUNS:
        found = products.filter(there).withColumns({"name": F.expr(name), "cost": F.expr(cost).cast("decimal(12,2)"),
                                                    "retail_price": F.expr(price).cast("decimal(12,2)")})
        scd2.run_snapshot(table, staging.snapshot_projection(found), at)
    table.vacuum()
    return table.read()


_DATED: dict[tuple, object] = {}


def _dated(spark, d):
    """The sources laid out by day, once per session and directory."""
    from .plans import slices
    key = _key(spark, d)
    if key not in _DATED:
        w = _wh(spark, d)
        _DATED[key] = slices.DatedSources.build(spark, w.stg_orders, w.stg_order_items, w.stg_inventory_items,
                                                w.s.product_versions, _scratch(spark, "dated")[0])
    return _DATED[key]


_FIRST_STATE = DEFAULT.as_of - dt.timedelta(days=30)


@register("incremental_fct_order_items", "SELECT * FROM fct_order_items", _ENRICHED_MONEY)
def _q(spark, d):
    """Two runs into a date-partitioned table: an older state, then a run that
    reads only the slice from the 3-day lookback on; the table equals a full build."""
    from .operators import contracts, incremental
    w, dated = _wh(spark, d), _dated(spark, d)
    path, _ = _scratch(spark, "fct_order_items")
    clusters = ("product_id", "distribution_center_id")
    incremental.build_incremental(
        spark, lambda _: w.fct_order_items.filter(F.col("order_date") <= F.lit(_FIRST_STATE)), path, "order_date",
        DEFAULT.lookback_days, clusters)
    incremental.build_incremental(spark, dated.fct_order_items, path, "order_date", DEFAULT.lookback_days, clusters,
                                  "append_new_columns")
    cols = [n for n, _, _ in contracts.FCT_ORDER_ITEMS.columns]
    return incremental.read_table(spark, path).select(*cols)


@register("incremental_fct_orders", "SELECT * FROM fct_orders",
          ("gross_revenue", "total_cost", "gross_margin_amount"))
def _q(spark, d):
    """MOD8 incremental: an older state, then a run that sums only the lines of
    the orders since the cutoff; the table equals a full build."""
    from .operators import incremental
    w, dated = _wh(spark, d), _dated(spark, d)
    path, _ = _scratch(spark, "fct_orders")
    incremental.build_incremental(
        spark, lambda _: w.fct_orders.filter(F.col("order_date") <= F.lit(_FIRST_STATE)), path, "order_date",
        DEFAULT.lookback_days, ("status",), "sync_all_columns")
    incremental.build_incremental(spark, lambda cutoff: dated.fct_orders(w.fct_order_items, cutoff), path, "order_date",
                                  DEFAULT.lookback_days, ("status",), "sync_all_columns")
    return incremental.read_table(spark, path)


def _evolving(spark, d, mode):
    """SNK9: a first run with a narrow shape of the order fact, then a run that
    adds a column, leaves one out and widens two."""
    from .operators import incremental
    orders = _wh(spark, d).fct_orders
    recent = orders.filter(F.col("order_date") >= F.lit(_FIRST_STATE - dt.timedelta(days=60)))
    first = recent.filter(F.col("order_date") <= F.lit(_FIRST_STATE)).select(
        "order_id", "order_date", "gender", F.col("num_of_items").cast("int").alias("num_of_items"),
        F.col("gross_revenue").cast("decimal(12,2)").alias("gross_revenue"))
    then = recent.select("order_id", "order_date", "status", "num_of_items",
                         F.col("gross_revenue").cast("decimal(18,2)").alias("gross_revenue"))
    path, _ = _scratch(spark, "evolving")
    incremental.build_incremental(spark, lambda _: first, path, "order_date", DEFAULT.lookback_days, ("order_id",))
    for _ in range(2):  # the run with the changed shape, and a later one
        incremental.build_incremental(spark, lambda cutoff: then.filter(F.col("order_date") >= F.lit(cutoff)), path,
                                      "order_date", DEFAULT.lookback_days, ("order_id",), mode)
    return incremental.read_table(spark, path)


def _evolved_sql(keep_removed):
    new = f"order_date >= (SELECT max(order_date) FROM fct_orders WHERE order_date <= DATE '{_FIRST_STATE}') - {DEFAULT.lookback_days}"
    gender = f", CASE WHEN {new} THEN NULL ELSE gender END AS gender" if keep_removed else ""
    return f"""
    SELECT order_id, order_date, CASE WHEN {new} THEN status END AS status, CAST(num_of_items AS BIGINT) AS num_of_items,
           gross_revenue{gender}
    FROM fct_orders WHERE order_date >= DATE '{_FIRST_STATE - dt.timedelta(days=60)}'"""


@register("incremental_schema_append", _evolved_sql(True), ("gross_revenue",))
def _q(spark, d): return _evolving(spark, d, "append_new_columns")


@register("incremental_schema_sync", _evolved_sql(False), ("gross_revenue",))
def _q(spark, d): return _evolving(spark, d, "sync_all_columns")


@register("contract_dim_products", "SELECT * FROM dim_products", ("cost", "retail_price", "base_margin_amount"))
def _q(spark, d):
    from .operators import contracts
    return contracts.enforce(publish(_wh(spark, d).dim_products), contracts.DIM_PRODUCTS)


@register("contract_fct_order_items", "SELECT * FROM fct_order_items", _ENRICHED_MONEY)
def _q(spark, d):
    from .operators import contracts
    return contracts.enforce(publish(_wh(spark, d).fct_order_items), contracts.FCT_ORDER_ITEMS)


# ---- data quality -------------------------------------------------------------

def _dq_summary(checks):
    from .operators import quality
    sql = quality.checks_sql(checks)

    def fn(spark, d):
        w = _wh(spark, d)
        return quality.run_checks(checks, w.tables(), w.rows_at_most)
    return fn, sql


def _register_dq():
    from .plans import checks as C
    for name, lst in (("dq_staging", C.STAGING + C.SNAPSHOT), ("dq_core", C.CORE),
                      ("dq_marts", C.MARTS)):
        fn, sql = _dq_summary(lst)
        register(name, sql)(fn)
    singular = {
        "dq_historical_cost_differs": lambda w: C.historical_cost_differs(w.fct_order_items, w.dim_products),
        "dq_margin_within_range": lambda w: C.margin_within_range(w.fct_order_items),
        "dq_no_orphan_order_items": lambda w: C.no_orphan_order_items(w.fct_order_items, w.fct_orders),
        "dq_revenue_reconciles": lambda w: C.revenue_reconciles(w.mart_product_performance(), w.fct_order_items),
        "dq_sales_have_cost": lambda w: C.sales_have_cost(w.fct_order_items),
    }
    money_cols = {"dq_margin_within_range": ("sale_price", "cost", "gross_margin_amount"),
                  "dq_revenue_reconciles": ("mart_revenue", "fact_revenue"),
                  "dq_sales_have_cost": ("sale_price", "cost")}
    for name, f in singular.items():
        register(name, C.SINGULAR_SQL[name], money_cols.get(name, ()))(
            lambda spark, d, f=f: f(_wh(spark, d)))

    def counted(name):
        severity = "'warn'" if name == "dq_historical_cost_differs" else "'error'"
        return f"SELECT '{name}' AS test_name, {severity} AS severity, count(*) AS n_failed FROM ({C.SINGULAR_SQL[name]})"
    register("dq_singular_status", f"""
        SELECT test_name, severity, n_failed,
               CASE WHEN n_failed = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
        FROM ({" UNION ALL ".join(map(counted, singular))})""")(
        lambda spark, d: C.singular_status({n: f(_wh(spark, d)) for n, f in singular.items()}))


_register_dq()


# the singular tests on inputs that violate them, with SQL written by hand
@register("dq_singular_violated", """
    SELECT 'dq_historical_cost_differs' AS test_name, CAST(NULL AS BIGINT) AS id, 1 AS n
    UNION ALL
    SELECT 'dq_margin_within_range', order_item_id, 1 FROM fct_order_items
    WHERE sale_price > 0 AND CAST(cost AS DOUBLE) * 40 > CAST(sale_price AS DOUBLE) * 3
    UNION ALL
    SELECT 'dq_no_orphan_order_items', order_item_id, 1 FROM fct_order_items
    WHERE order_id NOT IN (SELECT order_id FROM fct_orders WHERE status IN ('Complete', 'Processing'))
    UNION ALL
    SELECT 'dq_revenue_reconciles', CAST(round(sum(sale_price) FILTER (WHERE order_date < DATE '1998-01-01') * 100) AS BIGINT), 1
    FROM fct_order_items HAVING sum(sale_price) FILTER (WHERE order_date >= DATE '1998-01-01') > 1""")
def _q(spark, d):
    """DQ7-DQ10, JN24-JN26, AGG18 with failing rows: every sale at today's cost,
    unit costs forty times too high, an order fact that lacks orders, a mart that
    lacks the years from 1998 on."""
    from .plans import checks as C
    w = _wh(spark, d)
    fct, today = w.fct_order_items, w.dim_products.select(F.col("product_id").alias("_p"), F.col("cost").alias("_cost"))
    at_cost = fct.join(today, fct.product_id == today._p).withColumn("product_cost_at_sale", F.col("_cost"))
    found = {
        "dq_historical_cost_differs": C.historical_cost_differs(at_cost, w.dim_products).select(
            F.when(F.col("n_different") > 0, F.col("n_different")).alias("id")),
        "dq_margin_within_range": C.margin_within_range(fct.withColumn("cost", F.col("cost") * 40)).select(
            F.col("order_item_id").alias("id")),
        "dq_no_orphan_order_items": C.no_orphan_order_items(
            fct, w.fct_orders.filter(F.col("status").isin("Complete", "Processing"))).select(F.col("order_item_id").alias("id")),
        "dq_revenue_reconciles": C.revenue_reconciles(
            w.mart_product_performance().filter("month_start_date < DATE'1998-01-01'"), fct).select(
            (F.col("mart_revenue") * 100).cast("bigint").alias("id")),
    }
    out = None
    for name, rows in found.items():
        rows = rows.select(F.lit(name).alias("test_name"), F.col("id").cast("bigint").alias("id"), F.lit(1).alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


# every kind of check on inputs that violate it; the SQL is written by hand, not
# generated from the list of checks
@register("dq_violated", """
    SELECT check_name, 'lines' AS table_name, severity, CAST(n AS BIGINT) AS n_failed,
           CASE WHEN n = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
    FROM (
      SELECT 'orphan_lines' AS check_name, 'error' AS severity, count(*) AS n FROM fct_order_items f
      WHERE f.order_id NOT IN (SELECT order_id FROM fct_orders WHERE status <> 'Cancelled')
      UNION ALL
      SELECT 'order_repeats', 'warn', count(*) FROM (
        SELECT order_id FROM fct_order_items GROUP BY order_id HAVING count(*) >= 2)
      UNION ALL
      SELECT 'order_status_repeats', 'error', count(*) FROM (
        SELECT order_id, status FROM fct_order_items GROUP BY ALL HAVING count(*) >= 2)
      UNION ALL
      SELECT 'delivered_missing', 'warn', count(*) - count(delivered_at) FROM fct_order_items
      UNION ALL
      SELECT 'status_not_final', 'error', count(*) FILTER (WHERE status <> 'Complete' AND status <> 'Returned')
      FROM fct_order_items
      UNION ALL
      SELECT 'price_out_of_bounds', 'error', count(*) FILTER (WHERE sale_price < 1000 OR sale_price > 2000)
      FROM fct_order_items
      UNION ALL
      SELECT 'cost_over_half', 'error', count(*) FILTER (WHERE 2 * cost > sale_price) FROM fct_order_items)""")
def _q(spark, d):
    from .operators import quality
    from .plans import checks
    w = _wh(spark, d)
    return quality.run_checks(checks.VIOLATED, {
        "lines": w.fct_order_items, "orders_kept": w.fct_orders.filter(F.col("status") != "Cancelled")})


@register("source_freshness_orders",
          "SELECT 'orders' AS table_name, max(created_at) AS max_loaded_at, "
          "CAST(date_sub('second', max(created_at), TIMESTAMP '2001-08-02 07:00:00') AS BIGINT) AS age_seconds, "
          "CASE WHEN max(created_at) IS NULL THEN 'error' "
          "WHEN date_sub('second', max(created_at), TIMESTAMP '2001-08-02 07:00:00') > 72 * 3600 THEN 'error' "
          "WHEN date_sub('second', max(created_at), TIMESTAMP '2001-08-02 07:00:00') > 24 * 3600 THEN 'warn' "
          "ELSE 'pass' END AS status FROM stg_orders")
def _q(spark, d):
    """SRC13: the daily 07:00 run the day after the last order."""
    from .operators import quality
    return quality.freshness(_wh(spark, d).stg_orders, "orders", "created_at",
                             dt.datetime(2001, 8, 2, 7, 0), DEFAULT.freshness_warn_hours,
                             DEFAULT.freshness_error_hours)


# when the freshness of the orders, and of the events (shifted, see the roles), is looked at
_FRESHNESS_RUNS = (("orders", dt.datetime(2001, 8, 1, 18)), ("orders", dt.datetime(2001, 8, 2, 7)),
                   ("orders", dt.datetime(2001, 8, 4)), ("orders", dt.datetime(2001, 8, 4, 0, 0, 1)),
                   ("events", dt.datetime(2024, 1, 31, 12)), ("events", dt.datetime(2024, 3, 1)))


def _freshness_sql(table, now):
    return f"""SELECT '{table}' AS table_name, TIMESTAMP '{now}' AS looked_at, m AS max_loaded_at,
        CAST(floor((epoch_us(TIMESTAMP '{now}') - epoch_us(m)) / 1000000.0) AS BIGINT) AS age_seconds,
        CASE WHEN m IS NULL OR epoch_us(TIMESTAMP '{now}') - epoch_us(m) >= 259201000000 THEN 'error'
             WHEN epoch_us(TIMESTAMP '{now}') - epoch_us(m) >= 86401000000 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max({'o_orderdate' if table == 'orders' else 'ts'})::TIMESTAMP AS m FROM {table})"""


@register("source_freshness_states", " UNION ALL ".join(_freshness_sql(*r) for r in _FRESHNESS_RUNS))
def _q(spark, d):
    """SRC13, DQ13: pass, warn and error states of two raw tables, from the
    maxima in their files' footers."""
    from . import sources
    from .operators import quality
    columns = {"orders": "o_orderdate", "events": "ts"}
    newest = {t: sources.newest(spark, f"{d.rstrip('/')}/{t}.parquet", c) for t, c in columns.items()}
    out = None
    for table, now in _FRESHNESS_RUNS:
        row = quality.freshness_of(newest[table], table, now, DEFAULT.freshness_warn_hours, DEFAULT.freshness_error_hours) \
            .withColumn("looked_at", F.lit(str(now)).cast("timestamp_ntz"))
        out = row if out is None else out.unionByName(row)
    return out


# ---- metrics ------------------------------------------------------------------

_ALL_METRICS = ("revenue", "gross_margin", "units_sold", "orders", "aov")


@register("metric_all_by_month_status", f"""
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS metric_time, status,
           sum(sale_price) AS revenue, sum(gross_margin_amount) AS gross_margin,
           count(order_item_id) AS units_sold, count(DISTINCT order_id) AS orders,
           {oracle.ratio('sum(sale_price)', 'count(DISTINCT order_id)')} AS aov
    FROM fct_order_items GROUP BY 1, 2""", ("revenue", "gross_margin"))
def _q(spark, d):
    from .plans import metrics
    return metrics.query(_wh(spark, d).fct_order_items, _ALL_METRICS, by=["status"], grain="month")


@register("metric_all_by_day", f"""
    SELECT order_date AS metric_time, sum(sale_price) AS revenue,
           sum(gross_margin_amount) AS gross_margin, count(order_item_id) AS units_sold,
           count(DISTINCT order_id) AS orders,
           {oracle.ratio('sum(sale_price)', 'count(DISTINCT order_id)')} AS aov
    FROM fct_order_items GROUP BY 1""", ("revenue", "gross_margin"))
def _q(spark, d):
    from .plans import metrics
    return metrics.query(_wh(spark, d).fct_order_items, _ALL_METRICS, grain="day")


@register("metric_revenue_by_category_year", f"""
    SELECT CAST(date_trunc('year', f.order_date) AS DATE) AS metric_time, p.category AS product__category,
           sum(f.sale_price) AS revenue, count(DISTINCT f.order_id) AS orders,
           {oracle.ratio('sum(f.sale_price)', 'count(DISTINCT f.order_id)')} AS aov
    FROM fct_order_items f LEFT JOIN dim_products p ON f.product_id = p.product_id
    GROUP BY 1, 2""", ("revenue",))
def _q(spark, d):
    from .plans import metrics
    w = _wh(spark, d)
    return metrics.query(w.fct_order_items, ("revenue", "orders", "aov"), by=["product__category"],
                         grain="year", dims={"dim_products": w.dim_products})


@register("metric_complete_by_country", f"""
    SELECT c.country AS customer__country, sum(f.sale_price) AS revenue, count(DISTINCT f.order_id) AS orders,
           {oracle.ratio('sum(f.sale_price)', 'count(DISTINCT f.order_id)')} AS aov
    FROM fct_order_items f LEFT JOIN dim_customers c ON f.user_id = c.customer_id
    WHERE f.status = 'Complete' GROUP BY 1""", ("revenue",))
def _q(spark, d):
    from .plans import metrics
    w = _wh(spark, d)
    return metrics.query(w.fct_order_items, ("revenue", "orders", "aov"), by=["customer__country"], grain=None,
                         where="status = 'Complete'", dims={"dim_customers": w.dim_customers})


@register("metric_units_by_centre_quarter", """
    SELECT CAST(date_trunc('quarter', f.order_date) AS DATE) AS metric_time,
           c.distribution_center_name AS distribution_center__distribution_center_name,
           count(f.order_item_id) AS units_sold, sum(f.gross_margin_amount) AS gross_margin
    FROM fct_order_items f
    LEFT JOIN dim_distribution_centers c ON f.distribution_center_id = c.distribution_center_id
    WHERE c.distribution_center_name >= 'B' GROUP BY 1, 2""", ("gross_margin",))
def _q(spark, d):
    from .plans import metrics
    w = _wh(spark, d)
    centre = "distribution_center__distribution_center_name"
    return metrics.query(w.fct_order_items, ("units_sold", "gross_margin"), by=[centre], grain="quarter",
                         where=f"{centre} >= 'B'", dims={"dim_distribution_centers": w.dim_distribution_centers})


# ---- BI reports -----------------------------------------------------------------

def _bi(name, sql, money_cols, fn):
    register(name, sql, money_cols)(lambda spark, d: fn(_wh(spark, d)))


def _register_bi():
    from .plans import reports as R
    _bi("bi_kpis", f"""
        SELECT sum(gross_revenue) AS revenue, sum(gross_margin_amount) AS gross_margin,
               CAST(sum(n_line_items) AS BIGINT) AS units, count(*) AS orders,
               {oracle.ratio('sum(gross_revenue)', 'count(*)')} AS aov
        FROM fct_orders""", ("revenue", "gross_margin"), lambda w: R.kpis(w.fct_orders))
    _bi("bi_category_performance", f"""
        SELECT category, revenue, margin, units, {oracle.ratio('margin', 'revenue')} AS margin_pct
        FROM (SELECT category, sum(gross_revenue) AS revenue, sum(gross_margin_amount) AS margin,
                     CAST(sum(units_sold) AS BIGINT) AS units
              FROM mart_product_performance GROUP BY category)
        ORDER BY revenue DESC NULLS LAST, category ASC NULLS FIRST LIMIT 15""",
        ("revenue", "margin"), lambda w: R.category_performance(w.mart_product_performance()))
    _bi("bi_top_categories", f"""
        SELECT category, revenue, margin, units, {oracle.ratio('margin', 'revenue')} AS margin_pct
        FROM (SELECT category, sum(gross_revenue) AS revenue, sum(gross_margin_amount) AS margin,
                     CAST(sum(units_sold) AS BIGINT) AS units
              FROM mart_product_performance GROUP BY category)
        ORDER BY revenue DESC NULLS LAST, category ASC NULLS FIRST LIMIT 3""",
        ("revenue", "margin"), lambda w: R.category_performance(w.mart_product_performance(), top=3))
    _bi("bi_top_forecast_categories", """
        SELECT category, sum(predicted_units) AS forecast_8w FROM forecast_standin
        GROUP BY category ORDER BY forecast_8w DESC, category LIMIT 3""",
        (), lambda w: R.forecast_by_category(w.forecast, top=3))
    _bi("bi_monthly_trend", """
        SELECT month_start_date, sum(gross_revenue) AS revenue, CAST(sum(units_sold) AS BIGINT) AS units
        FROM mart_product_performance GROUP BY month_start_date ORDER BY month_start_date""",
        ("revenue",), lambda w: R.monthly_trend(w.mart_product_performance()))
    _bi("bi_abc_summary", """
        SELECT abc_class, count(*) AS skus, sum(inventory_cost_on_hand) AS capital,
               count(*) FILTER (WHERE is_dead_stock) AS dead_stock
        FROM mart_inventory_health GROUP BY abc_class ORDER BY abc_class""",
        ("capital",), lambda w: R.abc_summary(w.mart_inventory_health()))
    _bi("bi_rfm_segments", """
        SELECT segment, count(*) AS customers, sum(monetary) AS value
        FROM mart_customer_rfm GROUP BY segment ORDER BY customers DESC, segment""",
        ("value",), lambda w: R.rfm_segments(w.mart_customer_rfm()))
    _bi("bi_sla_by_centre", """
        SELECT distribution_center_name,
               round(CAST(sum(avg_hours_to_ship) AS DOUBLE) / CAST(count(avg_hours_to_ship) AS DOUBLE) * 1000000.0) / 1000000.0 AS hrs_ship,
               round(CAST(sum(avg_hours_to_deliver) AS DOUBLE) / CAST(count(avg_hours_to_deliver) AS DOUBLE) * 1000000.0) / 1000000.0 AS hrs_deliver
        FROM mart_fulfillment_sla WHERE distribution_center_name IS NOT NULL
        GROUP BY distribution_center_name ORDER BY hrs_ship""",
        (), lambda w: R.sla_by_centre(w.mart_fulfillment_sla()))
    _bi("bi_recommendation_status", """
        SELECT inventory_status, count(*) AS skus, sum(inventory_cost_on_hand) AS capital
        FROM mart_inventory_recommendations GROUP BY inventory_status
        ORDER BY skus DESC, inventory_status""",
        ("capital",), lambda w: R.recommendation_status(w.mart_inventory_recommendations()))
    _bi("bi_forecast_by_category", """
        SELECT category, sum(predicted_units) AS forecast_8w FROM forecast_standin
        GROUP BY category ORDER BY forecast_8w DESC, category LIMIT 15""",
        (), lambda w: R.forecast_by_category(w.forecast))


_register_bi()


# ---- forecast ------------------------------------------------------------------
# The fitted trees have no SQL form (rows only); all that feeds and judges them has.

#: the published forecast's run time (the morning after the as-of day)
GENERATED_AT = dt.datetime.combine(DEFAULT.as_of + dt.timedelta(days=1), dt.time(7))
_PANELS: dict[tuple, DataFrame] = {}
_NEXT_WEEKS: dict[tuple, DataFrame] = {}


def _panel(spark, d) -> DataFrame:
    """The demand panel, materialized once per session and directory."""
    key = _key(spark, d)
    if key not in _PANELS:
        _PANELS[key] = materialize(_wh(spark, d).mart_demand_features())
    return _PANELS[key]


def _next_weeks(spark, d) -> DataFrame:
    """The forecast of the next weeks, fitted once per session and directory."""
    from .plans import forecast
    key = _key(spark, d)
    if key not in _NEXT_WEEKS:
        _NEXT_WEEKS[key] = _wh(spark, d).published(forecast.forecast_next(_panel(spark, d), DEFAULT.horizon,
                                                                          generated_at=GENERATED_AT), "ml_forecast_trees")
    return _NEXT_WEEKS[key]


@register("forecast_backtest", None)
def _q(spark, d):
    from .plans import forecast
    return forecast.backtest(_panel(spark, d), DEFAULT.horizon)


@register("forecast_recursive", None)
def _q(spark, d): return _next_weeks(spark, d)


_HELD_OUT = f"(SELECT max(week_start_date) - {7 * (DEFAULT.horizon - 1)} AS vs FROM mart_demand_features)"


@register("forecast_training_rows", f"""
    SELECT category, week_start_date, units_sold, week_of_year, month_of_year, lag_1w, lag_2w, lag_4w, lag_8w,
           roll_mean_4w, roll_mean_12w, roll_std_12w, events_total, events_purchase, events_cart
    FROM mart_demand_features
    WHERE week_start_date < {_HELD_OUT} AND category IS NOT NULL AND units_sold IS NOT NULL
      AND lag_1w IS NOT NULL AND lag_2w IS NOT NULL AND lag_4w IS NOT NULL AND lag_8w IS NOT NULL
      AND week_of_year IS NOT NULL AND month_of_year IS NOT NULL AND roll_mean_4w IS NOT NULL
      AND roll_mean_12w IS NOT NULL AND roll_std_12w IS NOT NULL AND events_total IS NOT NULL
      AND events_purchase IS NOT NULL AND events_cart IS NOT NULL""")
def _q(spark, d):
    """ML3, FLT12-13: what the back-test's model learns from."""
    from .plans import forecast as fc
    panel = _panel(spark, d)
    return fc.training_rows(panel, fc.held_out_start(panel, DEFAULT.horizon)).select(
        "category", "week_start_date", fc.TARGET, *fc.NUMERIC_FEATURES)


_LAST_4 = f"""SELECT avg(t) AS events_total, avg(p) AS events_purchase, avg(c) AS events_cart
    FROM (SELECT week_start_date, max(events_total) AS t, max(events_purchase) AS p, max(events_cart) AS c
          FROM mart_demand_features WHERE week_start_date < {_HELD_OUT}
          GROUP BY week_start_date ORDER BY week_start_date DESC LIMIT 4)"""


@register("forecast_recent_events", _LAST_4)
def _q(spark, d):
    """ML5, AGG20: the event levels that the held-out weeks are forecast with."""
    from .plans import forecast as fc
    panel = _panel(spark, d)
    return fc.recent_events(panel, fc.held_out_start(panel, DEFAULT.horizon))


@register("forecast_step1_features", f"""
    SELECT category, hist, CAST(vs AS DATE) AS forecast_week, CAST(weekofyear(vs) AS DOUBLE) AS week_of_year,
           CAST(month(vs) AS DOUBLE) AS month_of_year, CAST(u[-1] AS DOUBLE) AS lag_1w,
           CAST(u[-2] AS DOUBLE) AS lag_2w, CAST(u[-4] AS DOUBLE) AS lag_4w, CAST(u[-8] AS DOUBLE) AS lag_8w,
           CAST(list_sum(u[-4:]) AS DOUBLE) / CAST(len(u[-4:]) AS DOUBLE) AS roll_mean_4w,
           CAST(list_sum(u) AS DOUBLE) / CAST(len(u) AS DOUBLE) AS roll_mean_12w, round(sd, 6) AS roll_std_12w,
           events_total, events_purchase, events_cart
    FROM (SELECT category, max(vs) AS vs, list(units_sold ORDER BY week_start_date) AS u,
                 string_agg(CAST(units_sold AS VARCHAR), ',' ORDER BY week_start_date) AS hist,
                 stddev_pop(units_sold) AS sd
          FROM (SELECT m.*, vs, row_number() OVER (PARTITION BY category ORDER BY week_start_date DESC) AS back
                FROM mart_demand_features m CROSS JOIN {_HELD_OUT} WHERE week_start_date < vs)
          WHERE back <= 12 GROUP BY category)
    CROSS JOIN ({_LAST_4})""")
def _q(spark, d):
    """SRT7, FN20-22: history state and features of the first forecast week."""
    from .plans import forecast as fc
    panel = _panel(spark, d)
    start = fc.held_out_start(panel, DEFAULT.horizon)
    feats = fc.step_features(fc.history_state(panel, start), F.lit(start), fc.recent_events(panel, start))
    return feats.withColumn("hist", F.array_join(F.transform("hist", lambda x: x.cast("long").cast("string")), ",")) \
        .withColumn("roll_std_12w", F.round("roll_std_12w", 6))


def _linear_recursion() -> str:
    from .plans.forecast import BASELINE_STEP
    return f"""
    WITH RECURSIVE steps AS (
      SELECT category, 0 AS step, hist, CAST(NULL AS DOUBLE) AS units
      FROM (SELECT category, list(CAST(units_sold AS DOUBLE) ORDER BY week_start_date) AS hist
            FROM (SELECT m.*, row_number() OVER (PARTITION BY category ORDER BY week_start_date DESC) AS back
                  FROM mart_demand_features m CROSS JOIN {_HELD_OUT} WHERE week_start_date < vs)
            WHERE back <= 12 GROUP BY category)
      UNION ALL
      SELECT category, step + 1, list_append(hist[-11:], p), p
      FROM (SELECT category, step, hist, greatest({BASELINE_STEP.sql()}, CAST(0 AS DOUBLE)) AS p
            FROM (SELECT category, step, hist, CAST(weekofyear(week) AS DOUBLE) AS week_of_year,
                         CAST(month(week) AS DOUBLE) AS month_of_year, hist[-1] AS lag_1w, hist[-2] AS lag_2w,
                         hist[-4] AS lag_4w, hist[-8] AS lag_8w, list_avg(hist[-4:]) AS roll_mean_4w,
                         list_avg(hist) AS roll_mean_12w, list_stddev_pop(hist) AS roll_std_12w,
                         events_total, events_purchase, events_cart
                  FROM (SELECT category, step, hist, CAST(vs AS DATE) + 7 * step AS week FROM steps CROSS JOIN {_HELD_OUT})
                  CROSS JOIN recent)
            WHERE step < {DEFAULT.horizon}))
    SELECT category, CAST(vs AS DATE) + CAST(7 * (step - 1) AS INTEGER) AS forecast_week, CAST(step AS BIGINT) AS week_ahead,
           round(units, 2) AS predicted_units
    FROM steps CROSS JOIN {_HELD_OUT} WHERE step > 0""".replace("WITH RECURSIVE steps AS", f"WITH RECURSIVE recent AS ({_LAST_4}), steps AS")


def _linear(spark, d, how):
    from .plans import forecast as fc
    panel = _panel(spark, d)
    start = fc.held_out_start(panel, DEFAULT.horizon)
    return how(fc.BASELINE_STEP, panel, start, DEFAULT.horizon, fc.recent_events(panel, start))


@register("forecast_linear_recursion", f"SELECT * FROM ({_linear_recursion()})")
def _q(spark, d):
    """ML4, FN20: the recursion of the forecast around a linear step model."""
    from .plans import forecast as fc
    return _linear(spark, d, fc.recursive_forecast)


@register("forecast_linear_recursion_sql", f"SELECT * FROM ({_linear_recursion()})")
def _q(spark, d):
    """The same as one recursive common table expression."""
    from .plans import forecast as fc
    return _linear(spark, d, fc.recursive_sql)


_RECENT_MEAN_SCORES = f"""
    SELECT coalesce(CAST(week_ahead AS VARCHAR), 'overall') AS horizon, round(avg(err), 2) AS mae,
           round(sum(err) / greatest(CAST(sum(units_sold) AS DOUBLE), 1.0), 4) AS wape, count(*) AS n_points,
           CAST(max(vs) AS DATE) AS valid_start
    FROM (SELECT a.units_sold, vs, abs(h.mean4 - a.units_sold) AS err,
                 CAST(date_diff('day', vs, a.week_start_date) // 7 + 1 AS BIGINT) AS week_ahead
          FROM mart_demand_features a CROSS JOIN {_HELD_OUT}
          JOIN (SELECT category, round(CAST(sum(units_sold) AS DOUBLE) / CAST(count(*) AS DOUBLE), 2) AS mean4
                FROM mart_demand_features CROSS JOIN {_HELD_OUT}
                WHERE week_start_date < vs AND week_start_date >= vs - 28 GROUP BY category) h
            ON a.category = h.category
          WHERE a.week_start_date >= vs)
    GROUP BY ROLLUP (week_ahead)"""


@register("forecast_recent_mean_backtest", _RECENT_MEAN_SCORES)
def _q(spark, d):
    """ML6, AGG19: the back-test's scores, of the baseline forecast."""
    from .plans import forecast as fc
    panel = _panel(spark, d)
    start = fc.held_out_start(panel, DEFAULT.horizon)
    return fc.score(fc.recent_mean(panel, start, DEFAULT.horizon), panel, start)


@register("forecast_metrics_published", f"""
    SELECT CASE WHEN horizon <> 'overall' THEN CAST(horizon AS BIGINT) END AS week_ahead, mae, wape, valid_start,
           max(n_points) FILTER (WHERE horizon = 'overall') OVER () AS n_valid_points, CAST({DEFAULT.horizon} AS BIGINT) AS horizon
    FROM ({_RECENT_MEAN_SCORES})""")
def _q(spark, d):
    """SNK12: the scores written as one nested JSON report, and read back."""
    from .plans import forecast as fc
    panel = _panel(spark, d)
    start = fc.held_out_start(panel, DEFAULT.horizon)
    scores = fc.score(fc.recent_mean(panel, start, DEFAULT.horizon), panel, start)
    path, _ = _scratch(spark, "metrics")
    fc.write_metrics(scores, path, DEFAULT.horizon, GENERATED_AT)
    return fc.read_metrics(spark, path)


# ---- controlled copy -------------------------------------------------------------

@register("controlled_copy_drift", """
    SELECT coalesce(o.product_id, n.product_id) AS product_id,
           CASE WHEN n.product_id IS NULL THEN 'vanished' WHEN o.product_id IS NULL THEN 'added' ELSE 'changed' END AS change,
           CASE WHEN o.product_id IS NOT NULL AND n.product_id IS NOT NULL THEN concat_ws(',',
             CASE WHEN o.product_name IS DISTINCT FROM n.product_name THEN 'product_name' END,
             CASE WHEN o.cost IS DISTINCT FROM n.cost THEN 'cost' END,
             CASE WHEN o.retail_price IS DISTINCT FROM n.retail_price THEN 'retail_price' END) END AS columns
    FROM (SELECT * FROM stg_products WHERE product_id % 5 <> 0) o
    FULL JOIN (SELECT product_id, CASE WHEN product_id % 7 = 0 THEN NULL ELSE product_name END AS product_name,
                      CASE WHEN product_id % 3 = 0 THEN cost + 5 ELSE cost END AS cost,
                      CASE WHEN product_id % 4 = 0 THEN retail_price + 1 ELSE retail_price END AS retail_price
               FROM stg_products WHERE product_id % 11 <> 0) n ON o.product_id = n.product_id
    WHERE o.product_id IS NULL OR n.product_id IS NULL OR o.product_name IS DISTINCT FROM n.product_name
       OR o.cost IS DISTINCT FROM n.cost OR o.retail_price IS DISTINCT FROM n.retail_price""")
def _q(spark, d):
    """SNK6, SRC9: a copy of the catalogue is made once; a second run over a
    changed catalogue leaves it, and the drift between the two is reported."""
    from .operators import controlled_copy
    from .operators.versioned import VersionedTable
    products = _wh(spark, d).stg_products
    table = VersionedTable(spark, _scratch(spark, "controlled_products")[0])
    now = products.filter("product_id % 11 <> 0").withColumns({
        "product_name": F.expr("CASE WHEN product_id % 7 <> 0 THEN product_name END"),
        "cost": F.expr("CASE WHEN product_id % 3 = 0 THEN cost + 5 ELSE cost END"),
        "retail_price": F.expr("CASE WHEN product_id % 4 = 0 THEN retail_price + 1 ELSE retail_price END")})
    made = [controlled_copy.create_once(table, df) for df in (products.filter("product_id % 5 <> 0"), now)]
    if made != [True, False]:
        raise AssertionError(f"the copy was replaced: {made}")
    return controlled_copy.drift(table.read(), now, "product_id")


# ---- streaming ------------------------------------------------------------------

def _stream_source(spark, sf_dir, table):
    from .sources import driver
    schema = driver.read(spark, sf_dir, table).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf_dir))


def _scratch(spark, what):
    import uuid
    from .session import table_root
    base = f"{table_root(spark)}/shelfline_{uuid.uuid4().hex}"
    return f"{base}/{what}", f"{base}/_checkpoints/{what}"


@register("stream_weekly_events", "SELECT * FROM weekly_events")
def _q(spark, d):
    """STR1: the events table replayed as a stream (availableNow)."""
    from . import streaming
    from .plans import staging
    from .sources import driver
    ev = staging.stg_events(driver.events(_stream_source(spark, d, "events")))
    path, ck = _scratch(spark, "weekly_events")
    weeks = streaming.weekly_event_counts(ev)
    streaming.write_touched_weeks(weeks, path, ck).awaitTermination()
    return spark.read.schema(weeks.schema).parquet(path).select(*weeks.columns)


@register("stream_fct_order_items_upkeep", "SELECT * FROM fct_order_items", _ENRICHED_MONEY)
def _q(spark, d):
    """STR2: a feed of changed lines in four files, a batch each; every batch
    rebuilds the order dates it touches from the sources laid out by day.  The
    first batch comes once more at the end and is left out by the ledger."""
    from . import streaming
    from .operators import contracts
    dated, (path, ck) = _dated(spark, d), _scratch(spark, "fct_order_items")
    feed = f"{_scratch(spark, 'feed')[0]}"
    changed = dated.lines.select("order_item_id", "order_date")
    changed.repartitionByRange(4, "order_date").write.parquet(feed)
    days, clusters = (lambda batch: batch.select("order_date")), ("product_id", "distribution_center_id")
    stream = spark.readStream.schema(changed.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    streaming.upkeep_partitions(stream, days, dated.fct_order_items_on, path, "order_date", ck, clusters).awaitTermination()
    streaming.upkeep_batch(spark.read.schema(changed.schema).parquet(feed).limit(1), 0, days, dated.fct_order_items_on, path,
                           "order_date", clusters, streaming.BatchLedger(spark, f"{ck}.ledger"))
    cols = [n for n, _, _ in contracts.FCT_ORDER_ITEMS.columns]
    return spark.read.parquet(path).select(*cols)


@register("incremental_fct_inventory_snapshot", "SELECT * FROM fct_inventory_snapshot",
          ("inventory_cost_on_hand",))
def _q(spark, d):
    """MOD9 incremental: a run as of 10 days earlier, then a run from
    max(snapshot_date) - 3 days on that adds the movements since to the balances
    stored for the day before."""
    from .operators import incremental
    from .plans import core
    w, dated, p = _wh(spark, d), _dated(spark, d), DEFAULT
    path, _ = _scratch(spark, "fct_inventory_snapshot")

    def build(as_of):
        def run(cutoff):
            carried = None
            if cutoff is not None:
                carried = dated.fct_inventory_snapshot(spark, path, cutoff, as_of, p.calendar_start, p.calendar_end)
            if carried is not None:
                return carried
            return core.fct_inventory_snapshot(w.stg_inventory_items, cutoff or p.window_start, as_of,
                                               p.calendar_start, p.calendar_end)
        return run
    for as_of in (p.as_of - dt.timedelta(days=10), p.as_of):
        incremental.build_incremental(spark, build(as_of), path, "snapshot_date", p.lookback_days,
                                      ("product_id", "distribution_center_id"), "sync_all_columns")
    return incremental.read_table(spark, path).select("product_id", "distribution_center_id", "snapshot_date",
                                                      "units_on_hand", "inventory_cost_on_hand")


@register("metric_revenue_by_day_spine", f"""
    SELECT d.date_day AS metric_time, m.revenue, m.orders
    FROM dim_dates d LEFT JOIN (SELECT order_date, sum(sale_price) AS revenue,
                                       count(DISTINCT order_id) AS orders
                                FROM fct_order_items GROUP BY order_date) m
      ON d.date_day = m.order_date""", ("revenue",))
def _q(spark, d):
    """MET8: day grain densified over the time spine (days without sales: null)."""
    from .plans import metrics
    from .sources import calendar
    w = _wh(spark, d)
    res = metrics.query(w.fct_order_items, ("revenue", "orders"), grain="day")
    return metrics.time_spine_fill(res, F.broadcast(calendar.time_spine(w.dim_dates)),
                                   ("revenue", "orders"))


@register("mart_inventory_recommendations_ml", None)
def _q(spark, d):
    """ML9: recommendations fed by the Spark ML forecast instead of the stand-in."""
    from .plans import marts
    w, p = _wh(spark, d), DEFAULT
    return marts.mart_inventory_recommendations(
        w.inventory_latest, _next_weeks(spark, d), w.fct_order_items, w.dim_products, p.lead_weeks, p.safety_weeks,
        p.target_weeks, p.overstock_weeks_of_cover, as_of=w.snapshot_as_of)
