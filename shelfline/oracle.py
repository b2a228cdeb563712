"""DuckDB reference SQL for the registered queries (the correctness oracle).

Each model is written once as a named CTE; a query is the CTEs it needs (in
dependency order) plus a final SELECT.  The SQL is an independent plain-SQL
formulation of the same semantics (balances counted day by day, global windows,
the original OR-predicate as-of join) so that it checks the Spark rewrites rather than
repeating them.  Money leaves as DOUBLE via DECIMAL(18,2); float results are
built from exact sums with one final division, as on the Spark side.
"""

from __future__ import annotations

import re

from .params import DEFAULT, Params


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def money(e: str) -> str:
    return f"CAST(CAST({e} AS DECIMAL(18,2)) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def ctes(p: Params = DEFAULT) -> dict[str, str]:
    lo = max(p.window_start, p.calendar_start)
    hi = min(p.as_of, p.calendar_end)
    lead, safety, target = float(p.lead_weeks), float(p.safety_weeks), float(p.target_weeks)
    c: dict[str, str] = {}

    # ---- roles over the driver tables ------------------------------------
    c["r_dcs"] = """
      SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name,
             CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
             CAST(NULL AS VARCHAR) AS distribution_center_geom
      FROM region"""
    c["r_products"] = """
      SELECT CAST(p_partkey AS BIGINT) AS id, CAST(p_partkey % 5 AS BIGINT) AS distribution_center_id,
             p_name AS name, p_type AS category, p_brand AS brand,
             CASE WHEN p_size <= 25 THEN 'Women' ELSE 'Men' END AS department,
             'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
             CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.60 AS DECIMAL(12,2)) AS cost,
             CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price
      FROM part"""
    c["r_versions"] = """
      SELECT id AS product_id, name AS product_name, category, brand, department, sku,
             distribution_center_id,
             CAST(cost - (nv - k) * 10 AS DECIMAL(12,2)) AS cost, retail_price,
             CASE k WHEN 1 THEN TIMESTAMP '1996-01-01 00:00:00'
                    WHEN 2 THEN TIMESTAMP '1998-01-01 00:00:00'
                    ELSE TIMESTAMP '2000-01-01 00:00:00' END AS valid_from,
             CASE WHEN k < nv THEN (CASE k WHEN 1 THEN TIMESTAMP '1998-01-01 00:00:00'
                                          ELSE TIMESTAMP '2000-01-01 00:00:00' END) END AS valid_to
      FROM (SELECT *, unnest(generate_series(1, nv)) AS k
            FROM (SELECT *, CAST(id % 3 + 1 AS INTEGER) AS nv FROM r_products))"""
    c["r_users"] = """
      SELECT CAST(c_custkey AS BIGINT) AS id, 'Customer' AS first_name,
             CAST(c_custkey AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS email,
             CAST(NULL AS BIGINT) AS age,
             CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
             CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS street_address,
             CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS VARCHAR) AS city,
             n_name AS country, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
             c_mktsegment AS traffic_source,
             TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
             CAST(NULL AS VARCHAR) AS user_geom
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
    status = """CASE WHEN o_orderkey % 10 = 0 THEN 'Cancelled'
                     WHEN o_orderstatus = 'F' THEN 'Complete'
                     WHEN o_orderstatus = 'O' THEN 'Shipped'
                     WHEN o_orderstatus = 'P' THEN 'Processing' END"""
    c["r_orders_base"] = f"""
      SELECT o_orderkey, o_custkey, CAST(o_orderdate AS TIMESTAMP) AS created_at, {status} AS status
      FROM orders"""
    c["r_orders"] = """
      SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS user_id, status,
             CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, created_at,
             shipped_at,
             CASE WHEN status = 'Complete'
                  THEN shipped_at + to_minutes(CAST(60 * (24 + o_orderkey % 72) AS BIGINT)) END AS delivered_at,
             CAST(NULL AS TIMESTAMP) AS returned_at,
             CAST(1 + o_orderkey % 4 AS BIGINT) AS num_of_item
      FROM (SELECT *, CASE WHEN status IN ('Complete', 'Shipped')
                           THEN created_at + to_minutes(CAST(60 * (6 + o_orderkey % 60) AS BIGINT)) END AS shipped_at
            FROM r_orders_base)"""
    c["r_lines"] = """
      SELECT l.*, o.o_custkey, o.created_at, o.status,
             CAST(l.l_orderkey * 1000 + l.rn AS BIGINT) AS id
      FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
                l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_linenumber NULLS FIRST,
                l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
                l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
                l_shipdate NULLS FIRST) AS rn
            FROM lineitem) l
      JOIN r_orders_base o ON l.l_orderkey = o.o_orderkey"""
    c["r_order_items"] = """
      SELECT id, order_id, user_id, product_id, inventory_item_id, status, created_at, shipped_at,
             delivered_at,
             CASE WHEN status = 'Complete' AND l_returnflag = 'R'
                  THEN delivered_at + INTERVAL 7 DAY END AS returned_at,
             sale_price
      FROM (SELECT *, CASE WHEN status = 'Complete'
                           THEN shipped_at + to_minutes(CAST(60 * (24 + id % 72) + l_partkey % 53 AS BIGINT)) END
                      AS delivered_at
            FROM (SELECT id, CAST(l_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS user_id,
                         CAST(l_partkey AS BIGINT) AS product_id, id AS inventory_item_id, status,
                         created_at, l_partkey, l_returnflag,
                         CASE WHEN status IN ('Complete', 'Shipped')
                              THEN created_at + to_minutes(CAST(60 * (6 + (7 * l_linenumber + l_orderkey) % 60)
                                                                + l_partkey % 60 AS BIGINT)) END AS shipped_at,
                         CAST(l_extendedprice AS DECIMAL(12,2)) AS sale_price
                  FROM r_lines))"""
    c["r_inventory_items"] = """
      SELECT l.id, CAST(l.l_partkey AS BIGINT) AS product_id,
             l.created_at - to_days(CAST(l.l_quantity AS INTEGER)) AS created_at,
             CASE WHEN l.l_linestatus = 'F' THEN l.created_at END AS sold_at,
             CAST(p.cost + (l.id % 7) AS DECIMAL(12,2)) AS cost,
             p.category AS product_category, p.name AS product_name, p.brand AS product_brand,
             p.retail_price AS product_retail_price, p.department AS product_department,
             p.sku AS product_sku, CAST(n.n_regionkey AS BIGINT) AS product_distribution_center_id
      FROM r_lines l
      LEFT JOIN r_products p ON l.l_partkey = p.id
      LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
      LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
      WHERE l.id % 97 <> 0"""
    c["r_events"] = """
      SELECT CAST(event_id AS BIGINT) AS id, CAST(user_id AS BIGINT) AS user_id,
             CAST(ts AS TIMESTAMP) - INTERVAL 8218 DAY AS created_at,
             CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type
      FROM events"""

    # ---- staging ----------------------------------------------------------
    c["stg_orders"] = """
      SELECT order_id, user_id, status, gender, created_at, returned_at, shipped_at, delivered_at,
             num_of_item AS num_of_items FROM r_orders"""
    c["stg_order_items"] = """
      SELECT id AS order_item_id, order_id, user_id, product_id, inventory_item_id, status,
             created_at, shipped_at, delivered_at, returned_at, sale_price FROM r_order_items"""
    c["stg_products"] = """
      SELECT id AS product_id, distribution_center_id, name AS product_name, category, brand,
             department, sku, cost, retail_price FROM r_products"""
    c["stg_users"] = """
      SELECT id AS user_id, first_name, last_name, email, age, gender, state, street_address,
             postal_code, city, country, latitude, longitude, traffic_source, created_at, user_geom
      FROM r_users"""
    c["stg_inventory_items"] = """
      SELECT id AS inventory_item_id, product_id, created_at, sold_at, cost, product_category,
             product_name, product_brand, product_retail_price AS retail_price, product_department,
             product_sku, product_distribution_center_id AS distribution_center_id
      FROM r_inventory_items"""
    c["stg_distribution_centers"] = """
      SELECT id AS distribution_center_id, name AS distribution_center_name, latitude, longitude,
             distribution_center_geom FROM r_dcs"""
    c["stg_events"] = "SELECT id AS event_id, user_id, created_at, event_type FROM r_events"

    # ---- dims and facts ---------------------------------------------------
    c["dim_dates"] = f"""
      SELECT CAST(d AS DATE) AS date_day, CAST(date_trunc('month', d) AS DATE) AS month_start_date
      FROM (SELECT unnest(generate_series({_d(p.calendar_start)}, {_d(p.calendar_end)},
                                          INTERVAL 1 DAY)) AS d)"""
    c["customer_orders"] = """
      SELECT user_id, min(created_at) AS first_order_at, max(created_at) AS most_recent_order_at,
             count(*) AS lifetime_orders
      FROM stg_orders GROUP BY user_id"""
    c["dim_products"] = f"""
      SELECT product_id, distribution_center_id, product_name, category, brand, department, sku,
             cost, retail_price, retail_price - cost AS base_margin_amount,
             {ratio('retail_price - cost', 'retail_price')} AS base_margin_pct
      FROM stg_products"""
    c["dim_customers"] = """
      SELECT u.user_id AS customer_id, u.first_name, u.last_name, u.email, u.age, u.gender,
             u.country, u.state, u.city, u.postal_code, u.traffic_source,
             u.created_at AS signed_up_at, c.first_order_at, c.most_recent_order_at,
             CAST(coalesce(c.lifetime_orders, 0) AS BIGINT) AS lifetime_orders,
             c.first_order_at IS NOT NULL AS has_ordered
      FROM stg_users u LEFT JOIN customer_orders c ON u.user_id = c.user_id"""
    c["dim_distribution_centers"] = """
      SELECT distribution_center_id, distribution_center_name, latitude, longitude
      FROM stg_distribution_centers"""
    c["versions_ranked"] = """
      SELECT product_id, cost AS version_cost, valid_from, valid_to,
             row_number() OVER (PARTITION BY product_id ORDER BY valid_from) AS version_num,
             min(valid_from) OVER (PARTITION BY product_id) AS first_valid_from
      FROM r_versions"""
    c["enriched"] = """
      SELECT i.order_item_id, i.order_id, i.user_id, i.product_id, i.inventory_item_id,
             u.distribution_center_id, i.status, i.sale_price, u.cost,
             i.sale_price - u.cost AS gross_margin_amount,
             v.version_cost AS product_cost_at_sale,
             i.sale_price - v.version_cost AS gross_margin_at_sale,
             i.created_at, i.shipped_at, i.delivered_at, i.returned_at
      FROM stg_order_items i
      LEFT JOIN stg_inventory_items u ON i.inventory_item_id = u.inventory_item_id
      LEFT JOIN versions_ranked v
        ON i.product_id = v.product_id
       AND ((i.created_at >= v.valid_from AND (i.created_at < v.valid_to OR v.valid_to IS NULL))
            OR (i.created_at < v.first_valid_from AND v.version_num = 1))"""
    c["fct_order_items"] = """
      SELECT order_item_id, order_id, user_id, product_id, distribution_center_id,
             inventory_item_id, CAST(created_at AS DATE) AS order_date, status,
             created_at AS ordered_at, shipped_at, delivered_at, returned_at, sale_price, cost,
             gross_margin_amount, product_cost_at_sale, gross_margin_at_sale
      FROM enriched"""
    c["fct_orders"] = """
      SELECT o.order_id, o.user_id, CAST(o.created_at AS DATE) AS order_date, o.status, o.gender,
             o.created_at AS ordered_at, o.shipped_at, o.delivered_at, o.returned_at,
             o.num_of_items, t.n_line_items, t.gross_revenue, t.total_cost, t.gross_margin_amount
      FROM stg_orders o
      LEFT JOIN (SELECT order_id, count(*) AS n_line_items, sum(sale_price) AS gross_revenue,
                        sum(cost) AS total_cost, sum(sale_price - cost) AS gross_margin_amount
                 FROM enriched GROUP BY order_id) t
        ON o.order_id = t.order_id"""

    # ---- inventory: a day's balance is what has come in by then less what has gone out ----
    c["inv_units"] = """
      SELECT product_id, distribution_center_id, coalesce(cost, 0) AS cost,
             CAST(created_at AS DATE) AS in_date, CAST(sold_at AS DATE) AS out_date
      FROM stg_inventory_items"""
    c["fct_inventory_snapshot"] = f"""
      SELECT p.product_id, p.distribution_center_id, CAST(p.day AS DATE) AS snapshot_date,
             count(*) FILTER (WHERE u.in_date <= p.day) - count(*) FILTER (WHERE u.out_date <= p.day) AS units_on_hand,
             coalesce(sum(u.cost) FILTER (WHERE u.in_date <= p.day), 0)
               - coalesce(sum(u.cost) FILTER (WHERE u.out_date <= p.day), 0) AS inventory_cost_on_hand
      FROM (SELECT product_id, distribution_center_id, unnest(generate_series({_d(lo)}, {_d(hi)}, INTERVAL 1 DAY)) AS day
            FROM inv_units GROUP BY product_id, distribution_center_id) p
      LEFT JOIN inv_units u ON u.product_id = p.product_id AND u.distribution_center_id = p.distribution_center_id
      GROUP BY p.product_id, p.distribution_center_id, p.day"""
    c["inventory_latest"] = """
      SELECT * FROM fct_inventory_snapshot
      WHERE snapshot_date = (SELECT max(snapshot_date) FROM fct_inventory_snapshot)"""

    # ---- marts --------------------------------------------------------------
    c["mart_product_performance"] = f"""
      SELECT a.product_id, p.product_name, p.category, p.brand, p.department,
             p.distribution_center_id, a.month_start_date, a.units_sold, a.n_orders,
             a.gross_revenue, a.total_cost, a.gross_margin_amount,
             {ratio('a.gross_margin_amount', 'a.gross_revenue')} AS gross_margin_pct
      FROM (SELECT f.product_id, d.month_start_date, count(*) AS units_sold,
                   count(DISTINCT f.order_id) AS n_orders, sum(f.sale_price) AS gross_revenue,
                   sum(f.cost) AS total_cost, sum(f.gross_margin_amount) AS gross_margin_amount
            FROM fct_order_items f JOIN dim_dates d ON f.order_date = d.date_day
            GROUP BY f.product_id, d.month_start_date) a
      LEFT JOIN dim_products p ON a.product_id = p.product_id"""
    c["mart_fulfillment_sla"] = f"""
      SELECT a.distribution_center_id, c.distribution_center_name, a.month_start_date, a.n_lines,
             a.n_shipped, a.n_delivered,
             {ratio('a.s_ship', 'a.c_ship')} AS avg_hours_to_ship,
             {ratio('a.s_del', 'a.c_del')} AS avg_hours_to_deliver,
             {ratio('a.s_tot', 'a.c_tot')} AS avg_hours_order_to_deliver,
             {ratio('a.n_delivered', 'a.n_lines')} AS pct_delivered
      FROM (SELECT distribution_center_id, month_start_date, count(*) AS n_lines,
                   count(shipped_at) AS n_shipped, count(delivered_at) AS n_delivered,
                   sum(h1) AS s_ship, count(h1) AS c_ship, sum(h2) AS s_del, count(h2) AS c_del,
                   sum(h3) AS s_tot, count(h3) AS c_tot
            FROM (SELECT f.distribution_center_id, d.month_start_date, f.shipped_at, f.delivered_at,
                         date_sub('hour', f.ordered_at, f.shipped_at) AS h1,
                         date_sub('hour', f.shipped_at, f.delivered_at) AS h2,
                         date_sub('hour', f.ordered_at, f.delivered_at) AS h3
                  FROM fct_order_items f JOIN dim_dates d ON f.order_date = d.date_day)
            GROUP BY distribution_center_id, month_start_date) a
      LEFT JOIN dim_distribution_centers c ON a.distribution_center_id = c.distribution_center_id"""
    c["rfm_scored"] = """
      SELECT customer_id, recency_days, frequency, monetary,
             CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST, customer_id ASC NULLS FIRST) AS BIGINT) AS r_score,
             CAST(ntile(5) OVER (ORDER BY frequency ASC NULLS FIRST, customer_id ASC NULLS FIRST) AS BIGINT) AS f_score,
             CAST(ntile(5) OVER (ORDER BY monetary ASC NULLS FIRST, customer_id ASC NULLS FIRST) AS BIGINT) AS m_score
      FROM (SELECT user_id AS customer_id,
                   CAST(date_diff('day', max(order_date), (SELECT max(order_date) FROM fct_orders)) AS BIGINT) AS recency_days,
                   count(DISTINCT order_id) AS frequency, sum(gross_revenue) AS monetary
            FROM fct_orders WHERE status <> 'Cancelled' GROUP BY user_id)"""
    c["mart_customer_rfm"] = """
      SELECT s.customer_id, c.first_name, c.last_name, c.country, c.traffic_source,
             s.recency_days, s.frequency, s.monetary, s.r_score, s.f_score, s.m_score,
             s.r_score * 100 + s.f_score * 10 + s.m_score AS rfm_score,
             s.frequency > 1 AS is_repeat_customer,
             CASE WHEN s.r_score >= 4 AND s.f_score >= 4 THEN 'Champions'
                  WHEN s.r_score >= 3 AND s.f_score >= 3 THEN 'Loyal'
                  WHEN s.r_score >= 4 AND s.f_score <= 2 THEN 'New'
                  WHEN s.r_score <= 2 AND s.f_score >= 3 THEN 'At Risk'
                  WHEN s.r_score <= 2 AND s.f_score <= 2 THEN 'Hibernating'
                  ELSE 'Others' END AS segment
      FROM rfm_scored s LEFT JOIN dim_customers c ON s.customer_id = c.customer_id"""
    c["abc_class"] = f"""
      SELECT product_id,
             CASE WHEN pct <= 0.80 THEN 'A' WHEN pct <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
      FROM (SELECT product_id,
                   {ratio(money('sum(revenue_12m) OVER (ORDER BY revenue_12m DESC)'), money('sum(revenue_12m) OVER ()'))} AS pct
            FROM (SELECT product_id, sum(sale_price) AS revenue_12m FROM fct_order_items
                  WHERE order_date > (SELECT max(snapshot_date) FROM inventory_latest) - 365
                  GROUP BY product_id))"""
    c["mart_inventory_health"] = """
      SELECT i.product_id, i.distribution_center_id, p.product_name, p.category, i.units_on_hand,
             i.inventory_cost_on_hand, CAST(coalesce(s.u, 0) AS BIGINT) AS units_sold_90d,
             CAST(coalesce(s.u, 0) AS DOUBLE) / 90.0 AS avg_daily_units,
             CAST(i.units_on_hand AS DOUBLE) / NULLIF(CAST(coalesce(s.u, 0) AS DOUBLE) / 90.0, 0) AS days_of_coverage,
             CAST(coalesce(s.u, 0) AS DOUBLE) / NULLIF(CAST(coalesce(s.u, 0) + i.units_on_hand AS DOUBLE), 0) AS sell_through_90d,
             i.units_on_hand > 0 AND coalesce(s.u, 0) = 0 AS is_dead_stock,
             coalesce(a.abc_class, 'C') AS abc_class
      FROM inventory_latest i
      LEFT JOIN dim_products p ON i.product_id = p.product_id
      LEFT JOIN (SELECT product_id, distribution_center_id, count(*) AS u FROM fct_order_items
                 WHERE order_date > (SELECT max(snapshot_date) FROM inventory_latest) - 90
                 GROUP BY product_id, distribution_center_id) s
        ON i.product_id = s.product_id AND i.distribution_center_id = s.distribution_center_id
      LEFT JOIN abc_class a ON i.product_id = a.product_id"""
    c["weekly_events"] = """
      SELECT CAST(date_trunc('week', CAST(created_at AS DATE)) AS DATE) AS week_start_date,
             count(*) AS events_total,
             count(*) FILTER (WHERE event_type = 'purchase') AS events_purchase,
             count(*) FILTER (WHERE event_type = 'cart') AS events_cart
      FROM stg_events GROUP BY 1"""
    w4 = "PARTITION BY category ORDER BY week_start_date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING"
    w12 = "PARTITION BY category ORDER BY week_start_date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING"
    c["demand_panel"] = """
      SELECT s.category, s.week_start_date,
             CAST(coalesce(ws.units, 0) AS BIGINT) AS units_sold,
             coalesce(ws.revenue, 0) AS revenue,
             CAST(coalesce(e.events_total, 0) AS BIGINT) AS events_total,
             CAST(coalesce(e.events_purchase, 0) AS BIGINT) AS events_purchase,
             CAST(coalesce(e.events_cart, 0) AS BIGINT) AS events_cart
      FROM (SELECT c.category, w.week_start_date
            FROM (SELECT DISTINCT category FROM dim_products WHERE category IS NOT NULL) c
            CROSS JOIN (SELECT CAST(unnest(generate_series(date_trunc('week', min(order_date)),
                                                           date_trunc('week', max(order_date)),
                                                           INTERVAL 7 DAY)) AS DATE) AS week_start_date
                        FROM fct_order_items) w) s
      LEFT JOIN (SELECT p.category, CAST(date_trunc('week', f.order_date) AS DATE) AS week_start_date,
                        count(*) AS units, sum(f.sale_price) AS revenue
                 FROM fct_order_items f JOIN dim_products p ON f.product_id = p.product_id
                 WHERE p.category IS NOT NULL GROUP BY 1, 2) ws
        ON s.category = ws.category AND s.week_start_date = ws.week_start_date
      LEFT JOIN weekly_events e ON s.week_start_date = e.week_start_date"""
    c["mart_demand_features"] = f"""
      SELECT category, week_start_date, units_sold, revenue, events_total, events_purchase,
             events_cart,
             CAST(weekofyear(week_start_date) AS BIGINT) AS week_of_year,
             CAST(month(week_start_date) AS BIGINT) AS month_of_year,
             CAST(year(week_start_date) AS BIGINT) AS year_number,
             lag(units_sold, 1) OVER w AS lag_1w, lag(units_sold, 2) OVER w AS lag_2w,
             lag(units_sold, 4) OVER w AS lag_4w, lag(units_sold, 8) OVER w AS lag_8w,
             {ratio(f'sum(units_sold) OVER ({w4})', f'count(units_sold) OVER ({w4})')} AS roll_mean_4w,
             {ratio(f'sum(units_sold) OVER ({w12})', f'count(units_sold) OVER ({w12})')} AS roll_mean_12w,
             sqrt(CAST(count(units_sold) OVER ({w12}) * sum(CAST(units_sold AS HUGEINT) * units_sold) OVER ({w12})
                       - sum(CAST(units_sold AS HUGEINT)) OVER ({w12}) * sum(CAST(units_sold AS HUGEINT)) OVER ({w12}) AS DOUBLE)
                  / NULLIF(CAST(count(units_sold) OVER ({w12}) * count(units_sold) OVER ({w12}) AS DOUBLE), 0)) AS roll_std_12w
      FROM demand_panel
      WINDOW w AS (PARTITION BY category ORDER BY week_start_date)"""
    c["forecast_standin"] = f"""
      SELECT category,
             CAST(date_trunc('week', (SELECT max(order_date) FROM fct_order_items)) AS DATE) + CAST(7 * week_ahead AS INTEGER)
               AS forecast_week,
             CAST(week_ahead AS BIGINT) AS week_ahead, predicted_units,
             CAST(NULL AS TIMESTAMP) AS generated_at, 'recent_mean_v1' AS model
      FROM (SELECT p.category, CAST(count(*) AS DOUBLE) / CAST(8 AS DOUBLE) AS predicted_units
            FROM fct_order_items f JOIN dim_products p ON f.product_id = p.product_id
            WHERE f.order_date > (SELECT max(order_date) FROM fct_order_items) - 56
            GROUP BY p.category)
      CROSS JOIN (SELECT unnest(generate_series(1, {p.horizon})) AS week_ahead)"""
    c["forecast_by_category"] = """
      SELECT category, CAST(sum(predicted_units) AS DOUBLE) / CAST(count(predicted_units) AS DOUBLE)
               AS predicted_units
      FROM forecast_standin GROUP BY category"""
    c["snap_products"] = """
      SELECT *, md5(CAST(product_id AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR)) AS scd_id
      FROM r_versions"""
    wexpr = "coalesce(fc.predicted_units * sh.share, 0.0)"
    c["mart_inventory_recommendations"] = f"""
      SELECT product_id, distribution_center_id, category, product_name, units_on_hand,
             inventory_cost_on_hand, cat_weekly_forecast, category_share,
             round(w * CAST(1000 AS DOUBLE)) / CAST(1000 AS DOUBLE) AS forecast_weekly_units,
             round(w * CAST({safety} AS DOUBLE) * CAST(10 AS DOUBLE)) / CAST(10 AS DOUBLE) AS safety_stock,
             round((w * CAST({lead} AS DOUBLE) + w * CAST({safety} AS DOUBLE)) * CAST(10 AS DOUBLE)) / CAST(10 AS DOUBLE) AS reorder_point,
             CAST(units_on_hand AS DOUBLE) / NULLIF(w, 0) AS weeks_of_cover,
             units_on_hand < w * CAST({lead} AS DOUBLE) + w * CAST({safety} AS DOUBLE) AS needs_reorder,
             greatest(CAST(ceil(w * CAST({target} AS DOUBLE) + w * CAST({safety} AS DOUBLE) - units_on_hand) AS BIGINT), 0) AS suggested_reorder_qty,
             w > 0 AND units_on_hand < w * CAST({lead} AS DOUBLE) AS is_stockout_risk,
             CASE WHEN w > 0 AND units_on_hand < w * CAST({lead} AS DOUBLE) THEN 'Stockout risk'
                  WHEN units_on_hand < w * CAST({lead} AS DOUBLE) + w * CAST({safety} AS DOUBLE) THEN 'Reorder'
                  WHEN w = 0 OR CAST(units_on_hand AS DOUBLE) / NULLIF(w, 0) > CAST({float(p.overstock_weeks_of_cover)} AS DOUBLE) THEN 'Overstock'
                  ELSE 'Healthy' END AS inventory_status
      FROM (SELECT i.product_id, i.distribution_center_id, p.category, p.product_name,
                   i.units_on_hand, i.inventory_cost_on_hand,
                   coalesce(fc.predicted_units, 0.0) AS cat_weekly_forecast,
                   coalesce(sh.share, 0.0) AS category_share,
                   {wexpr} AS w
            FROM inventory_latest i
            JOIN dim_products p ON i.product_id = p.product_id
            LEFT JOIN forecast_by_category fc ON p.category = fc.category
            LEFT JOIN (SELECT r.product_id, {ratio('r.units_12w', 't.cat_units')} AS share
                       FROM (SELECT p.category, f.product_id, count(*) AS units_12w
                             FROM fct_order_items f JOIN dim_products p ON f.product_id = p.product_id
                             WHERE f.order_date > (SELECT max(order_date) FROM fct_order_items) - 84
                             GROUP BY p.category, f.product_id) r
                       JOIN (SELECT category, sum(units_12w) AS cat_units
                             FROM (SELECT p.category, f.product_id, count(*) AS units_12w
                                   FROM fct_order_items f JOIN dim_products p ON f.product_id = p.product_id
                                   WHERE f.order_date > (SELECT max(order_date) FROM fct_order_items) - 84
                                   GROUP BY p.category, f.product_id)
                             GROUP BY category) t
                         ON r.category = t.category) sh
              ON i.product_id = sh.product_id)"""
    return {k: " ".join(v.split()) for k, v in c.items()}


_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def build(final_sql: str, p: Params = DEFAULT) -> str:
    """WITH <every CTE the final SELECT needs, dependencies first> <final>."""
    lib = ctes(p)
    order: list[str] = []
    seen: set[str] = set()

    def visit(sql: str):
        for name in _IDENT.findall(sql):
            if name in lib and name not in seen:
                seen.add(name)
                visit(lib[name])
                order.append(name)
    visit(final_sql)
    if not order:
        return final_sql
    return "WITH " + ", ".join(f"{n} AS ({lib[n]})" for n in order) + " " + " ".join(final_sql.split())
