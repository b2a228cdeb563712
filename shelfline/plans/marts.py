"""Analytics marts (MOD10-MOD15) and the forecast stand-in table.

Join strategy: the calendar is bounded by its parameters and is broadcast;
every other join is left to AQE, which broadcasts a side only after measuring
it at runtime and splits skewed partitions of sort-merge joins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import stats as S
from ..operators import ranking
from ..session import materialize


def _calendar_months(dates: DataFrame) -> DataFrame:
    return F.broadcast(dates.select("date_day", "month_start_date"))


def mart_product_performance(fct_items: DataFrame, dates: DataFrame,
                             dim_products: DataFrame) -> DataFrame:
    """MOD10: product x month; JN22 (calendar), AGG17 (incl. distinct orders), JN23."""
    cal = _calendar_months(dates)
    j = fct_items.join(cal, fct_items.order_date == cal.date_day, "inner")
    agg = j.groupBy("product_id", "month_start_date").agg(
        F.count(F.lit(1)).alias("units_sold"),
        F.countDistinct("order_id").alias("n_orders"),
        F.sum("sale_price").alias("gross_revenue"),
        F.sum("cost").alias("total_cost"),
        F.sum("gross_margin_amount").alias("gross_margin_amount"))
    p = dim_products.select(F.col("product_id").alias("_pid"), "product_name", "category",
                            "brand", "department", "distribution_center_id")
    out = agg.join(p, agg.product_id == p._pid, "left")
    return out.select(
        "product_id", "product_name", "category", "brand", "department",
        "distribution_center_id", "month_start_date", "units_sold", "n_orders",
        "gross_revenue", "total_cost", "gross_margin_amount",
        X.ratio("gross_margin_amount", "gross_revenue").alias("gross_margin_pct"))


def mart_fulfillment_sla(fct_items: DataFrame, dates: DataFrame, dim_dcs: DataFrame) -> DataFrame:
    """MOD11: centre x month; each average skips its own nulls (AGG11, FN11)."""
    cal = _calendar_months(dates)
    j = fct_items.join(cal, fct_items.order_date == cal.date_day, "inner").select(
        "distribution_center_id", "month_start_date", "shipped_at", "delivered_at",
        X.whole_hours_between("shipped_at", "ordered_at").alias("h_ship"),
        X.whole_hours_between("delivered_at", "shipped_at").alias("h_deliver"),
        X.whole_hours_between("delivered_at", "ordered_at").alias("h_total"))
    agg = j.groupBy("distribution_center_id", "month_start_date").agg(
        F.count(F.lit(1)).alias("n_lines"),
        X.countif(F.col("shipped_at").isNotNull()).alias("n_shipped"),
        X.countif(F.col("delivered_at").isNotNull()).alias("n_delivered"),
        S.mean("h_ship").alias("avg_hours_to_ship"),
        S.mean("h_deliver").alias("avg_hours_to_deliver"),
        S.mean("h_total").alias("avg_hours_order_to_deliver"))
    c = dim_dcs.select(F.col("distribution_center_id").alias("_dc"), "distribution_center_name")
    out = agg.join(c, agg.distribution_center_id == c._dc, "left")
    return out.select(
        "distribution_center_id", "distribution_center_name", "month_start_date", "n_lines",
        "n_shipped", "n_delivered", "avg_hours_to_ship", "avg_hours_to_deliver",
        "avg_hours_order_to_deliver", X.ratio("n_delivered", "n_lines").alias("pct_delivered"))


# --- RFM -------------------------------------------------------------------

RFM_SEGMENTS = ("Champions", "Loyal", "New", "At Risk", "Hibernating", "Others")


def rfm_segment(r: Column, f: Column) -> Column:
    """FN5 ladder; first match wins."""
    return (F.when((r >= 4) & (f >= 4), "Champions")
             .when((r >= 3) & (f >= 3), "Loyal")
             .when((r >= 4) & (f <= 2), "New")
             .when((r <= 2) & (f >= 3), "At Risk")
             .when((r <= 2) & (f <= 2), "Hibernating")
             .otherwise("Others"))


def rfm_base(fct_orders: DataFrame) -> DataFrame:
    """AGG9 + AGG10: per customer over non-cancelled orders (order_id is the
    fact's key, so a plain count equals the distinct one); as-of = max order
    date over *all* orders (F2)."""
    as_of = fct_orders.select(F.max("order_date")).scalar()
    kept = fct_orders.filter(F.col("status") != "Cancelled")
    c = kept.groupBy(F.col("user_id").alias("customer_id")).agg(
        F.count("order_id").alias("frequency"),
        F.sum("gross_revenue").alias("monetary"),
        F.max("order_date").alias("last_order_date"))
    return c.select("customer_id", X.days_between(as_of, "last_order_date").alias("recency_days"),
                    "frequency", "monetary")


def _sort_keys(df: DataFrame, spec, prefix: str) -> tuple[DataFrame, list[str]]:
    """Encode (column, ascending, nulls_first) as non-null ascending key columns."""
    names = []
    for i, (c, asc, nulls_first) in enumerate(spec):
        flag = F.when(F.col(c).isNull(), 0 if nulls_first else 1).otherwise(1 if nulls_first else 0)
        val = F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
        if not asc:
            val = -val
        df = df.withColumn(f"{prefix}{i}f", flag).withColumn(f"{prefix}{i}v", val)
        names += [f"{prefix}{i}f", f"{prefix}{i}v"]
    return df, names


def scored_quintiles(base: DataFrame, key: str = "customer_id", k: int = 5,
                     **kw) -> DataFrame:
    """WIN3 + WIN4: r (recency desc), f (frequency asc), m (monetary asc, nulls
    first) as range-partitioned ntiles; the customer id breaks ties.

    The three rankings are chained on one frame (one shuffle each), so no
    join back on the customer key is needed."""
    base = materialize(base)
    n = base.count()
    specs = {
        "r_score": [("recency_days", False, False), (key, True, True)],
        "f_score": [("frequency", True, True), (key, True, True)],
        "m_score": [("monetary", True, True), (key, True, True)],
    }
    out = base
    for j, (name, spec) in enumerate(specs.items()):
        out, names = _sort_keys(out, spec, f"_k{j}_")
        # the input is a projection of a materialized frame: cheap to read again
        out = ranking.global_ntile(out, k, names, name, n=n, **kw).drop(*names)
    return out


def mart_customer_rfm(fct_orders: DataFrame, dim_customers: DataFrame, **kw) -> DataFrame:
    """MOD12."""
    s = scored_quintiles(rfm_base(fct_orders), **kw)
    c = dim_customers.select(F.col("customer_id").alias("_cid"), "first_name", "last_name",
                             "country", "traffic_source")
    j = s.join(c, s.customer_id == c._cid, "left")
    r, f, m = (F.col(c).cast("long") for c in ("r_score", "f_score", "m_score"))
    return j.select(
        "customer_id", "first_name", "last_name", "country", "traffic_source",
        F.col("recency_days").cast("long").alias("recency_days"), "frequency", "monetary",
        r.alias("r_score"), f.alias("f_score"), m.alias("m_score"),
        (r * 100 + f * 10 + m).alias("rfm_score"),
        (F.col("frequency") > 1).alias("is_repeat_customer"),
        rfm_segment(r, f).alias("segment"))


# --- inventory health / ABC -------------------------------------------------

def abc_classes(product_revenue: DataFrame, value: str = "revenue_12m", key: str = "product_id",
                a: float = 0.80, b: float = 0.95, **kw) -> DataFrame:
    """WIN9 + FN5: ABC class from the cumulative revenue share, revenue desc,
    RANGE frame (equal revenues share one cumulative value, F10).

    Distinct revenue values are aggregated first (partial aggregation, so a
    hot value costs nothing), their running total is a range-partitioned
    prefix sum, and the class is joined back on the value.
    """
    pv = product_revenue.filter(F.col(value).isNotNull())
    dv = pv.groupBy(value).agg(F.sum(value).alias("_s")).withColumn("_neg", -F.col(value))
    cum, _, total = ranking.global_prefix(dv, ["_neg"], "_cum", measure="_s", **kw)
    tot = F.lit(total)
    pct = F.try_divide(F.col("_cum").cast("double"), F.when(tot != 0, tot).cast("double"))
    cls = cum.select(F.col(value).alias("_v"),
                     F.when(pct <= a, "A").when(pct <= b, "B").otherwise("C").alias("abc_class"))
    j = product_revenue.join(cls, product_revenue[value] == cls["_v"], "left")
    return j.select(key, "abc_class")


def mart_inventory_health(inv_latest: DataFrame, fct_items: DataFrame, dim_products: DataFrame,
                          as_of: dt.date | Column | None = None, **kw) -> DataFrame:
    """MOD13: state at the latest snapshot day (FLT6-FLT8, AGG12-13, JN14-16)."""
    if as_of is None:
        as_of = inv_latest.select(F.max("snapshot_date")).scalar()
    asof = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    inv = inv_latest.filter(F.col("snapshot_date") == asof)
    s90 = (fct_items.filter(F.col("order_date") > F.date_sub(asof, 90))
           .groupBy(F.col("product_id").alias("_p"), F.col("distribution_center_id").alias("_d"))
           .agg(F.count(F.lit(1)).alias("_u90")))
    rev = (fct_items.filter(F.col("order_date") > F.date_sub(asof, 365))
           .groupBy("product_id").agg(F.sum("sale_price").alias("revenue_12m")))
    abc = abc_classes(rev, **kw).withColumnRenamed("product_id", "_ap")
    p = dim_products.select(F.col("product_id").alias("_pp"), "product_name", "category")
    j = (inv.join(p, inv.product_id == p._pp, "left")
            .join(s90, (inv.product_id == s90._p) & (inv.distribution_center_id == s90._d), "left")
            .join(abc, inv.product_id == abc._ap, "left"))
    u = F.coalesce(F.col("_u90"), F.lit(0))
    daily = F.try_divide(u.cast("double"), F.lit(90.0))
    return j.select(
        "product_id", "distribution_center_id", "product_name", "category", "units_on_hand",
        "inventory_cost_on_hand", u.alias("units_sold_90d"), daily.alias("avg_daily_units"),
        F.try_divide(F.col("units_on_hand").cast("double"), daily).alias("days_of_coverage"),
        F.try_divide(u.cast("double"), (u + F.col("units_on_hand")).cast("double"))
        .alias("sell_through_90d"),
        ((F.col("units_on_hand") > 0) & (u == 0)).alias("is_dead_stock"),
        F.coalesce(F.col("abc_class"), F.lit("C")).alias("abc_class"))


# --- demand features --------------------------------------------------------

def weekly_events(stg_events: DataFrame) -> DataFrame:
    """AGG8: events per Monday-week."""
    return stg_events.groupBy(X.week_start(X.to_day("created_at")).alias("week_start_date")).agg(
        F.count(F.lit(1)).alias("events_total"),
        X.countif(F.col("event_type") == "purchase").alias("events_purchase"),
        X.countif(F.col("event_type") == "cart").alias("events_cart"))


def mart_demand_features(fct_items: DataFrame, dim_products: DataFrame,
                         stg_events: DataFrame) -> DataFrame:
    """MOD14: dense zero-filled category x week panel with lags and rolling stats.

    The panel is generated per category with ``explode(sequence(first, last))``
    between the scalar week bounds: no cross join.  Windows are partitioned by
    category over at most one row per week.
    """
    lo = fct_items.select(F.min("order_date")).scalar()
    hi = fct_items.select(F.max("order_date")).scalar()
    cats = dim_products.filter(F.col("category").isNotNull()).select("category").distinct()
    spine = cats.select("category", F.explode(F.sequence(X.week_start(lo), X.week_start(hi),
                                                         F.expr("INTERVAL 7 DAYS")))
                        .alias("week_start_date"))
    p = dim_products.filter(F.col("category").isNotNull()).select(
        F.col("product_id").alias("_pid"), "category")
    # a product sells in few lines a week, so sums per (product, week) would be
    # nearly as many rows as the lines and two shuffles: three columns of every line
    # meet their product (a hot product is split by AQE), then few sums per category
    # and week are left
    sold = fct_items.select("product_id", "order_date", "sale_price")
    sales = (sold.join(p, sold.product_id == p._pid, "inner")
             .groupBy(F.col("category").alias("_c"), X.week_start("order_date").alias("_w"))
             .agg(F.count(F.lit(1)).alias("_units"), F.sum("sale_price").cast("decimal(32,2)").alias("_rev")))
    ev = weekly_events(stg_events).withColumnRenamed("week_start_date", "_ew")
    j = (spine.join(sales, (spine.category == sales._c) & (spine.week_start_date == sales._w), "left")
              .join(ev, spine.week_start_date == ev._ew, "left"))
    j = j.select(
        "category", "week_start_date",
        F.coalesce("_units", F.lit(0)).cast("long").alias("units_sold"),
        F.coalesce("_rev", F.lit(0).cast("decimal(22,2)")).alias("revenue"),
        F.coalesce("events_total", F.lit(0)).cast("long").alias("events_total"),
        F.coalesce("events_purchase", F.lit(0)).cast("long").alias("events_purchase"),
        F.coalesce("events_cart", F.lit(0)).cast("long").alias("events_cart"))
    w = Window.partitionBy("category").orderBy("week_start_date")
    u = F.col("units_sold")
    return j.select(
        "category", "week_start_date", "units_sold", "revenue", "events_total",
        "events_purchase", "events_cart",
        X.iso_week("week_start_date").cast("long").alias("week_of_year"),
        F.month("week_start_date").cast("long").alias("month_of_year"),
        F.year("week_start_date").cast("long").alias("year_number"),
        F.lag(u, 1).over(w).alias("lag_1w"), F.lag(u, 2).over(w).alias("lag_2w"),
        F.lag(u, 4).over(w).alias("lag_4w"), F.lag(u, 8).over(w).alias("lag_8w"),
        S.window_mean(u, w.rowsBetween(-4, -1)).alias("roll_mean_4w"),
        S.window_mean(u, w.rowsBetween(-12, -1)).alias("roll_mean_12w"),
        S.window_stddev_pop(u, w.rowsBetween(-12, -1)).alias("roll_std_12w"))


# --- forecast stand-in + recommendations ------------------------------------

def recent_mean_forecast(fct_items: DataFrame, dim_products: DataFrame, horizon: int = 8,
                         days: int = 56) -> DataFrame:
    """Deterministic forecast table: per category, lines in the last ``days``
    days divided by the number of weeks, repeated for ``horizon`` weeks.
    Same columns as the ML output (SNK11); feeds MOD15 when no model ran."""
    hi = fct_items.select(F.max("order_date")).scalar()
    p = dim_products.select(F.col("product_id").alias("_pid"), "category")
    per_product = (fct_items.filter(F.col("order_date") > F.date_sub(hi, days))
                   .groupBy("product_id").agg(F.count(F.lit(1)).alias("_pn")))
    recent = (per_product.join(p, per_product.product_id == p._pid, "inner")
              .groupBy("category").agg(F.sum("_pn").alias("_n")))
    weeks = days / 7.0
    return recent.select(
        "category",
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("week_ahead"),
        (F.col("_n").cast("double") / F.lit(weeks)).alias("predicted_units"),
    ).select("category",
             F.date_add(X.week_start(hi), F.col("week_ahead") * 7).alias("forecast_week"),
             F.col("week_ahead").cast("long").alias("week_ahead"), "predicted_units",
             F.lit(None).cast("timestamp_ntz").alias("generated_at"),
             F.lit("recent_mean_v1").alias("model"))


def mart_inventory_recommendations(inv_latest: DataFrame, forecast: DataFrame,
                                   fct_items: DataFrame, dim_products: DataFrame,
                                   lead: float = 2, safety: float = 1, target: float = 4,
                                   overstock_weeks: float = 26,
                                   as_of: dt.date | Column | None = None) -> DataFrame:
    """MOD15 / ML9: category forecast split by the product's 12-week share (F8)."""
    if as_of is None:
        as_of = inv_latest.select(F.max("snapshot_date")).scalar()
    asof = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    inv = inv_latest.filter(F.col("snapshot_date") == asof)
    cat_fc = forecast.groupBy(F.col("category").alias("_fc_cat")).agg(
        S.mean("predicted_units").alias("_cat_fc"))
    last_sale = fct_items.select(F.max("order_date")).scalar()
    p = dim_products.select(F.col("product_id").alias("_pid"), F.col("category").alias("_pcat"))
    per_product = (fct_items.filter(F.col("order_date") > F.date_sub(last_sale, 84))
                   .groupBy("product_id").agg(F.count(F.lit(1)).alias("units_12w")))
    recent = per_product.join(p, per_product.product_id == p._pid, "inner").select(
        F.col("_pcat").alias("_rc"), F.col("product_id").alias("_sp"), "units_12w")
    totals = recent.groupBy(F.col("_rc").alias("_tc")).agg(F.sum("units_12w").alias("_cat_units"))
    share = recent.join(totals, recent._rc == totals._tc, "inner").select(
        "_sp", X.ratio("units_12w", "_cat_units").alias("_share"))
    prod = dim_products.select(F.col("product_id").alias("_ip"), "category", "product_name")
    j = (inv.join(prod, inv.product_id == prod._ip, "inner")
            .join(cat_fc, F.col("category") == F.col("_fc_cat"), "left")
            .join(share, inv.product_id == share._sp, "left"))
    w = F.coalesce(F.col("_cat_fc") * F.col("_share"), F.lit(0.0))
    oh = F.col("units_on_hand")
    lead_need = w * F.lit(float(lead))
    reorder_at = w * F.lit(float(lead)) + w * F.lit(float(safety))
    cover = F.try_divide(oh.cast("double"), w)
    qty = F.ceil(w * F.lit(float(target)) + w * F.lit(float(safety)) - oh).cast("long")
    status = (F.when((w > 0) & (oh < lead_need), "Stockout risk")
               .when(oh < reorder_at, "Reorder")
               .when((w == 0) | (cover > F.lit(float(overstock_weeks))), "Overstock")
               .otherwise("Healthy"))
    return j.select(
        "product_id", "distribution_center_id", "category", "product_name", "units_on_hand",
        "inventory_cost_on_hand",
        F.coalesce(F.col("_cat_fc"), F.lit(0.0)).alias("cat_weekly_forecast"),
        F.coalesce(F.col("_share"), F.lit(0.0)).alias("category_share"),
        S.round_half_away(w, 3).alias("forecast_weekly_units"),
        S.round_half_away(w * F.lit(float(safety)), 1).alias("safety_stock"),
        S.round_half_away(reorder_at, 1).alias("reorder_point"),
        cover.alias("weeks_of_cover"),
        (oh < reorder_at).alias("needs_reorder"),
        F.greatest(qty, F.lit(0).cast("long")).alias("suggested_reorder_qty"),
        ((w > 0) & (oh < lead_need)).alias("is_stockout_risk"),
        status.alias("inventory_status"))
