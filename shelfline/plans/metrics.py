"""Semantic layer (MET1-MET8): measures, metrics and one query entry point.

``query(fct, ["revenue", "aov"], by=["status"], grain="month")`` compiles to a
single ``groupBy().agg()`` over the order-line fact (partial aggregation, one
shuffle), with ratio metrics computed after the aggregation.  Dimensions of
related entities (``product__category``) join the entity's dimension first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X

# measures of the order-line semantic model: name -> (aggregation, expression)
MEASURES = {
    "sale_price_total": ("sum", "sale_price"),
    "gross_margin_total": ("sum", "gross_margin_amount"),
    "orders_distinct": ("count_distinct", "order_id"),
    "order_items_count": ("count", "order_item_id"),
}


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str  # simple | ratio
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None


METRICS = {
    "revenue": Metric("revenue", "simple", measure="sale_price_total"),
    "gross_margin": Metric("gross_margin", "simple", measure="gross_margin_total"),
    "units_sold": Metric("units_sold", "simple", measure="order_items_count"),
    "orders": Metric("orders", "simple", measure="orders_distinct"),
    "aov": Metric("aov", "ratio", numerator="revenue", denominator="orders"),
}

# entity -> (foreign key on the fact, dimension name, dimension key)
ENTITIES = {
    "order_item": ("order_item_id", None, None),
    "order": ("order_id", None, None),
    "product": ("product_id", "dim_products", "product_id"),
    "customer": ("user_id", "dim_customers", "customer_id"),
    "distribution_center": ("distribution_center_id", "dim_distribution_centers",
                            "distribution_center_id"),
}

GRAINS = ("day", "week", "month", "quarter", "year")


def _measure_expr(name: str) -> Column:
    agg, e = MEASURES[name]
    if agg == "sum":
        return F.sum(e)
    if agg == "count":
        return F.count(e)
    if agg == "count_distinct":
        return F.countDistinct(e)
    raise ValueError(agg)


def _needed_measures(names) -> list[str]:
    out: list[str] = []
    for n in names:
        m = METRICS[n]
        deps = [m.measure] if m.kind == "simple" else _needed_measures([m.numerator, m.denominator])
        for d in deps:
            if d not in out:
                out.append(d)
    return out


def metric_time(grain: str) -> Column:
    if grain == "day":
        return F.col("order_date")
    return F.trunc("order_date", grain)


def query(fct: DataFrame, metrics, by=(), grain: str | None = "day", where: str | Column | None = None,
          dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """Metrics at the grain of ``metric_time`` (optional) and ``by`` dimensions.

    ``by`` entries are fact columns (``status``) or ``entity__column``
    (``product__category``), which join that entity's dimension.
    """
    df = fct
    group: list[Column] = []
    if grain is not None:
        if grain not in GRAINS:
            raise ValueError(grain)
        group.append(metric_time(grain).alias("metric_time"))
    for d in by:
        if "__" in d:
            ent, col = d.split("__", 1)
            fk, dim_name, dim_key = ENTITIES[ent]
            dim = (dims or {})[dim_name].select(F.col(dim_key).alias(f"_{ent}_key"),
                                                F.col(col).alias(d))
            df = df.join(dim, df[fk] == dim[f"_{ent}_key"], "left")
        group.append(F.col(d))
    if where is not None:
        df = df.filter(where if isinstance(where, Column) else F.expr(where))
    needed = _needed_measures(metrics)
    agg = df.groupBy(*group).agg(*[_measure_expr(m).alias(f"_m_{m}") for m in needed])
    out = [c for c in (["metric_time"] if grain is not None else []) + list(by)]
    cols = [F.col(c) for c in out]

    def value(name):
        m = METRICS[name]
        if m.kind == "simple":
            return F.col(f"_m_{m.measure}")
        return X.ratio(value(m.numerator), value(m.denominator))
    cols += [value(n).alias(n) for n in metrics]
    return agg.select(*cols)


def time_spine_fill(result: DataFrame, spine: DataFrame, metrics) -> DataFrame:
    """MET8: one row per spine day (day grain, no other dimensions); missing
    days show null metrics, as a left join to the spine does."""
    s = spine.select(F.col("date_day").alias("metric_time"))
    return s.join(result, "metric_time", "left").select("metric_time", *metrics)
