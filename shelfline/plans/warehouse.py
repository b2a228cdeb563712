"""The model graph: sources -> staging -> dims/facts -> marts.

``Warehouse`` wires the model functions together and builds each model at
most once.  The facts are the storage boundaries of the original project
(tables that several marts read); with ``materialize_facts=True`` they are
checkpointed to the cluster's checkpoint directory (or persisted) the first
time they are needed, so marts read them instead of re-deriving them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import sources as src
from ..params import DEFAULT, Params
from ..session import land, materialize
from ..sources import calendar
from . import core, forecast, marts, staging

#: balances take under a byte a row on disk: this bounds the rows of a task that reads them
SNAPSHOT_ROWS_PER_FILE = 250_000


class Warehouse:
    def __init__(self, sources: src.Sources, params: Params = DEFAULT,
                 materialize_facts: bool = True, forecast: DataFrame | None = None,
                 table_root: str | None = None):
        self.s = sources
        self.p = params
        self.materialize_facts = materialize_facts
        self._forecast = forecast
        self._root = table_root

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, params: Params = DEFAULT,
                           **kw) -> "Warehouse":
        return cls(src.from_driver_tables(spark, sf_dir), params, **kw)

    @property
    def spark(self) -> SparkSession:
        return self.s.orders.sparkSession

    def _fact(self, df: DataFrame, name: str | None = None, sort_by=(), rows_per_file: int = 0) -> DataFrame:
        """Facts are tables: with a table root they are written as parquet, every
        file sorted by ``sort_by``, and read back, so the marts' date filters skip
        pages and row groups.  The daily-partitioned incremental layout is
        ``operators.incremental``."""
        if not self.materialize_facts:
            return df
        if self._root and name:
            return land(df, f"{self._root}/{name}", sort_by, rows_per_file=rows_per_file)
        return materialize(df)

    # staging (views)
    @cached_property
    def stg_orders(self): return staging.stg_orders(self.s.orders)
    @cached_property
    def stg_order_items(self): return staging.stg_order_items(self.s.order_items)
    @cached_property
    def stg_products(self): return staging.stg_products(self.s.products)
    @cached_property
    def stg_users(self): return staging.stg_users(self.s.users)
    @cached_property
    def stg_inventory_items(self): return staging.stg_inventory_items(self.s.inventory_items)
    @cached_property
    def stg_distribution_centers(self):
        return staging.stg_distribution_centers(self.s.distribution_centers)
    @cached_property
    def stg_events(self): return staging.stg_events(self.s.events)

    # dims
    @cached_property
    def dim_dates(self):
        return calendar.dim_dates(self.spark, self.p.calendar_start, self.p.calendar_end)
    @cached_property
    def dim_products(self): return core.dim_products(self.stg_products)
    @cached_property
    def customer_orders(self): return core.customer_orders(self.stg_orders)
    @cached_property
    def dim_customers(self): return core.dim_customers(self.stg_users, self.customer_orders)
    @cached_property
    def dim_distribution_centers(self):
        return core.dim_distribution_centers(self.stg_distribution_centers)

    # facts
    @cached_property
    def order_items_enriched(self):
        return core.order_items_enriched(self.stg_order_items, self.stg_inventory_items,
                                         self.s.product_versions)
    @cached_property
    def fct_order_items(self):
        return self._fact(core.fct_order_items(self.order_items_enriched), "fct_order_items",
                          ("order_date", "order_item_id"))
    @cached_property
    def fct_orders(self):
        # the landed line fact holds exactly the enriched rows (full refresh),
        # so the order totals read it instead of re-deriving the enrichment
        lines = self.fct_order_items if self.materialize_facts else self.order_items_enriched
        return self._fact(core.fct_orders(self.stg_orders, lines), "fct_orders",
                          ("order_date", "order_id"))
    def fct_inventory_snapshot(self, window_start=None):
        """Default window: the landed table; another start: built lazily."""
        if window_start is None:
            return self._snapshot_table
        p = self.p
        return core.fct_inventory_snapshot(self.stg_inventory_items, window_start, p.as_of,
                                           p.calendar_start, p.calendar_end)

    @cached_property
    def _snapshot_table(self):
        p = self.p
        df = core.fct_inventory_snapshot(self.stg_inventory_items, p.window_start, p.as_of,
                                         p.calendar_start, p.calendar_end)
        # as the balances come: by pair, then day, so a pair's days stay together
        # (runs of equal values) and no row moves after the days are filled in
        return self._fact(df, "fct_inventory_snapshot", rows_per_file=SNAPSHOT_ROWS_PER_FILE)
    @cached_property
    def inventory_latest(self):
        p = self.p
        return core.inventory_latest(self.stg_inventory_items, p.window_start, p.as_of,
                                     p.calendar_start, p.calendar_end)
    @property
    def snapshot_as_of(self):
        return min(self.p.as_of, self.p.calendar_end)

    def tables(self) -> "LazyTables":
        """Model name -> DataFrame, built on first access (for the checks)."""
        return LazyTables(self)

    def rows_at_most(self, name: str) -> int:
        """A bound on a model's rows, counted on the stored table that sets it:
        no model is built only to be counted."""
        tables = self.tables()
        return tables[ROWS_FROM.get(name, name)].count()

    # marts
    def mart_product_performance(self):
        return marts.mart_product_performance(self.fct_order_items, self.dim_dates, self.dim_products)
    def mart_fulfillment_sla(self):
        return marts.mart_fulfillment_sla(self.fct_order_items, self.dim_dates,
                                          self.dim_distribution_centers)
    def mart_customer_rfm(self, **kw):
        return marts.mart_customer_rfm(self.fct_orders, self.dim_customers, **kw)
    def mart_inventory_health(self, **kw):
        return marts.mart_inventory_health(self.inventory_latest, self.fct_order_items,
                                           self.dim_products, as_of=self.snapshot_as_of, **kw)
    def mart_demand_features(self):
        return marts.mart_demand_features(self.fct_order_items, self.dim_products, self.stg_events)
    @property
    def forecast(self):
        """The published forecast table (SRC8): read back from where it was
        written; with no table root it is passed on as computed."""
        if self._forecast is None:
            computed = marts.recent_mean_forecast(self.fct_order_items, self.dim_products, self.p.horizon)
            self._forecast = self.published(computed) if self._root and self.materialize_facts else computed
        return self._forecast

    def published(self, computed: DataFrame, name: str = "ml_forecast_demand") -> DataFrame:
        """Publish a forecast (SNK11) and read it back by its declared schema."""
        forecast.write_forecast(computed, f"{self._root}/{name}")
        return src.read_forecast(self.spark, f"{self._root}/{name}")

    def mart_inventory_recommendations(self):
        p = self.p
        return marts.mart_inventory_recommendations(
            self.inventory_latest, self.forecast, self.fct_order_items, self.dim_products,
            p.lead_weeks, p.safety_weeks, p.target_weeks, p.overstock_weeks_of_cover,
            as_of=self.snapshot_as_of)


#: the table whose rows bound a model's that is not stored
ROWS_FROM = {"dim_products": "stg_products", "dim_customers": "stg_users",
             "dim_distribution_centers": "stg_distribution_centers",
             "mart_product_performance": "fct_order_items", "mart_fulfillment_sla": "fct_order_items",
             "mart_demand_features": "fct_order_items", "mart_customer_rfm": "stg_users",
             "mart_inventory_health": "stg_inventory_items", "mart_inventory_recommendations": "stg_inventory_items"}


class LazyTables(dict):
    NAMES = ("stg_orders", "stg_order_items", "stg_products", "stg_users", "stg_inventory_items",
             "stg_distribution_centers", "stg_events", "snap_products", "dim_dates",
             "dim_products", "dim_customers", "dim_distribution_centers", "fct_order_items",
             "fct_orders", "fct_inventory_snapshot", "mart_product_performance",
             "mart_fulfillment_sla", "mart_customer_rfm", "mart_inventory_health",
             "mart_demand_features", "mart_inventory_recommendations")

    def __init__(self, w: Warehouse):
        super().__init__()
        self.w = w

    def __missing__(self, name):
        w = self.w
        if name == "snap_products":
            v = w.s.product_versions
        elif name == "fct_inventory_snapshot":
            v = w.fct_inventory_snapshot()
        else:
            v = getattr(w, name)
            v = v() if callable(v) else v
        self[name] = v
        return v
