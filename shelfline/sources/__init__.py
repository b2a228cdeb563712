"""Sources (SRC1-SRC15): the raw retail tables as lazy DataFrames.

``Sources`` bundles the seven retail inputs plus the versioned product
history.  Build it from the driver's test tables (``from_driver_tables``) or
from retail-shaped parquet with declared schemas (``from_parquet``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare
from . import driver, schemas


@dataclass
class Sources:
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    users: DataFrame
    inventory_items: DataFrame
    distribution_centers: DataFrame
    events: DataFrame
    product_versions: DataFrame  # SCD2 history (snap_products)


def from_driver_tables(spark: SparkSession, sf_dir: str,
                       base_lines: DataFrame | None = None) -> Sources:
    """``base_lines``: an already landed ``driver.lines`` table to share."""
    prepare(spark)
    t = {n: driver.read(spark, sf_dir, n) for n in driver.DRIVER_TABLES}
    lines = base_lines if base_lines is not None else driver.lines(t["lineitem"], t["orders"])
    return Sources(
        orders=driver.orders(t["orders"]),
        order_items=driver.order_items(lines),
        products=driver.products(t["part"]),
        users=driver.users(t["customer"], t["nation"]),
        inventory_items=driver.inventory_items(lines, t["part"], t["supplier"], t["nation"]),
        distribution_centers=driver.distribution_centers(t["region"]),
        events=driver.events(t["events"]),
        product_versions=driver.product_versions(t["part"]),
    )


class LandedSources:
    """The role tables as the models see them.  Roles that need a shuffle or
    a join to derive (the windowed line base, the inventory units) are written
    once as parquet tables under the shared table root on first use; the
    single-scan projections stay lazy views over the driver tables."""

    FIELDS = ("orders", "order_items", "products", "users", "inventory_items",
              "distribution_centers", "events", "product_versions")

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        self._spark, self._sf_dir, self._root = spark, sf_dir, root
        self._lazy: Sources | None = None
        self._plain: Sources | None = None
        self._landed: dict[str, DataFrame] = {}

    def _sources(self) -> Sources:
        if self._lazy is None:
            from ..session import land
            # the two line-level roles share one windowed pass over lineitem,
            # written as it comes out of the window: no shuffle of its own
            t = {n: driver.read(self._spark, self._sf_dir, n) for n in ("lineitem", "orders")}
            base = land(driver.lines(t["lineitem"], t["orders"]), f"{self._root}/_lines")
            self._lazy = from_driver_tables(self._spark, self._sf_dir, base_lines=base)
        return self._lazy

    def __getattr__(self, name):
        if name.startswith("_") or name not in LandedSources.FIELDS:
            raise AttributeError(name)
        if name not in self._landed:
            from ..session import land
            if name == "order_items":
                # a projection of the landed line base: nothing to land again
                self._landed[name] = self._sources().order_items
            elif name == "inventory_items":
                # joins with part / supplier / nation: land once, as the joins leave
                # it; a join with the lines moves the columns it needs only
                self._landed[name] = land(self._sources().inventory_items, f"{self._root}/{name}")
            else:
                # single-scan projections (plus a tiny broadcast dimension):
                # cheaper to read again than to land; the line plan is never run
                if self._plain is None:
                    self._plain = from_driver_tables(self._spark, self._sf_dir)
                self._landed[name] = getattr(self._plain, name)
        return self._landed[name]


_LANDED: dict[tuple, LandedSources] = {}


def landed(spark: SparkSession, sf_dir: str) -> LandedSources:
    """One landed copy per session, directory and state of its files."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), driver.fingerprint(spark, sf_dir))
    if key not in _LANDED:
        import uuid
        from ..session import table_root
        root = f"{table_root(spark)}/shelfline_raw_{uuid.uuid4().hex[:12]}"
        _LANDED[key] = LandedSources(spark, sf_dir, root)
    return _LANDED[key]


def from_parquet(spark: SparkSession, root: str) -> Sources:
    """Retail-shaped parquet tables under ``root/<name>`` with declared schemas."""
    prepare(spark)
    def rd(name):
        return spark.read.schema(schemas.SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}")
    return Sources(
        orders=rd("orders"), order_items=rd("order_items"), products=rd("products"),
        users=rd("users"), inventory_items=rd("inventory_items"),
        distribution_centers=rd("distribution_centers"), events=rd("events"),
        product_versions=rd("snap_products"),
    )


def _newest_plan(spark: SparkSession, path: str, ts_col: str) -> DataFrame:
    """One row ``_top``: the maximum of a time column as it is stored, planned
    as an aggregate of the footers."""
    schema = spark.read.parquet(path).schema
    stored = T.StructType([T.StructField(f.name, T.LongType() if f.name == ts_col and f.dataType != T.DateType() else f.dataType)
                           for f in schema.fields])
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        top = spark.read.schema(stored).parquet(path).agg(F.max(ts_col).alias("_top"))
        top._jdf.queryExecution().executedPlan()  # planned while the settings hold
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return top


def newest(spark: SparkSession, path: str, ts_col: str) -> DataFrame:
    """SRC13: one row, ``max_loaded_at`` = the latest ``ts_col`` of the parquet
    table at ``path``, from the files' footers: the maximum is pushed into the
    scan, which reads no data page.

    Spark pushes maxima of whole numbers and dates, so a wall-clock timestamp is
    read as the microseconds it is stored as.  Spark finds a column's statistics
    by its place in the schema: files must agree in their columns' order, as
    those of one writer do.  Tables with nested columns or another type of time
    are read in the plain way."""
    schema = spark.read.parquet(path).schema
    nested = any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in schema.fields)
    if nested or not isinstance(schema[ts_col].dataType, (T.TimestampNTZType, T.DateType)):
        return spark.read.parquet(path).agg(F.max(ts_col).cast("timestamp_ntz").alias("max_loaded_at"))
    top = _newest_plan(spark, path, ts_col)
    # taken now (one row): planned again within another query it would read the pages
    row = spark.createDataFrame(top.collect(), top.schema)
    if isinstance(top.schema["_top"].dataType, T.DateType):
        return row.select(F.col("_top").cast("timestamp_ntz").alias("max_loaded_at"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return row.select(F.timestamp_add("MICROSECOND", F.col("_top"), epoch).alias("max_loaded_at"))


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: the published forecast table re-enters as a source (SNK11 output)."""
    from ..operators.versioned import VersionedTable
    return VersionedTable(spark, path).read(schema=schemas.SCHEMAS["ml_forecast_demand"])
