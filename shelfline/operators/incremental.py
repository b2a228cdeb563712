"""Incremental, date-partitioned fact tables (SNK3-SNK5, SNK8, SNK9, SNK13).

* ``lookback_cutoff``: ``max(partition) - lookback`` of the stored table, taken
  from the list of its partition folders (no file is read), or None when the
  table is absent or empty (then the run is a full load).  A folder that holds
  anything but such partitions is an error, never a reason to overwrite it;
* ``write_partitions``: dynamic partition overwrite, so only the dates present
  in the new result are replaced; files are range-partitioned on
  (date, cluster keys) and sorted, which keeps big dates split across tasks
  and gives tight parquet min/max statistics for the cluster keys;
* ``align_schema``: ``ignore`` / ``append_new_columns`` / ``sync_all_columns`` /
  ``fail``.  The table's schema is recorded beside it, in versions: a run that
  changes it adds one with the partitions it wrote.  ``read_table`` reads every
  partition by the version it was written under and gives it the table's present
  columns and types: files of before a change show new columns as null and
  changed types cast, and columns that the table no longer has don't show;
* ``build_incremental``: read the cutoff first (an action), then write; the
  output never overwrites the path it is computed from in the same plan.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for null


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def partition_values(spark: SparkSession, path: str, part_col: str) -> list[str] | None:
    """Values of the stored partitions; None where nothing is stored at ``path``."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    names = [n for n in names if not n.startswith(("_", "."))]
    strange = [n for n in names if not n.startswith(f"{part_col}=")]
    if strange:
        raise ValueError(f"{path} is not a table partitioned by {part_col}: it holds {strange[:3]}")
    return [n.split("=", 1)[1] for n in names]


def _schema_path(path: str) -> str:
    return f"{path.rstrip('/')}.schema"


def schema_versions(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str] | None]]:
    """(schema, partitions written under it), oldest first; the first version
    holds all partitions that no later one names (None)."""
    fs, folder = _folder(spark, _schema_path(path))
    if not fs.exists(folder):
        return [(spark.read.option("mergeSchema", "true").parquet(path).schema, None)]
    versions = [json.loads(r[0]) for r in spark.read.text(_schema_path(path)).collect()]  # a line per schema change
    versions.sort(key=lambda v: v["version"])
    return [(T.StructType.fromJson(v["schema"]), v["partitions"]) for v in versions]


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """The present schema; of a table without a record, the merged schema of its files."""
    return schema_versions(spark, path)[-1][0]


def record_schema(spark: SparkSession, path: str, schema: T.StructType,
                  written: Callable[[], list[str]] | None = None) -> None:
    """Record the schema of a run that wrote the partitions ``written()``, which
    is only asked where the table has or gets several versions; None for a run
    that replaced all partitions."""
    fs, folder = _folder(spark, _schema_path(path))
    versions = schema_versions(spark, path) if written is not None and fs.exists(folder) else []
    if not versions:
        versions = [(schema, None)]
    elif len(versions) > 1 or versions[0][0] != schema:
        mine = sorted(written())
        versions = [(s, p if p is None else [x for x in p if x not in set(mine)]) for s, p in versions]
        if versions[-1][0] == schema and versions[-1][1] is not None:
            versions[-1] = (schema, sorted({*versions[-1][1], *mine}))
        else:
            versions.append((schema, mine))
    lines = [json.dumps({"version": i, "schema": json.loads(s.json()), "partitions": p}) for i, (s, p) in enumerate(versions)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(_schema_path(path))


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``; a column it lacks is null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def read_table(spark: SparkSession, path: str, part_col: str | None = None) -> DataFrame:
    """The stored table in its present columns and types.  A table with several
    schema versions is read in as many scans, each of its own partitions."""
    versions = schema_versions(spark, path)
    now = versions[-1][0]
    if len(versions) == 1:
        return spark.read.schema(now).parquet(path).select(*now.fieldNames())
    part_col = part_col or _partition_column(spark, path)
    later = [x for _, p in versions[1:] for x in p]
    out = None
    for schema, parts in versions:
        if parts == []:
            continue
        df = spark.read.schema(schema).parquet(path)
        if parts is None:
            df = df.filter(F.col(part_col).isNull() | ~_among(schema, part_col, later))
        else:
            df = df.filter(_among(schema, part_col, parts))
        out = _as(df, now) if out is None else out.unionByName(_as(df, now))
    return out


def _partition_column(spark: SparkSession, path: str) -> str:
    fs, folder = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return next(n.split("=", 1)[0] for n in names if "=" in n)


def _among(schema: T.StructType, part_col: str, values: list[str]):
    """The partition is one of ``values``: literals, so folders are skipped."""
    kind = schema[part_col].dataType
    named = [F.lit(v).cast(kind) for v in values if v != NULL_PARTITION]
    return F.coalesce(F.col(part_col).isin(named), F.lit(False)) | (
        F.col(part_col).isNull() if NULL_PARTITION in values else F.lit(False))


def _cutoff(values: list[str] | None, lookback_days: int) -> dt.date | None:
    days = [dt.date.fromisoformat(v) for v in values or [] if v != NULL_PARTITION]
    return max(days) - dt.timedelta(days=lookback_days) if days else None


def lookback_cutoff(spark: SparkSession, path: str, part_col: str, lookback_days: int) -> dt.date | None:
    """SNK5: partition values only; an absent or empty table means full load."""
    return _cutoff(partition_values(spark, path, part_col), lookback_days)


#: a type and the wider ones that hold all of its values
_WIDER = {"tinyint": ("smallint", "int", "bigint"), "smallint": ("int", "bigint"), "int": ("bigint", "double"),
          "float": ("double",), "date": ("timestamp_ntz",)}


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds the other's values, if any does."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        for x, y in ((a, b), (b, a)):
            if x.scale >= y.scale and x.precision - x.scale >= y.precision - y.scale:
                return x
    if b.simpleString() in _WIDER.get(a.simpleString(), ()):
        return b
    return a if a.simpleString() in _WIDER.get(b.simpleString(), ()) else None


def align_schema(df: DataFrame, stored: T.StructType | None, mode: str) -> DataFrame:
    """SNK9: the new result in the columns the table has after this run.

    ``ignore`` keeps the stored columns and types (a missing one is an error),
    ``append_new_columns`` adds new ones (a missing one is null) and takes the
    wider one of two types, ``sync_all_columns`` takes the new result's columns
    and types, ``fail`` allows no change.
    """
    if mode not in ("ignore", "append_new_columns", "sync_all_columns", "fail"):
        raise ValueError(mode)
    if stored is None or mode == "sync_all_columns":
        return df
    added = [c for c in df.columns if c not in stored.fieldNames()]
    gone = [f.name for f in stored.fields if f.name not in df.columns]
    changed = [f.name for f in stored.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    if (mode == "fail" and (added or gone or changed)) or (mode == "ignore" and gone):
        raise ValueError(f"schema changed: added {added}, removed {gone}, of another type {changed}")
    if mode == "ignore":
        return _as(df, stored)
    if mode == "append_new_columns":
        types = {f.name: f.dataType for f in stored.fields}
        for name in changed:
            types[name] = _wider(types[name], df.schema[name].dataType)
            if types[name] is None:
                raise ValueError(f"{name}: neither {stored[name].dataType} nor {df.schema[name].dataType} holds the other")
        types |= {c: df.schema[c].dataType for c in added}
        return _as(df, T.StructType([T.StructField(n, t) for n, t in types.items()]))
    return df


def write_partitions(df: DataFrame, path: str, part_col: str, cluster_cols=(),
                     overwrite_all: bool = False, max_records_per_file: int = 5_000_000) -> None:
    """SNK4 + SNK8: replace the partitions present in ``df`` (or all of them)."""
    laid = df.repartitionByRange(F.col(part_col), *[F.col(c) for c in cluster_cols]) \
        .sortWithinPartitions(part_col, *cluster_cols)
    (laid.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if overwrite_all else "dynamic")
        .option("maxRecordsPerFile", max_records_per_file).option("compression", "zstd")
        .partitionBy(part_col).parquet(path))


def build_incremental(spark: SparkSession, build: Callable[[dt.date | None], DataFrame], path: str,
                      part_col: str, lookback_days: int = 3, cluster_cols=(),
                      on_schema_change: str = "ignore", full_refresh: bool = False) -> dt.date | None:
    """One run of an incremental model; returns the cutoff used (None = full)."""
    values = partition_values(spark, path, part_col)
    cutoff = None if full_refresh else _cutoff(values, lookback_days)
    stored = table_schema(spark, path) if cutoff is not None else None
    df = align_schema(build(cutoff), stored, on_schema_change)
    write_partitions(df, path, part_col, cluster_cols, overwrite_all=cutoff is None)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])

    def written() -> list[str]:  # a value per partition, asked only around a schema change
        return [NULL_PARTITION if r[0] is None else r[0]
                for r in df.select(F.col(part_col).cast("string")).distinct().collect()]
    record_schema(spark, path, schema, None if cutoff is None else written)
    return cutoff
