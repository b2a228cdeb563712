"""Session helpers: builder for local runs, lineage cutting, table landing."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", app: str = "shelfline",
                  shuffle_partitions: int = 8, checkpoint_dir: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests / bench.  On a cluster, use the cluster's own session."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # Spark 4.1: partitioning-aware unions can zip children that AQE
         # coalesced differently ("Can't zip RDDs with unequal numbers of partitions")
         .config("spark.sql.unionOutputPartitioning", "false")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def prepare(spark: SparkSession) -> None:
    """What the models need of a session that the caller brings: partitioning-
    aware unions off (see ``build_session``)."""
    if spark.conf.get("spark.sql.unionOutputPartitioning", "false") != "false":
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``; set ``fallback`` only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    target = conf or fallback
    if target:
        sc.setCheckpointDir(target)
        return sc.getCheckpointDir()
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage before a multi-pass step.

    With a shared checkpoint directory (the cluster's ``spark.checkpoint.dir``)
    this is a reliable checkpoint that survives executor loss.  Without one the
    frame is persisted to memory and disk; a lost block is then recomputed from
    lineage, which is still correct.
    """
    spark = df.sparkSession
    if ensure_checkpoint_dir(spark):
        return df.checkpoint(eager=True)
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def table_root(spark: SparkSession) -> str:
    """Where landed and model tables are written: under the cluster's shared
    checkpoint directory if set, else the session's warehouse directory.  On a
    cluster the latter must not be a machine's own folder."""
    ck = ensure_checkpoint_dir(spark)
    if ck:
        return ck.rstrip("/") + "/tables"
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if root.startswith(("/", "file:")) and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir or spark.sql.warehouse.dir to a folder that all machines share")
    return root


def land(df: DataFrame, path: str, sort_by=(), partition_by: str | None = None,
         rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as a parquet table and return the table scan (pushdown and
    column pruning keep working, unlike a checkpoint).

    The rows stay in the tasks that made them, so landing adds no shuffle:

    * ``sort_by``: every file is sorted, so the min/max statistics of its pages
      and row groups let range filters skip them;
    * ``partition_by``: directory partitions;
    * ``rows_per_file``: for rows that take next to no bytes.  A reader's task
      takes files up to so many bytes, a small file counting as 4 MB, so the
      bound on a file's rows is one on a task's rows.
    """
    cols = df.columns
    keys = ([partition_by] if partition_by else []) + list(sort_by)
    if keys:
        df = df.sortWithinPartitions(*keys)
    w = df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path).select(*cols)
