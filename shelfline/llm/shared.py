"""Files that all machines of a cluster see, and size-checked broadcasts."""

from __future__ import annotations

import ctypes
import hashlib
import os
import re
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: rows of a batch sent to a Python worker: texts of a batch are held twice in
#: the executor (JVM buffer and worker), so a batch stays at a few MB
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: a side is broadcast up to this many (short) rows; beyond it, a plain join
BROADCAST_ROWS = 50_000


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.  Only where
    that is unset on a local master (tests) a local folder is made."""
    root = ensure_checkpoint_dir(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="run-"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (as ``--py-files`` would), once per
    application, so that it need not be installed on them."""
    sc = spark.sparkContext
    if getattr(sc, "_shelfline_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="run-"), "shelfline.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._shelfline_shipped = True


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers, which give freed memory
    back to the machine after each partition.  Lowers the session's batch size
    to BATCH_ROWS (a smaller setting is kept)."""
    spark = df.sparkSession
    ship(spark)
    if not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))

    def trimmed(batches):
        yield from run(batches)
        _give_back()

    return df.mapInArrow(trimmed, schema)


def _give_back() -> None:
    """Return freed memory to the system: an idle worker shares its machine
    with the executor's JVM."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder: survives lost executors."""
    shared = ensure_checkpoint_dir(df.sparkSession)
    if shared is None:
        shared_dir(df.sparkSession, "tables")
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast hint only if ``df`` (already cut) has few rows."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def _local(uri: str) -> str | None:
    m = re.match(r"(?:file:)(/.*)|(/.*)", uri)
    if not m:
        return None
    return re.sub(r"^/+", "/", m[1] or m[2])


def save(uri: str, array: np.ndarray) -> None:
    """Write ``array`` as .npy under a name that appears only when complete, so
    a repeated task attempt just replaces it by the same content."""
    path = _local(uri)
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        tmp = f"{path}.{uuid.uuid4().hex}"
        with open(tmp, "wb") as f:
            np.lib.format.write_array(f, np.ascontiguousarray(array), allow_pickle=False)
        os.replace(tmp, path)
        return
    from pyarrow import fs
    system, where = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(where), recursive=True)
    tmp = f"{where}.{uuid.uuid4().hex}"
    with system.open_output_stream(tmp) as f:
        np.lib.format.write_array(f, np.ascontiguousarray(array), allow_pickle=False)
    system.move(tmp, where)


def load(uri: str) -> np.ndarray:
    """Memory-map an array of the shared folder.  From a store without mounted
    files it is first copied, once per worker machine, to the task's own disk."""
    path = _local(uri)
    if not path:
        from pyarrow import fs
        path = os.path.join(tempfile.gettempdir(),
                            "npy-" + hashlib.sha256(uri.encode()).hexdigest()[:32])
        if not os.path.exists(path):
            system, where = fs.FileSystem.from_uri(uri)
            tmp = f"{path}.{uuid.uuid4().hex}"
            with system.open_input_stream(where) as src, open(tmp, "wb") as dst:
                while block := src.read(1 << 22):
                    dst.write(block)
            os.replace(tmp, path)
    try:
        return np.load(path, mmap_mode="r")
    except ValueError:  # an empty array can't be mapped
        return np.load(path)
