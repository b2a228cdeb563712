"""Exact deduplication by content-defined chunk recipes.

A text's UTF-8 bytes are cut where a rolling hash of the last 32 bytes has
CUT_BITS high zero bits (chunks of MIN_CHUNK to MAX_CHUNK bytes), so the cuts
depend on the content alone.  A chunk is named by a salted BLAKE2b digest, and
the names are verified: the distinct pairs (name, bytes) of all texts are
gathered with map-side combine, so a chunk's bytes travel at most once per map
task however many documents hold it, and no name may stand for two contents.
If one does, all chunks are named anew by longer digests under another salt.
A document then is its ordered list of verified names, 16 bytes per chunk of
about 2.5 KB, and only these lists are shuffled and compared: two texts are
equal exactly if their lists are.

Memory: a task holds one Arrow batch and, of a long text, arrays over 1 MB of
it at a time.  A hot chunk or a hot text is combined before the shuffle; the
groups are read from a written table, so both sides of the last join are plain
exchanges, which adaptive execution splits where a group is hot.

Defined cases: a null text equals the empty one (an empty list); texts that
differ in any byte differ (no normalisation); of equal texts the row with the
largest doc_id stays, a null doc_id only among null ones; of repeated rows of
one doc_id exactly one stays; extra columns are ignored; no rows give none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow, shared_dir
from .words import buffers

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 512, 16_384, 11
#: bytes of a name in the first attempt
NAME_BYTES = 16

_WINDOW = 32
_SEGMENT = 1 << 20
_GEAR = np.random.default_rng(81).integers(0, 1 << 32, 256, dtype=np.uint32)
_BATCH_BYTES = 4 << 20


def _rolling(raw: np.ndarray) -> np.ndarray:
    """At each byte the hash of the 32 bytes that end there: sums of the byte
    values' random words, shifted by age, over windows of doubling length."""
    h = _GEAR[raw]
    width = 1
    while width < _WINDOW:
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, 2 * width
    return h


def cuts(raw: np.ndarray) -> list[int]:
    """End offsets of the chunks of one text, ascending; the last is its length."""
    n = len(raw)
    if n <= MIN_CHUNK:
        return [n] if n else []
    # the high bits, which every byte of the window reaches, are tested
    found = []
    for at in range(0, n, _SEGMENT):
        lead = min(at, _WINDOW - 1)
        h = _rolling(raw[at - lead:at + _SEGMENT])[lead:]
        found.append(np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + at + 1)
    marks = np.concatenate(found)
    ends, start = [], 0
    while n - start > MIN_CHUNK:
        i = int(np.searchsorted(marks, start + MIN_CHUNK))
        end = int(marks[i]) if i < len(marks) else n
        start = min(end, start + MAX_CHUNK, n)
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def _pieces(raw: np.ndarray):
    data, start = raw.tobytes(), 0
    for end in cuts(raw):
        yield data[start:end]
        start = end


def _name(piece: bytes, width: int, salt: int) -> bytes:
    return hashlib.blake2b(piece, digest_size=width, salt=salt.to_bytes(8, "little")).digest()


def _texts(col: pa.Array):
    raw, offsets = buffers(col)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield raw[a:b]


def chunk_store(docs: DataFrame, text_col: str = "text", width: int = NAME_BYTES, salt: int = 0) -> DataFrame:
    """(name, content, copies): every distinct chunk of the texts once."""
    def run(batches):
        for batch in batches:
            names, contents, held = [], [], 0
            for raw in _texts(batch.column(0)):
                for piece in _pieces(raw):
                    names.append(_name(piece, width, salt))
                    contents.append(piece)
                    held += len(piece)
                    if held > _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(contents, pa.binary())],
                                                         names=["name", "content"])
                        names, contents, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(contents, pa.binary())],
                                             names=["name", "content"])

    pieces = map_arrow(docs.select(F.col(text_col).cast("string").alias("text")), run, "name binary, content binary")
    return pieces.groupBy("name", "content").agg(F.count("*").alias("copies"))


def verified(docs: DataFrame, text_col: str = "text", width: int = NAME_BYTES) -> tuple[int, int]:
    """(width, salt) of names under which no two contents of ``docs`` share one."""
    salt = 0
    while True:
        shared = (chunk_store(docs, text_col, width, salt).groupBy("name").agg(F.count("*").alias("contents"))
                  .filter("contents > 1"))
        if shared.isEmpty():
            return width, salt
        width, salt = min(2 * width, 64), salt + 1


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = NAME_BYTES,
            salt: int = 0) -> DataFrame:
    """(doc_id, recipe, text_sha256) of every row: the chunks' names in order,
    joined, and the digest of the whole text in lowercase hex."""
    def run(batches):
        for batch in batches:
            lists, digests = [], []
            for raw in _texts(batch.column(1)):
                whole, parts = hashlib.sha256(), []
                for piece in _pieces(raw):
                    whole.update(piece)
                    parts.append(_name(piece, width, salt))
                lists.append(b"".join(parts))
                digests.append(whole.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.binary()), pa.array(digests, pa.string())],
                                             names=["doc_id", "recipe", "text_sha256"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, recipe binary, text_sha256 string")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = NAME_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``."""
    spark = docs.sparkSession
    root = shared_dir(spark, "chunk_dedup")
    width, salt = verified(docs, text_col, width)
    recipes(docs, id_col, text_col, width, salt).withColumn("row", F.monotonically_increasing_id()).write.parquet(
        f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    # structs order by doc_id (null first), then by row: one row is the largest
    (rows.groupBy("recipe").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("top"))
     .filter("group_size > 1").write.parquet(f"{root}/groups"))
    groups = spark.read.parquet(f"{root}/groups")
    alone = F.col("group_size").isNull()
    return rows.join(groups, "recipe", "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("top.row"))).alias("kept"), "text_sha256")


#: DuckDB form of op12 over ``documents``
ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
