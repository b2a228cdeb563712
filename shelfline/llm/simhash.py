"""SimHash near-duplicate detection by meet-in-the-middle ball hashing.

Fingerprints: A-Z lower-cased words, ``shingle_words``-word shingles (repeats
count; fewer words: the whole sequence; none: fingerprint 0), XXH64 with seed
42 of each shingle; a bit is 1 if set in over half the hashes.

Links: two fingerprints link at ``max_bits`` or fewer differing bits.  With
``t = max_bits // 2``, every distinct fingerprint emits all its variants of up
to t flipped bits, so any two at an even distance up to 2t meet in a variant.
For odd ``max_bits`` the ends of the largest distance have different parity,
so only the even ones also emit variants of t + 1 flips, and only flips inside
one 32-bit half: of 2t + 1 differing bits, t + 1 always lie in one half, and
the other end meets there with its t flips.  (Radius 3: 65 or 1057 variants
instead of 2081 for all.)  Variants are shuffled by their hash.  In a bucket,
every member within t flips links to every other member, so a star around one
of them keeps the connectivity: the edges are linear in the bucket, not all
pairs.  Each pair is verified by its bit distance.

Memory: equal fingerprints are grouped before anything is emitted, a bucket
holds at most one member per variant mask, and the number of shuffle shards
follows the number of distinct fingerprints.

Defined cases: null or empty text has fingerprint 0 and is linked like any
other; repeated rows come out once each; an empty table gives an empty result;
a null doc_id never becomes a component id unless its whole group has none.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import cut, map_arrow
from .words import LOWER_BYTES, mix64, pack, unpack

SEED = 42
#: variants that one shard holds, on average
SHARD_VARIANTS = 1_500_000
#: fingerprints expanded at once, and by one task
CHUNK, TASK_FINGERPRINTS = 2048, 16_384

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle_words: int) -> int:
    """Signed 64-bit SimHash of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if n <= shingle_words:
        return int.from_bytes(digest(joined, SEED), "big", signed=True)
    lengths = np.fromiter(map(len, words), np.int64, n)
    starts = np.zeros(n, np.int64)
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    ends = starts + lengths
    s, e = starts[:n - shingle_words + 1].tolist(), ends[shingle_words - 1:].tolist()
    raw = np.frombuffer(b"".join([digest(joined[i:j], SEED) for i, j in zip(s, e)]), np.uint8).reshape(-1, 8)
    if len(raw) < 64:
        ones = np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    else:  # count each byte value per byte position, then the bits of the values
        cells = raw + np.arange(0, 2048, 256, dtype=np.int64)
        ones = (np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, fp): the 64-bit fingerprint of every row's whole text."""
    def run(batches):
        for b in batches:
            fps = []
            for at in range(0, len(b), 256):
                fps += [fingerprint(t, shingle_words) for t in b.column(1).slice(at, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                     run, f"id {kind}, fp bigint")


def masks(max_bits: int) -> tuple[np.ndarray, int, int]:
    """(flip masks, number for odd fingerprints, number of flips t of a near
    variant): even fingerprints use all masks, odd ones the first."""
    t = max_bits // 2
    out = [sum(1 << i for i in c) for k in range(t + 1) for c in combinations(range(64), k)]
    near = len(out)
    if max_bits % 2:
        out += [sum(1 << (i + half) for i in c) for half in (0, 32) for c in combinations(range(32), t + 1)]
    return np.array(out, np.uint64), near, t


def similar_edges(fps: DataFrame, n: int, max_bits: int = 3) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp, ``n`` rows) that
    connect exactly what bit distances up to ``max_bits`` connect."""
    flip, near, _ = masks(max_bits)
    if len(flip) > 65535:
        raise ValueError("max_bits up to 4 is supported")
    width = max(16, -(-n * len(flip) // (2 * SHARD_VARIANTS)))

    def emit(batches):
        for b in batches:
            every = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), CHUNK):
                fp = every[at:at + CHUNK]
                odd = (np.bitwise_count(fp) & 1).astype(bool)
                src, mask = [], []
                for part, k in ((np.flatnonzero(~odd), len(flip)), (np.flatnonzero(odd), near)):
                    src.append(np.repeat(part.astype(np.uint16), k))
                    mask.append(np.tile(np.arange(k, dtype=np.uint16), len(part)))
                src, mask = np.concatenate(src), np.concatenate(mask)
                shard = ((mix64(fp[src] ^ flip[mask]) >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)
                shard = shard.astype(np.uint16 if width < 65536 else np.int64)
                order = np.argsort(shard, kind="stable")
                src, mask, shard = src[order], mask[order], shard[order]
                cuts = np.append(np.flatnonzero(np.diff(shard, prepend=shard[0] + 1)), len(shard))
                ids, blobs = [], []
                for i, j in zip(cuts[:-1], cuts[1:]):
                    used, place = np.unique(src[i:j], return_inverse=True)
                    ids.append(int(shard[i]))
                    blobs.append(pack(fp[used], place.astype(np.uint16), mask[i:j]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())],
                                                 names=["shard", "block"])

    def meet(batches):
        held: dict[int, list] = {}
        for b in batches:
            for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(s, []).append(unpack(blob))
        for shard in list(held):
            own, src, mask, n = [], [], [], 0
            for f, i, m in held.pop(shard):
                own.append(f)
                src.append(i + np.uint32(n))
                mask.append(m)
                n += len(f)
            own, src, mask = map(np.concatenate, (own, src, mask))
            variant = own[src] ^ flip[mask]
            order = np.argsort(variant)
            variant = variant[order]
            hit = np.zeros(len(variant), bool)
            hit[1:] = variant[1:] == variant[:-1]
            hit[:-1] |= hit[1:]
            rows, variant = order[hit], variant[hit]
            fp, is_near = own[src[rows]], mask[rows] < near
            del own, src, mask, order
            order = np.lexsort((fp, ~is_near, variant))  # a near member first, if there is one
            variant, fp, is_near = variant[order], fp[order], is_near[order]
            first = np.ones(len(variant), bool)
            first[1:] = variant[1:] != variant[:-1]
            head = np.maximum.accumulate(np.where(first, np.arange(len(variant)), 0))
            hub, ok = fp[head], is_near[head] & ~first
            ok &= np.bitwise_count(hub ^ fp) <= max_bits  # verify the pair
            if not ok.any():
                continue
            pairs = np.unique(np.stack([hub[ok].view(np.int64), fp[ok].view(np.int64)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

    dealt = fps.select("fp").repartition(-(-max(n, 1) // TASK_FINGERPRINTS), "fp")
    blocks = map_arrow(dealt, emit, "shard int, block binary")
    return map_arrow(blocks.repartitionById(width, "shard"), meet, "u bigint, v bigint")


def _grouped(docs: DataFrame, shingle_words: int, max_bits: int, id_col: str,
             text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row, and (fp, rep, root) of every distinct fingerprint:
    its smallest id and the fingerprint that names its group."""
    own = cut(fingerprints(docs, shingle_words, id_col, text_col))
    classes = cut(own.groupBy("fp").agg(F.min("id").alias("rep")))
    root = components(similar_edges(classes, classes.count(), max_bits))
    return own, (classes.join(root, classes.fp == root.node, "left")
                 .select("fp", "rep", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp, component_id) for every row of ``docs``; component_id is the
    smallest id reachable over links, the row's own included."""
    own, merged = _grouped(docs, shingle_words, max_bits, id_col, text_col)
    best = merged.groupBy("root").agg(F.min("rep").alias("component_id"))
    label = cut(merged.join(best, "root").select("fp", "component_id"))
    return own.join(label, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _with_fingerprint(docs: DataFrame, shingle_words: int, text_col: str) -> DataFrame:
    """``docs`` with the fingerprint of each row as ``__fp``."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            fps = []
            for i in range(0, len(b), 256):
                fps += [fingerprint(t, shingle_words) for t in b.column(at).slice(i, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps, pa.int64())], names=[*b.schema.names, "__fp"])

    return map_arrow(docs, run, docs.withColumn("__fp", F.lit(0).cast("long")).schema)


def keep_one(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one of the
    smallest id, a null id only where the group has no other (of a group's rows
    that share that id, the one of the smallest fingerprint, then the smallest by
    all columns as JSON, which columns of any type have)."""
    own, merged = _grouped(docs, shingle_words, max_bits, id_col, text_col)
    # per group, the smallest id and a fingerprint that holds it: an id alone may stand in several groups
    kept = (merged.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "fp")).alias("first"))
            .select(F.col("first.rep").alias("__keep"), F.col("first.fp").alias("__kept_fp")))
    rows = own.filter("id is not null").groupBy("id").agg(F.count("*").alias("__rows"))
    kept = cut(kept.join(rows, kept["__keep"] == rows["id"], "left").select("__keep", "__kept_fp", "__rows"))
    alone = kept.filter("__rows = 1").select("__keep")
    single = docs.join(alone, docs[id_col] == alone["__keep"]).select(*docs.columns)
    shared = kept.filter("__rows is null or __rows > 1")
    if shared.isEmpty():
        return single
    ids = shared.filter("__keep is not null").select(F.col("__keep").alias("__id")).distinct()
    some = (docs.join(ids, docs[id_col] == ids["__id"], "left_semi")
            .unionByName(docs.filter(F.col(id_col).isNull())))
    one = (_with_fingerprint(some, shingle_words, text_col)
           .groupBy(F.col(id_col).alias("__own"), "__fp")
           .agg(F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*docs.columns))).alias("__row")))
    one = one.join(shared, (F.col("__fp") == F.col("__kept_fp")) & F.col("__own").eqNullSafe(F.col("__keep")))
    return single.unionByName(one.select("__row.*"))
