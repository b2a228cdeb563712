"""Interpolated modified Kneser-Ney language model (bigrams over whole words).

Counting, on Spark: tasks count the words of their texts, then (with the word
numbers known) the word pairs, and send sorted, pre-aggregated blocks to shards
by hash; a shard merges its blocks.  So one hot word or text is one entry per
task.  Contexts' statistics (followers seen once, twice, more often) and words'
continuation counts are summed in a second shuffle by word number.

Storage: each shard writes sorted arrays (word hashes; pair keys; counts) to the
shared folder.  Scoring tasks memory-map all of them and look up sorted distinct
keys, so a worker's own memory holds a batch of texts, not the model.

Model: p(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) p1(w), and p1(w) the same on
continuation counts, interpolated with the uniform 1 / (V + 1) (V words and the
unknown one).  D1, D2, D3+ come from the counts of counts.  Each text starts in
a begin context and ends with an end token.

Words are told apart by a 64-bit hash, pairs by exact word numbers (up to
2^32 - 2 distinct words).

Defined cases: null or empty text is the end token alone; no training rows give
p = 1 for the end token's place (V = 0); repeated rows count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import load, map_arrow, save, shared_dir
from .words import LOWER, buffers, hashes, mix64, pack, spans, unique_sum, unpack

END = np.uint64(0xE2D0E2D0E2D0E2D1)
#: bytes of training text behind one shard; bytes of text handled at once
SHARD_BYTES, PIECE_BYTES = 16 << 20, 8 << 20
#: distinct keys that a counting task holds before it sends them
PENDING = 4_000_000


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text closed by END; tokens per text."""
    raw, offsets = buffers(col)
    low = LOWER[raw]
    starts, ends, counts = spans(low, offsets)
    h = hashes(low, starts, ends)[0]
    out = np.empty(len(h) + len(counts), np.uint64)
    close = np.cumsum(counts + 1) - 1
    is_end = np.zeros(len(out), bool)
    is_end[close] = True
    out[is_end] = END
    out[~is_end] = h
    return out, counts + 1


def _pieces(col: pa.Array, size: int):
    """Runs of rows of about ``size`` bytes."""
    _, offsets = buffers(col)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to, col.slice(at, to - at)
        at = to


def _blocks(shard: np.ndarray, *arrays: np.ndarray) -> pa.RecordBatch:
    """One row per shard of the (sorted) arrays' entries."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    arrays = [a[order] for a in arrays]
    cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
    return pa.RecordBatch.from_arrays(
        [pa.array([int(shard[i]) for i in cuts[:-1]], pa.int32()),
         pa.array([pack(*_delta(*[a[i:j] for a in arrays])) for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())],
        names=["shard", "block"])


def _delta(first: np.ndarray, *rest: np.ndarray):
    return np.diff(first, prepend=first.dtype.type(0)), *rest


def _undelta(blob: bytes) -> list[np.ndarray]:
    first, *rest = unpack(blob)
    return [np.cumsum(first, dtype=first.dtype), *rest]


def _held(batches) -> dict[int, list]:
    """Blocks of each shard in a partition."""
    held: dict[int, list] = {}
    for b in batches:
        for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held.setdefault(s, []).append(blob)
    return held


class Lookup:
    """Sorted arrays of all shards, memory-mapped on first use by a worker."""

    def __init__(self, uri: str, width: int, key: str, present):
        self.uri, self.width, self.key = uri, width, key
        self.present, self.files = frozenset(present), {}

    def file(self, name: str, shard: int) -> np.ndarray:
        if (name, shard) not in self.files:
            if len(self.files) > 8192:  # maps that a process may hold
                self.files.clear()
            self.files[name, shard] = load(f"{self.uri}/{name}-{shard:06d}.npy")
        return self.files[name, shard]

    def find(self, keys: np.ndarray, shard: np.ndarray):
        """For keys, grouped by ascending shard and sorted within: found, the
        place in the shard, and the shards' runs."""
        found, place = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        runs = [(int(shard[i]), i, j) for i, j in zip(cuts[:-1], cuts[1:])]
        for s, i, j in runs:
            if s in self.present:
                have = self.file(self.key, s)
                at = np.searchsorted(have, keys[i:j])
                at[at == len(have)] = 0
                found[i:j] = have[at] == keys[i:j]
                place[i:j] = at
        return found, place, runs

    def get(self, name: str, found, place, runs, columns: tuple = ()) -> np.ndarray:
        out = np.zeros((len(found), *columns), np.int64)
        for s, i, j in runs:
            if s in self.present:
                out[i:j] = self.file(name, s)[place[i:j]]
        out[~found] = 0
        return out


def _word_shard(h: np.ndarray, width: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)).astype(np.int64)


def _pair_shard(key: np.ndarray, width: int) -> np.ndarray:
    return _word_shard(mix64(key), width)


class Words(Lookup):
    """Word numbers: the rank of the word's hash over all shards."""

    def __init__(self, uri: str, sizes: np.ndarray):
        super().__init__(uri, len(sizes), "word", np.flatnonzero(sizes).tolist())
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]])

    def numbers(self, h: np.ndarray):
        """For sorted distinct hashes: known, number, (found, place, runs)."""
        where = self.find(h, _word_shard(h, self.width))
        found, place, runs = where
        n = place.copy()
        for s, i, j in runs:
            n[i:j] += self.first[s]
        return found, n, where


def _discounts(n: list[int]) -> np.ndarray:
    """D0 (0), D1, D2, D3+ from the numbers of entries counted 1, 2, 3, 4 times."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not n1:
        return np.array([0.0, 0.0, 0.0, 0.0])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.array([min(max(x, 0.0), i) if i < 1 else min(max(x, 0.1), float(i)) for i, x in enumerate(d)])


class Model:
    """What the driver keeps of a model: sizes, discounts and where its arrays
    are (a few numbers per shard)."""

    def __init__(self, uri: str, sizes: np.ndarray, total: int):
        self.uri, self.sizes, self.total, self.vocabulary = uri, sizes, total, int(sizes.sum())
        self.pairs, self.d1, self.d2, self.present = 0, np.zeros(4), np.zeros(4), []
        self.kinds = np.zeros(4)  # words by continuation count: -, 1, 2, 3+


def fit(docs: DataFrame, text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Model:
    """Learn from every row of ``docs``."""
    spark = docs.sparkSession
    uri = shared_dir(spark, "lm")
    texts = docs.select(F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = max(16, -(-size // shard_bytes))

    def flush(parts, counts, split):
        keys, n = unique_sum(np.concatenate(parts), np.concatenate(counts))
        return _blocks(split(keys), keys, n.astype(np.uint64))

    def counted(batches, entries, split):
        parts, counts, held = [], [], 0
        for b in batches:
            for _, _, piece in _pieces(b.column(0), 2 * PIECE_BYTES):
                k, n = unique_sum(entries(piece))
                parts.append(k)
                counts.append(n)
                held += len(k)
                if held > PENDING:
                    yield flush(parts, counts, split)
                    parts, counts, held = [], [], 0
        if held:
            yield flush(parts, counts, split)

    def count_words(batches):
        yield from counted(batches, lambda col: tokens(col)[0], lambda k: _word_shard(k, width))

    def merge(blobs):
        got = [_undelta(x) for x in blobs]
        return unique_sum(np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got]))

    def store_words(batches):
        for s, blobs in _held(batches).items():
            keys, n = merge(blobs)
            save(f"{uri}/word-{s:06d}.npy", keys)
            save(f"{uri}/count-{s:06d}.npy", n)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([len(keys)], pa.int64()),
                                              pa.array([int(n.sum())], pa.int64())], names=["shard", "words", "total"])

    blocks = map_arrow(texts, count_words, "shard int, block binary")
    rows = map_arrow(blocks.repartitionById(width, "shard"), store_words,
                     "shard int, words bigint, total bigint").collect()
    sizes = np.zeros(width, np.int64)
    for r in rows:
        sizes[r.shard] = r.words
    model = Model(uri, sizes, sum(r.total for r in rows))
    vocabulary, ends = model.vocabulary, np.cumsum(sizes)
    first = ends - sizes
    if vocabulary >= (1 << 32) - 2:
        raise ValueError("more than 2^32 - 2 distinct words")
    if not vocabulary:
        return model

    def count_pairs(batches):
        words = Words(uri, sizes)

        def pairs(col):
            h, per = tokens(col)
            distinct, inv = np.unique(h, return_inverse=True)
            w = words.numbers(distinct)[1][inv].astype(np.uint64)
            v = np.empty_like(w)
            v[1:] = w[:-1]
            v[np.concatenate([[0], np.cumsum(per)[:-1]])] = vocabulary  # the begin context
            return (v << np.uint64(32)) | w

        yield from counted(batches, pairs, lambda k: _pair_shard(k, width))

    owner = lambda n: np.minimum(np.searchsorted(ends, n, "right"), width - 1)  # noqa: E731  word number -> shard

    def store_pairs(batches):
        for s, blobs in _held(batches).items():
            keys, n = merge(blobs)
            save(f"{uri}/pair-{s:06d}.npy", keys)
            save(f"{uri}/pair-count-{s:06d}.npy", n.astype(np.uint64))
            v, w = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
            entry = [np.concatenate([v, w])]  # per word: continuation, followers seen 1, 2, 3+ times
            for mask in (None, n == 1, n == 2, n > 2):
                a = np.zeros(len(v), np.uint32) if mask is None else mask.astype(np.uint32)
                b = np.ones(len(w), np.uint32) if mask is None else np.zeros(len(w), np.uint32)
                entry.append(np.concatenate([a, b]))
            order = np.argsort(entry[0], kind="stable")
            at = np.append(True, np.diff(entry[0][order]) != 0)
            at = np.flatnonzero(at)
            sums = [np.add.reduceat(x[order], at).astype(np.uint32) for x in entry[1:]]
            number = entry[0][order][at].astype(np.uint32)
            yield _blocks(owner(number), number, *sums)
            k = [int((n == i).sum()) for i in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array(
                [np.array([-1, s, len(keys), *k], "<i8").tobytes()], pa.binary())], names=["shard", "block"])

    def store_stats(batches):
        held = _held(batches)
        for s, blobs in held.items():
            tally, present = np.zeros(9, np.int64), []  # pairs, their n1..n4; n1..n4 of continuations
            low, size = int(first[s]), int(sizes[s]) + (s == width - 1)
            stats = np.zeros((size, 4), np.uint32)
            for blob in blobs:
                if np.frombuffer(blob, "<i8", 1)[0] == -1:  # a shard's tally
                    own = np.frombuffer(blob, "<i8")
                    tally[:5] += own[2:]
                    present.append(int(own[1]))
                    continue
                number, *sums = _undelta(blob)
                stats[number.astype(np.int64) - low] += np.stack(sums, axis=1)
            save(f"{uri}/stats-{s:06d}.npy", stats)
            tally[5:] = [int((stats[:, 0] == i).sum()) for i in (1, 2, 3, 4)]
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([tally.tolist()], many), pa.array([present], many)],
                                             names=["tally", "present"])

    pair_blocks = map_arrow(texts, count_pairs, "shard int, block binary")
    stat_blocks = map_arrow(pair_blocks.repartitionById(width, "shard"), store_pairs, "shard int, block binary")
    rows = map_arrow(stat_blocks.repartitionById(width, "shard"), store_stats,
                     "tally array<bigint>, present array<bigint>").collect()
    tally = np.sum([r.tally for r in rows], axis=0)
    model.present = sorted(s for r in rows for s in r.present)
    model.pairs, model.d2, model.d1 = int(tally[0]), _discounts(tally[1:5]), _discounts(tally[5:9])
    model.kinds = np.array([0, tally[5], tally[6], vocabulary - tally[5] - tally[6]], float)
    return model


class Scorer:
    """A model opened by a task."""

    def __init__(self, m: Model):
        self.m = m
        self.words = Words(m.uri, m.sizes)
        self.pairs = Lookup(m.uri, len(m.sizes), "pair", m.present)
        v = m.vocabulary
        self.base_floor = m.total + 0.5 * (v + 1)
        self.spare = float(m.d1 @ m.kinds) / m.pairs if m.pairs else 1.0
        if v:  # the begin context stands behind the last word
            self.begin = self.words.file("stats", len(m.sizes) - 1)[-1].astype(np.int64)

    def __call__(self, col: pa.Array):
        """Per text: tokens, known tokens, unigram log10, model log10."""
        m, v = self.m, self.m.vocabulary
        h, per = tokens(col)
        starts = np.cumsum(per) - per
        distinct, w = np.unique(h, return_inverse=True)
        known, number, where = self.words.numbers(distinct)
        count = self.words.get("count", *where)
        base = np.log10((count + 0.5) / self.base_floor)
        p1 = np.full(len(distinct), self.spare / (v + 1))
        total, reserve = np.zeros(len(distinct) + 1), np.ones(len(distinct) + 1)
        if v:
            stats = self.words.get("stats", *where, columns=(4,))
            cc = stats[:, 0]
            p1 += np.where(cc > 0, np.maximum(cc - m.d1[np.minimum(cc, 3)], 0), 0) / m.pairs
            total[:-1] = count
            end = self.words.numbers(np.array([END]))[2]
            total[-1] = self.words.get("count", *end)[0]  # as many texts begin as end
            stats = np.vstack([stats, self.begin])
            seen = total > 0
            reserve[seen] = (stats[seen, 1:] @ m.d2[1:]) / total[seen]
        before = np.empty_like(w)
        before[1:] = w[:-1]
        before[starts] = len(distinct)
        number = np.append(np.where(known, number, -1), v)
        p = reserve[before] * p1[w]
        both = np.flatnonzero((number[before] >= 0) & (number[w] >= 0))
        if v and len(both):
            key = (number[before[both]].astype(np.uint64) << np.uint64(32)) | number[w[both]].astype(np.uint64)
            keys, at = np.unique(key, return_inverse=True)
            shard = _pair_shard(keys, len(m.sizes))
            order = np.argsort(shard, kind="stable")
            c = np.zeros(len(keys), np.int64)
            c[order] = self.pairs.get("pair-count", *self.pairs.find(keys[order], shard[order]))
            c = c[at]
            p[both] += np.where(c > 0, np.maximum(c - m.d2[np.minimum(c, 3)], 0), 0) / np.maximum(total[before[both]], 1)
        add = lambda x: np.add.reduceat(x, starts)
        return per, add((count > 0)[w].astype(np.int64)), add(base[w]), add(np.log10(p))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus n_tokens, n_known, base_score and score."""
    rest = [c for c in docs.columns if c != text_col]
    new = ["n_tokens", "n_known", "base_score", "score"]

    def run(batches):
        scorer = Scorer(model)
        for b in batches:
            for i, j, piece in _pieces(b.column(b.num_columns - 1), PIECE_BYTES):
                got = scorer(piece)
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns[:-1], *map(pa.array, got)],
                                                 names=[*rest, *new])

    schema = docs.select(*rest).schema
    for c, kind in zip(new, ("long", "long", "double", "double")):
        schema = schema.add(c, kind)
    return map_arrow(docs.select(*rest, F.col(text_col).alias("__text")), run, schema)
