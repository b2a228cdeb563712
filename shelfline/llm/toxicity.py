"""Toxicity by a classifier chain.

Categories are predicted one after the other.  Each link is a sparse (L1)
logistic regression of Spark ML on features of the whole text (each lower-cased
run of letters and its first 4, 5 and 6 bytes, present or not; known by 64-bit
hashes) plus the probabilities of the earlier categories.  Of all features, the
``max_features`` with the largest chi-square per category take part.  While training, these
probabilities are out-of-fold: every row's come from a model that has not seen
the row.  For prediction the links are refitted on all training rows.

The labelled rows used for fitting are bounded by ``max_train_rows`` (a
documented parameter; taken by a hash of the id, whatever the table's size).
Prediction reads every row and the whole text; only the links' weights (bounded
by ``max_features``) go to the workers.

Defined cases: null or empty text has no feature; labels null, for ids that do
not exist or of repeated rows: null labels are left out, repeated ones count
each; a category without both classes among the labels predicts its share (0
without labels) for every text; repeated rows come out once each; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, map_arrow
from .words import LOWER, buffers, hashes, spans

CATEGORIES, THRESHOLD = ("quality", "toxic"), 0.15
PREFIXES, FOLDS, MAX_TRAIN_ROWS, MAX_FEATURES, MIN_ROWS = (4, 5, 6), 3, 12_000, 1024, 3
#: letters are ASCII letters and all bytes of other scripts
_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[97:123] = False
_NOT_LETTER[128:] = False


def features(col: pa.Array, known: np.ndarray | None = None):
    """(row, feature) of the distinct features of each text, by row.  Features
    are 64-bit hashes, or with ``known`` (sorted hashes) places in it."""
    raw, offsets = buffers(col)
    low = LOWER[raw]
    starts, ends, counts = spans(low, offsets, _NOT_LETTER)
    rows = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
    if known is not None:  # a first sieve by the top bits
        maybe = np.zeros(1 << 20, bool)
        maybe[(known >> np.uint64(44)).astype(np.int64)] = True
    out_r, out_h = [], []
    for i, h in enumerate(hashes(low, starts, ends, PREFIXES)):
        r = rows
        if i:  # whole words and each length of beginnings have hashes of their own
            longer = ends - starts > PREFIXES[i - 1]
            h, r = h[longer] * np.uint64(2 * i + 1), r[longer]
        if known is not None:
            ok = maybe[(h >> np.uint64(44)).astype(np.int64)]
            h, r = h[ok], r[ok]
            at = np.searchsorted(known, h)
            at[at == len(known)] = 0
            ok = known[at] == h if len(known) else np.zeros(len(h), bool)
            h, r = at[ok].astype(np.uint64), r[ok]
        out_r.append(r)
        out_h.append(h)
    r, h = np.concatenate(out_r), np.concatenate(out_h)
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[new], h[new]


def _pieces(col: pa.Array, size: int = 4 << 20):
    """Runs of rows of about ``size`` bytes of text, so that a worker's arrays
    of words stay small whatever the batch holds."""
    _, offsets = buffers(col)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to, col.slice(at, to - at)
        at = to


class Chain:
    """Fitted links: intercept and weights per category, earlier categories'
    probabilities last."""

    def __init__(self, categories, known: np.ndarray, links: list):
        self.categories, self.known, self.links = tuple(categories), known, links

    def predict(self, col: pa.Array) -> np.ndarray:
        """Probability of each category (columns) for each text."""
        size = len(self.known)
        rows, places = features(col, self.known)
        places = places.astype(np.int64)
        out = np.zeros((len(col), len(self.links)))
        for k, (intercept, w) in enumerate(self.links):
            z = intercept + np.bincount(rows, weights=w[places], minlength=len(col))
            z += out[:, :k] @ w[size:size + k]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
        return out


def training_rows(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, id_col: str = "doc_id",
                  text_col: str = "text", max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(id, text, y0, y1, ...) of at most about ``max_train_rows`` labelled rows."""
    known = labels.filter(" and ".join(f"{c} is not null" for c in (id_col, *categories)))
    n = known.count()
    share = min(1.0, max_train_rows / max(n, 1))
    known = known.filter(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("train")), F.lit(1_000_000))
                         < int(share * 1_000_000))
    y = [F.col(c).cast("double").alias(f"y{k}") for k, c in enumerate(categories)]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(known.select(F.col(id_col).alias("id"), *y)), "id")  # at most max_train_rows labels


def _selected(rows: DataFrame, n: int, max_features: int, min_rows: int) -> np.ndarray:
    """The features (sorted hashes) with the largest chi-square per category."""
    def run(batches):
        for b in batches:
            y = np.stack([c.to_numpy() for c in b.columns[1:1 + n]])
            for i, j, piece in _pieces(b.column(b.num_columns - 1)):
                r, h = features(piece)
                key, inv = np.unique(h, return_inverse=True)
                got = [np.bincount(inv, minlength=len(key)).astype(float),
                       *[np.bincount(inv, weights=y[k, i:j][r], minlength=len(key)) for k in range(n)]]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *map(pa.array, got)],
                                                 names=["h", "rows", *[f"y{k}" for k in range(n)]])

    y = [f"y{k}" for k in range(n)]
    total = rows.agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in y]).first()
    seen = cut(map_arrow(rows, run, "h bigint, rows double" + "".join(f", {c} double" for c in y))
               .groupBy("h").agg(F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in y])
               .filter(F.col("rows") >= min_rows))
    best: set = set()
    for c in y:
        ones = total[c] or 0.0
        if not 0 < ones < total["rows"]:
            continue
        share = ones / total["rows"]
        gap = F.col(c) - F.col("rows") * share
        chi = gap * gap / (F.col("rows") * share * (1 - share))
        best |= {r.h for r in seen.orderBy(chi.desc(), "h").limit(max_features).select("h").collect()}
    return np.sort(np.array(sorted(best), np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, id_col: str = "doc_id", text_col: str = "text",
        folds: int = FOLDS, max_train_rows: int = MAX_TRAIN_ROWS, max_features: int = MAX_FEATURES,
        min_rows: int = MIN_ROWS, reg: float = 5e-5, iterations: int = 25) -> Chain:
    """Learn a chain of one link per category (label columns, 0 or 1)."""
    n = len(categories)
    y = [f"y{k}" for k in range(n)]
    fold = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("fold")), F.lit(folds)).cast("int").alias("fold")
    rows = cut(training_rows(docs, labels, categories, id_col, text_col, max_train_rows).select(fold, *y, "text"))
    known = _selected(rows, n, max_features, min_rows)
    size = len(known)

    def run(batches):
        for b in batches:
            for i, j, piece in _pieces(b.column(b.num_columns - 1)):
                r, places = features(piece, known)
                at = np.searchsorted(r, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(i, j - i).columns[:-1],
                     pa.ListArray.from_arrays(pa.array(at), pa.array(places.astype(np.int32)))],
                    names=[*b.schema.names[:-1], "f"])

    found = map_arrow(rows, run, "fold int" + "".join(f", {c} double" for c in y) + ", f array<int>")
    total = size + n
    vector = F.udf(lambda f: SparseVector(total, f, [1.0] * len(f)), VectorUDT())
    # earlier categories' probabilities are set into the last places, link by link
    chained = F.udf(lambda v, at, p: SparseVector(total, [*v.indices, at], [*v.values, p]), VectorUDT())
    parts = max(2, max_train_rows // 6000)  # few, short tasks per step of the optimiser
    data = cut(found.repartition(parts).select("fold", *y, vector("f").alias("x")))
    links = []
    for k in range(n):
        seen = data.agg(F.count("*"), F.sum(f"y{k}")).first()
        rows_n, ones = seen[0], seen[1] or 0.0
        if not 0 < ones < rows_n:  # one class only: its share
            share = ones / rows_n if rows_n else 0.0
            logit = 700.0 if share == 1 else -700.0
            links.append((logit, np.zeros(total)))
            if k + 1 < n and rows_n:
                data = cut(data.withColumn("x", chained("x", F.lit(size + k), F.lit(float(share)))))
            continue
        one = LogisticRegression(featuresCol="x", labelCol=f"y{k}", regParam=reg, elasticNetParam=1.0,
                                 standardization=False, maxIter=iterations, aggregationDepth=2)
        model = one.fit(data)
        links.append((float(model.intercept), np.asarray(model.coefficients.toArray())))
        if k + 1 == n:
            break
        held = []
        for f in range(folds):
            rest, own = data.filter(F.col("fold") != f), data.filter(F.col("fold") == f)
            both = rest.agg(F.count("*"), F.sum(f"y{k}")).first()
            if both[0] and 0 < (both[1] or 0) < both[0]:
                p = one.fit(rest).transform(own).select(
                    "fold", *[f"y{i}" for i in range(n)], "x", F.element_at(_array("probability"), 2).alias("p"))
            else:
                p = own.withColumn("p", F.lit(float((both[1] or 0) / max(both[0], 1))))
            held.append(p)
        every = held[0]
        for p in held[1:]:
            every = every.unionByName(p)
        data = cut(every.withColumn("x", chained("x", F.lit(size + k), "p")).drop("p"))
    return Chain(categories, known, links)


def _array(col: str):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))


def classify(docs: DataFrame, chain: Chain, text_col: str = "text", keep_text: bool = True,
             prefix: str = "p_") -> DataFrame:
    """``docs`` plus a probability per category (``prefix`` + its name, in place
    of columns of these names)."""
    new = [prefix + c for c in chain.categories]
    docs = docs.drop(*new)
    rest = [c for c in docs.columns if keep_text or c != text_col]
    at = docs.sparkSession.sparkContext.broadcast(chain)
    sent = docs if keep_text else docs.select(*rest, text_col)  # the text goes to the workers once
    place = sent.columns.index(text_col)

    def run(batches):
        for b in batches:
            for i, j, piece in _pieces(b.column(place)):
                p = at.value.predict(piece)
                own = b.slice(i, j - i).columns[:len(rest)]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(p[:, k]) for k in range(len(new))]],
                                                 names=[*b.schema.names[:len(rest)], *new])

    schema = docs.select(*rest).schema
    for c in new:
        schema = schema.add(c, "double")
    return map_arrow(sent, run, schema)


def reject(docs: DataFrame, labels: DataFrame, category: str = "toxic", threshold: float = THRESHOLD, **fitting) -> DataFrame:
    """``docs`` without the documents whose probability of ``category`` reaches
    ``threshold``; the chain learns from those of ``docs`` that have labels."""
    chain = fit(docs, labels, **fitting)
    scored = classify(docs, chain, fitting.get("text_col", "text"), prefix="__p_")
    return scored.filter(F.col(f"__p_{category}") < threshold).select(*docs.columns)
