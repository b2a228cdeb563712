"""Language identification with hyperdimensional profiles.

Every letter has a random +-1 vector, made from its code point.  An n-gram is
bound from its letters' vectors, permuted (rotated) by their position and
multiplied.  A text's profile bundles (sums) the n-grams of its lower-cased
letters, with each run of other characters as one gap; a language's prototype
bundles all texts of the language.  A text gets the language whose prototype
has the largest cosine with its profile (ties: the first name).

Learning sums integer vectors per language on Spark (addition commutes, so
reruns agree); only one prototype per language reaches the driver and the
workers: languages x dims x 8 bytes.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
with nothing learned every text is ``und``; repeated rows come out once each;
an empty table gives an empty result.  Scores are cosines, at least 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow
from .words import mix64

DIMS, ORDER = 1024, 3
UNKNOWN = "und"
_GAP = 0
#: texts profiled at once, n-grams whose vectors are kept by a worker
_GROUP, _KEPT = 64, 50_000

_letter: np.ndarray | None = None
_cache: dict = {}


def _is_letter() -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letter


def grams(text: str | None, order: int = ORDER) -> np.ndarray:
    """n-gram codes of a text (21 bits a letter), repeats included."""
    if not text:
        return np.zeros(0, np.uint64)
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    ok = _is_letter()[cp]
    if not ok.any():
        return np.zeros(0, np.uint64)
    keep = ok.copy()
    keep[1:] |= ok[:-1]  # of a run of other characters, the first stays, as a gap
    seq = np.concatenate([[_GAP], np.where(ok, cp, _GAP)[keep], [_GAP]]).astype(np.uint64)
    if seq[1] == _GAP:
        seq = seq[1:]
    if seq[-2] == _GAP:
        seq = seq[:-1]
    if len(seq) < order:
        seq = np.concatenate([seq, np.zeros(order - len(seq), np.uint64)])
    code = seq[:len(seq) - order + 1].copy()
    for i in range(1, order):
        code = (code << np.uint64(21)) | seq[i:len(seq) - order + 1 + i]
    return code


def vectors(codes: np.ndarray, dims: int = DIMS, order: int = ORDER) -> np.ndarray:
    """Bound n-gram vectors (int8 +-1), one row per code."""
    out = np.ones((len(codes), dims), np.int8)
    for i in range(order):
        cp = (codes >> np.uint64(21 * (order - 1 - i))) & np.uint64((1 << 21) - 1)
        known, inv = np.unique(cp, return_inverse=True)
        words = mix64(known[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, dims // 64 + 1, dtype=np.uint64))
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").astype(np.int8)
        letter = np.roll(2 * bits - 1, order - 1 - i, axis=1)
        out *= letter[inv]
    return out


def _known(codes: np.ndarray, dims: int, order: int) -> np.ndarray:
    """Vectors of sorted distinct codes, kept between calls up to a bound."""
    kept = _cache.get((dims, order))
    if kept is None or len(kept[0]) > _KEPT:
        kept = (np.zeros(0, np.uint64), np.zeros((0, dims), np.int8))
    at = np.searchsorted(kept[0], codes)
    new = codes[(at == len(kept[0])) | (kept[0][np.minimum(at, len(kept[0]) - 1)] != codes)] if len(kept[0]) else codes
    if len(new):
        every = np.concatenate([kept[0], new])
        sort = np.argsort(every)
        kept = (every[sort], np.concatenate([kept[1], vectors(new, dims, order)])[sort])
    _cache[dims, order] = kept
    return kept[1][np.searchsorted(kept[0], codes)].astype(np.float32)


def _bundle(texts: list, dims: int, order: int) -> np.ndarray:
    """Profiles of some texts, one row each (zeros: no letter)."""
    counted = [np.unique(grams(t, order), return_counts=True) for t in texts]
    codes = np.unique(np.concatenate([c for c, _ in counted]))
    out = np.zeros((len(texts), dims))
    for at in range(0, len(codes), 4096):  # bounded memory however many n-grams a text has
        part = codes[at:at + 4096]
        table = np.zeros((len(texts), len(part)), np.float32)
        for row, (c, n) in zip(table, counted):
            i, j = np.searchsorted(c, part[0]), np.searchsorted(c, part[-1], "right")
            row[np.searchsorted(part, c[i:j])] = n[i:j]
        out += table @ _known(part, dims, order)
    return out


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          dims: int = DIMS, order: int = ORDER) -> dict[str, np.ndarray]:
    """Prototype of each language of ``docs`` (rows of null language are left out)."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            texts = b.column(1)
            for lang in set(langs.tolist()):
                own = np.flatnonzero(langs == lang)
                codes, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                for at in range(0, len(own), _GROUP):
                    got = np.concatenate([codes] + [grams(texts[int(i)].as_py(), order) for i in own[at:at + _GROUP]])
                    codes, inv, add = np.unique(got, return_inverse=True, return_counts=True)
                    add = add.astype(np.int64)
                    if len(n):  # each code already held came once more
                        add[inv[:len(n)]] += n - 1
                    n = add
                acc = total.setdefault(lang, np.zeros(dims, np.int64))
                for at in range(0, len(codes), 4096):
                    acc += np.rint(n[at:at + 4096].astype(np.float64)
                                   @ _known(codes[at:at + 4096], dims, order)).astype(np.int64)
        for lang, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dims, pa.string()),
                                              pa.array(np.arange(dims, dtype=np.int32)), pa.array(v)],
                                             names=["lang", "i", "x"])

    parts = map_arrow(docs.filter(F.col(lang_col).isNotNull())
                      .select(F.col(lang_col).cast("string"), text_col), run, "lang string, i int, x bigint")
    rows = (parts.groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
            .select("lang", "v.x").collect())
    found = {r.lang: np.array(r.x, np.float64) for r in rows}
    return {k: v for k, v in found.items() if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text",
            dims: int = DIMS, order: int = ORDER) -> DataFrame:
    """``docs`` without its text, plus lang_pred and score (in place of columns of
    these names)."""
    names = sorted(prototypes)
    base = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names]).reshape(-1, dims)
    rest = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]

    def run(batches):
        for b in batches:
            langs, scores = [], []
            texts = b.column(b.num_columns - 1)
            for at in range(0, len(texts), _GROUP):
                profile = _bundle(texts.slice(at, _GROUP).to_pylist(), dims, order)
                size = np.linalg.norm(profile, axis=1)
                if not names:
                    langs += [UNKNOWN] * len(size)
                    scores += [0.0] * len(size)
                    continue
                cos = (profile @ base.T) / np.maximum(size, 1e-300)[:, None]
                best = cos.argmax(axis=1)
                top = np.clip(cos[np.arange(len(best)), best], 0.0, 1.0)
                langs += [names[i] if s else UNKNOWN for i, s in zip(best, size)]
                scores += np.where(size > 0, top, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*rest, "lang_pred", "score"])

    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")
    return map_arrow(docs.select(*rest, F.col(text_col).alias("__text")), run, schema)
