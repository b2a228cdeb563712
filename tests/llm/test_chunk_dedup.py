"""op12: against grouping by text, on odd rows, on weak names, and the round trip."""

import hashlib

import numpy as np
import pytest

from shelfline.llm import chunk_dedup


def _want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr), {t: max((x for x in ids if x is not None), default=None) for t, ids in groups.items()}


def _long_texts():
    rng = np.random.default_rng(5)
    base = " ".join(f"w{x}" for x in rng.integers(0, 5000, 40_000))
    return [base, base, base[:-1] + "x", "y" + base[1:], base + " ", "a" * 100_000, "a" * 99_999, "a" * 100_000]


def _check(got, rows):
    want, kept = _want(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == len(kept)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("width", [1, 16])
def test_exact_duplicates(spark, odd_docs, width):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(100 + i, t) for i, t in enumerate(_long_texts())] + [(None, "lone"), (None, "lone"), (7, "lone"), (-3, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    _check(chunk_dedup.exact_duplicates(df, width=width).collect(), rows)


def test_clashing_columns_and_no_rows(spark, odd_docs, no_docs):
    clash = odd_docs.selectExpr("*", "1 as recipe", "2 as `row`", "3 as top", "4 as keep_id", "5 as name", "6 as content")
    _check(chunk_dedup.exact_duplicates(clash).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert chunk_dedup.exact_duplicates(no_docs).count() == 0


def test_weak_names_are_replaced(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(600)], "doc_id bigint, text string")
    width, salt = chunk_dedup.verified(df, width=1)
    assert width > 1 and salt > 0
    names = chunk_dedup.chunk_store(df, width=width, salt=salt)
    assert names.count() == names.select("name").distinct().count() == 600


def test_recipes_rebuild_the_texts(spark):
    texts = _long_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    store = {bytes(r.name): bytes(r.content) for r in chunk_dedup.chunk_store(df).collect()}
    for r in chunk_dedup.recipes(df).collect():
        names = [bytes(r.recipe[i:i + 16]) for i in range(0, len(r.recipe), 16)]
        assert b"".join(store[n] for n in names).decode() == texts[r.doc_id]


def test_cuts_follow_the_content():
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 256, 3_000_000).astype(np.uint8)
    ends = chunk_dedup.cuts(raw)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(raw) and sizes.max() <= chunk_dedup.MAX_CHUNK and sizes[:-1].min() >= chunk_dedup.MIN_CHUNK
    moved = chunk_dedup.cuts(np.concatenate([raw[:1000], raw[990:]]))  # ten bytes more near the start
    assert len({e + 10 for e in ends} & set(moved)) > 0.95 * len(ends)
