"""op13: Lyndon arrays, runs and the whole query against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from shelfline.llm import queries, runs


def _lyndon(s):
    return [max(n for n in range(1, len(s) - i + 1) if all(s[i:i + n] < s[i + k:i + n] for k in range(1, n)))
            for i in range(len(s))]


def _runs(s, min_length):
    """Every (start, length, period), straight from the definition."""
    out = []
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i < len(s) - p:
            j = i
            while j < len(s) - p and s[j] == s[j + p]:
                j += 1
            n = j - i + p
            if n >= max(min_length, 2 * p):
                w = s[i:j + p]
                if not any(w[q:] == w[:-q] for q in range(1, p)):
                    out.append((i, n, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _strings(count, seed):
    rnd = random.Random(seed)
    for _ in range(count):
        kinds, n = rnd.choice([1, 2, 2, 3, 5]), rnd.randint(0, 30)
        s = [rnd.randrange(kinds) for _ in range(n)]
        if n > 3 and rnd.random() < 0.5:
            a, p = rnd.randrange(n), rnd.randint(1, 8)
            s = [s[i] if i < a else s[min(n - 1, a + (i - a) % p)] for i in range(n)]
        yield s


def test_lyndon_arrays():
    for s in _strings(1500, 1):
        kinds = max(s, default=0) + 1
        assert runs.lyndon(s, kinds) == _lyndon(s), s
        assert runs.lyndon([kinds - 1 - x for x in s], kinds) == _lyndon([-x for x in s]), s


@pytest.mark.parametrize("min_length", [2, 3, 12])
def test_runs(min_length):
    for s in _strings(1500, min_length):
        assert runs.runs([b"%d" % x for x in s], min_length) == _runs(s, min_length), s


def test_runs_of_special_words():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    for s in (b, [0] * 500, list(range(300)) * 2, list(range(300)), ([0] * 9 + [1]) * 20, [i % 7 // 3 for i in range(200)]):
        assert runs.runs([b"%d" % x for x in s]) == _runs(s, 12)


def _expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = _runs(words, 12)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(kept)))


def test_query(spark, odd_docs, tmp_path):
    rnd = random.Random(4)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect() if r.text is None or len(r.text) < 10_000]
    for i in range(300):
        words = [rnd.choice("alpha beta Beta gamma été x".split()) for _ in range(rnd.randint(0, 120))]
        if i % 3 == 0:
            words = words[:40] * 3
        rows.append((1000 + i, rnd.choice([" ", "\n", " \t "]).join(words)))
    rows += [(rows[-1][0], rows[-1][1]), (-50, "no\x1fbreak  here " * 30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 as runs", "2 as start", "'c' as collapsed", "3 as longest")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                "collapsed_sha256")) for r in queries.op13_word_runs(spark, str(tmp_path)).collect()]
    want = [_expected(i, t) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 50


def test_operator_on_odd_rows(spark, odd_docs, no_docs):
    got = runs.find_runs(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r, d in zip(sorted(got, key=repr), sorted(odd_docs.collect(), key=repr)):
        assert r.n_words is not None and r.collapsed is not None
    long = [r for r in got if r.doc_id == 5][0]
    assert [tuple(x) for x in long.runs] == [(0, 60_000, 997)]
    assert long.collapsed == " ".join(f"word{i}" for i in range(997))
    assert runs.find_runs(no_docs).count() == 0


def test_long_text_of_one_word():
    words = [b"x"] * 200_000
    found = runs.runs(words)
    assert found == [(0, 200_000, 1)] and runs.collapse(words, found) == [b"x"]
    assert runs.covered(np.arange(100_000), 6) == []
