"""Runs (maximal periodic stretches) of the words of each text.

A run is a stretch of consecutive words with smallest period q and at least
``min_length`` and 2 q words that no neighbouring word extends.  By the runs
theorem every run holds a Lyndon word of length q that is the longest Lyndon
word at its start under one of two inverse orders of the words.  So:

* ``lyndon`` is the first phase of Baier's suffix sorter.  It starts from
  groups of positions with equal words and takes the groups from the highest
  down.  Each position of a group appends its word to the nearest position on
  the left that is not done; positions of one group that got the same number of
  words go to a new group right above their old one.  A group's word is final
  when its turn comes, and its length is the Lyndon array.  No suffix is sorted.
  It is called for the order of the words and for its inverse.
* Each root (i, i + q) is extended by longest common extensions to both sides
  (exact comparisons of doubling, then halving length).  At least 2 q words
  make a run.  Roots inside a run already found for their period are skipped.

Before that, words that can be in no run are left out, exactly: a run of length
L repeats its first L - q >= min_length / 2 words at distance q, and these
repeats cover it whole.  So every run lies inside a stretch covered by m-grams
(m = min_length / 2) that occur twice in the text; only such stretches are
grouped.  m-grams are compared by 64-bit sums: an accidental match only makes a
stretch longer.

Memory: one text at a time, about 300 bytes per word of its longest stretch.
No shuffle: documents are independent, so a hot source or copies add nothing.

Defined cases: a null text has no words; words are compared byte by byte, case
included; texts of any length are searched whole; runs are ordered by start,
then period; repeated rows and null ids give a row each; extra columns are
ignored; no rows give none.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow
from .words import buffers, mix64

MIN_LENGTH = 12

_OUT_BYTES = 4 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon(ranks: list[int], kinds: int) -> list[int]:
    """Length of the longest Lyndon word at each position; ranks in 0..kinds-1."""
    n = len(ranks)
    length, group = [1] * n, list(ranks)
    # positions not done yet, linked; slot n (also reached as -1) is the border
    left, right = list(range(-1, n)), list(range(1, n + 2))
    members: list = [[] for _ in range(kinds)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    size = [len(m) for m in members]
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))

    def put_above(old: int, moving: list[int]) -> int:
        """A new group right above ``old``, which lies below the group in turn."""
        new, top = len(size), above[old]
        for p in moving:
            group[p] = new
        members.append(moving)
        size.append(len(moving))
        below.append(old)
        above.append(top)
        above[old] = below[top] = new
        return new

    g = kinds - 1
    while g >= 0:
        extended, last, times, unit = [], -1, 0, 0
        for i in members[g]:
            if group[i] != g:  # it moved to a higher group
                continue
            unit = length[i]
            p, q = left[i], right[i]
            right[p], left[q] = q, p
            if p == last:
                times += 1
            else:
                if last >= 0:
                    extended.append((last, times))
                last, times = p, 1
        if last >= 0:
            extended.append((last, times))
        members[g] = None
        if len(extended) == 1:
            p, times = extended[0]
            length[p] += times * unit
            old = group[p]
            if size[old] > 1:
                size[old] -= 1
                put_above(old, [p])
        elif extended:
            moved: dict[int, dict[int, list[int]]] = {}
            for p, times in extended:
                length[p] += times * unit
                moved.setdefault(group[p], {}).setdefault(times, []).append(p)
            for old, classes in moved.items():
                order = sorted(classes)
                stay = size[old] - sum(map(len, classes.values()))
                if not stay:  # all leave: the lowest class takes the group's place
                    members[old] = classes[order.pop(0)]
                    stay = len(members[old])
                size[old] = stay
                under = old
                for times in order:
                    under = put_above(under, classes[times])
        g = below[g]
    return length


def _equal_right(buf: bytes, width: int, a: int, b: int, n: int) -> int:
    """Common items of the sequences from a and from b > a on."""
    limit, k, step = n - b, 0, 8
    while k + step <= limit and buf[(a + k) * width:(a + k + step) * width] == buf[(b + k) * width:(b + k + step) * width]:
        k += step
        step *= 2
    while step := step // 2:
        if k + step <= limit and buf[(a + k) * width:(a + k + step) * width] == buf[(b + k) * width:(b + k + step) * width]:
            k += step
    return k


def _equal_left(buf: bytes, width: int, a: int, b: int) -> int:
    """Common items of the sequences that end before a and before b > a."""
    limit, k, step = a, 0, 8
    while k + step <= limit and buf[(a - k - step) * width:(a - k) * width] == buf[(b - k - step) * width:(b - k) * width]:
        k += step
        step *= 2
    while step := step // 2:
        if k + step <= limit and buf[(a - k - step) * width:(a - k) * width] == buf[(b - k - step) * width:(b - k) * width]:
            k += step
    return k


def runs_of(items: np.ndarray, min_length: int = MIN_LENGTH) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``min_length`` items."""
    kinds, ranks = np.unique(items, return_inverse=True)
    ranks = ranks.astype(np.int32)
    n, width, buf = len(ranks), 4, ranks.tobytes()
    found: set[tuple[int, int, int]] = set()
    at = np.arange(n)
    for order in (ranks, len(kinds) - 1 - ranks):
        period = np.array(lyndon(order.tolist(), len(kinds)))
        ok = at + period < n
        i, p = at[ok], period[ok]
        near = ranks[i] == ranks[i + p]
        near |= (i > 0) & (ranks[i - 1] == ranks[i + p - 1])
        last: dict[int, int] = {}
        for i, p in zip(i[near].tolist(), p[near].tolist()):
            if i + p <= last.get(p, 0):
                continue
            end = i + p + _equal_right(buf, width, i, i + p, n)
            start = i - _equal_left(buf, width, i, i + p)
            if end - start >= 2 * p:
                last[p] = end
                if end - start >= min_length:
                    found.add((start, end - start, p))
    return found


def covered(items: np.ndarray, m: int) -> list[tuple[int, int]]:
    """Maximal stretches of items covered by m-grams that occur twice."""
    n = len(items)
    if n <= m:
        return []
    mixed = mix64(items.astype(np.uint64) + np.uint64(1))
    gram = np.zeros(n - m + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(m):
            gram *= np.uint64(0x9E3779B97F4A7C15)
            gram += mixed[j:n - m + 1 + j]
    ranked = np.sort(gram)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(gram, twice))
    new = np.flatnonzero(np.diff(at) > m) + 1
    return list(zip(at[np.append(0, new)].tolist(), (at[np.append(new - 1, -1)] + m).tolist()))


def runs(words: list[bytes], min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of a text's runs, by start, then period."""
    names: dict[bytes, int] = {}
    items = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    out = []
    for a, b in covered(items, max(1, (min_length + 1) // 2)):
        out += [(a + start, length, period) for start, length, period in runs_of(items[a:b], min_length)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside the repeats: of each run only its first period counts."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change)[:-1] == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
              prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs and its words
    without their repeats, joined by one space.  ``prepare(doc_id, words)`` may
    change the words that are searched."""
    def run(batches):
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            data, ids = raw.tobytes(), batch.column(0).to_pylist()
            rows, held, at = [], 0, 0
            for row, doc_id in enumerate(ids):
                words = data[offsets[row]:offsets[row + 1]].split()
                if prepare:
                    words = prepare(doc_id, words)
                found = runs(words, min_length)
                rows.append((len(words), found, b" ".join(collapse(words, found))))
                held += len(rows[-1][2]) + 24 * len(found)
                if held > _OUT_BYTES:
                    yield _batch(ids[at:row + 1], rows)
                    rows, held, at = [], 0, row + 1
            yield _batch(ids[at:], rows)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, n_words bigint, "
                                "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def _batch(ids: list, rows: list) -> pa.RecordBatch:
    flat = np.array([r for _, found, _ in rows for r in found], np.int64).reshape(-1, 3)
    offsets = np.cumsum([0, *(len(found) for _, found, _ in rows)])
    structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([n for n, _, _ in rows], pa.int64()),
         pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
         pa.array([text for _, _, text in rows], pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"])
