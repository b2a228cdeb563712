"""Words of Arrow text columns as numpy arrays.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; A-Z is lower-cased.
Words are named by a 64-bit hash computed for a whole Arrow batch at once, so
no Python object is made per word.  Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SEP = np.zeros(256, bool)
SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()

_BLOCK = 1 << 18
_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_POW = np.ones(_BLOCK + 1, np.uint64)
_POW[1:] = _P
_INV = np.ones(_BLOCK + 1, np.uint64)
_INV[1:] = pow(_P, -1, 1 << 64)
with np.errstate(over="ignore"):
    _POW = np.multiply.accumulate(_POW)
    _INV = np.multiply.accumulate(_INV)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null -> empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(raw: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SEP):
    """Word starts, ends and the number of words per text."""
    is_word = ~sep[raw]
    n = len(raw)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = is_word.copy()
    start[1:] &= ~is_word[:-1] | first[1:n]
    end = is_word.copy()
    end[:-1] &= ~is_word[1:] | first[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefixes: tuple = ()):
    """64-bit hash of each word (and of its first k bytes for k in prefixes)."""
    n = len(starts)
    out = [np.empty(n, np.uint64) for _ in range(1 + len(prefixes))]
    i = 0
    with np.errstate(over="ignore"):
        while i < n:
            base = int(starts[i])
            j = int(np.searchsorted(ends, base + _BLOCK, "right"))
            if j <= i:  # one word longer than a block
                word = low[starts[i]:ends[i]].tobytes()
                for o, k in zip(out, (len(word), *prefixes)):
                    o[i] = xxhash.xxh64_intdigest(word[:k], 7)
                i += 1
                continue
            seg = low[base:int(ends[j - 1])]
            c = np.zeros(len(seg) + 1, np.uint64)
            np.cumsum(_TABLE[seg] * _POW[:len(seg)], out=c[1:])
            s, e = starts[i:j] - base, ends[i:j] - base
            inv, lo = _INV[s], c[s]
            out[0][i:j] = (c[e] - lo) * inv
            for o, k in zip(out[1:], prefixes):
                o[i:j] = (c[np.minimum(s + k, e)] - lo) * inv
            i = j
        return [mix64(o) for o in out]


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned integer arrays as byte planes: small values leave planes of
    zeros, which the shuffle's compression removes."""
    head = [len(arrays)]
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head += [a.dtype.itemsize, len(a)]
        body.append(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes())
    return np.array(head, "<i8").tobytes() + b"".join(body)


def unpack(blob: bytes) -> list[np.ndarray]:
    k = int(np.frombuffer(blob, "<i8", 1)[0])
    head = np.frombuffer(blob, "<i8", 2 * k, 8)
    at, out = 8 + 16 * k, []
    for width, n in zip(head[::2].tolist(), head[1::2].tolist()):
        planes = np.frombuffer(blob, np.uint8, width * n, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}"))
        at += width * n
    return out


def unique_sum(keys: np.ndarray, counts: np.ndarray | None = None):
    """Sorted distinct keys and the sum of their counts (1 each if None)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, np.zeros(0, np.uint64)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    if counts is None:
        return keys[at], np.diff(np.append(at, len(keys))).astype(np.uint64)
    return keys[at], np.add.reduceat(counts.astype(np.uint64), at)
