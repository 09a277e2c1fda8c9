"""Words and shingles of whole Arrow text columns as 64-bit hashes, without a loop over rows.

A word is a run of bytes other than space and the control characters 9 to 13. All of them
are single bytes in UTF-8, so texts are read as bytes. The hash of a word is a polynomial
over its bytes modulo 2**64: with prefix sums of ``TABLE[byte] * P**position`` it is a
difference of two sums times the inverse power of its start.
"""

import numpy as np
import pyarrow as pa

PIECE = 1 << 19  # bytes hashed at a time: bounds the memory of very long texts
_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240607).integers(1, 1 << 64, 256, dtype=_U)
_LOWER_RANDOM = _RANDOM[_LOWER]


def mix(x):
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _powers(base, n):
    out = np.empty(n, _U)
    out[0], done, step = 1, 1, base
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * _U(step)
        done, step = done + take, step * step % (1 << 64)
    return out


_POW = {"n": 0}


def _tables(n):
    if _POW["n"] < n:
        size = max(n, PIECE + 4096)
        _POW.update(n=size, p=_powers(_P, size), q=_powers(_P_INV, size))
    return _POW["p"], _POW["q"]


def buffers(column):
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(raw, offsets, kinds):
    """Starts and ends of the maximal runs of equal kind within each text; bytes of kind 0
    separate and belong to no run."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = kinds[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[offsets[(offsets > 0) & (offsets < len(raw))]] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] != 0
    return starts[keep], ends[keep]


_WORD_KIND = (~_SPACE).astype(np.uint8)


def hash_runs(raw, starts, ends, lower=True):
    """64-bit hashes of byte ranges, which ascend and do not overlap."""
    out = np.empty(len(starts), _U)
    table = _LOWER_RANDOM if lower else _RANDOM
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + PIECE, side="right")))
        hi = ends[j - 1]
        p, q = _tables(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum(table[raw[lo:hi]] * p[:hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * q[s])
        i = j
    return out


def word_hashes(column, lower=True):
    """(hashes, bounds): the words of text i are ``hashes[bounds[i]:bounds[i + 1]]``."""
    raw, offsets = buffers(column)
    starts, ends = runs(raw, offsets, _WORD_KIND)
    return hash_runs(raw, starts, ends, lower), np.searchsorted(starts, offsets)


def shingles_of(words, size=5):
    """Distinct hashes of runs of ``size`` words, sorted; with fewer words, the whole
    sequence is the one shingle; without words the set is empty."""
    n = len(words)
    if not n:
        return words
    k = min(size, n)
    acc = np.full(n - k + 1, k, _U)
    for i in range(k):
        acc = mix(acc * _U(0x2545F4914F6CDD1D) + words[i:n - k + 1 + i])
    return np.unique(acc)


def slices(batch, column, limit=1 << 22):
    """Zero-copy slices of a batch with about ``limit`` bytes of text, a row at least."""
    col = batch.column(column) if isinstance(column, int) else batch[column]
    if not len(col):
        return
    offsets = np.frombuffer(col.cast(pa.large_string()).buffers()[1], np.int64)
    at = 0
    base = offsets[-(len(col) + 1):]
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(base, base[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
