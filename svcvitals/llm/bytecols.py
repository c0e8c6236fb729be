"""Vectorised work on the bytes of Arrow string columns (numpy, used inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes handled at once; arrays of a few times this size live in a task.
CHUNK = 1 << 20
_rng = np.random.default_rng(20240607)
_U = np.uint64
TABLES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
ASCII_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[tuple[int, bool], np.ndarray] = {}


def string_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 row offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets.astype(np.int64)


def row_slices(offsets: np.ndarray, limit: int = CHUNK):
    """Row ranges (i, j) of at most ``limit`` bytes, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1))
        yield i, j
        i = j


def powers(n: int, which: int = 0, inverse: bool = False) -> np.ndarray:
    """The base's powers 0..n-1 modulo 2^64, or those of its inverse."""
    have = _powers.get((which, inverse))
    if have is None or len(have) < n:
        base = pow(BASES[which], -1, 1 << 64) if inverse else BASES[which]
        have = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
        have[0] = 1
        _powers[which, inverse] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others (a bijection)."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(29))
    h = h * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def prefix_sums(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Polynomial prefix sums modulo 2^64; the hash of data[a:b] is (S[b] - S[a]) / base^a."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(TABLES[which][data] * powers(len(data), which), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(len(sums), which, True)[starts] + (ends - starts).astype(np.uint64))


def window_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of many short ranges data[start:end], in chunks of the data."""
    out = np.empty(len(starts), dtype=np.uint64)
    order = np.argsort(starts, kind="stable") if (np.diff(starts) < 0).any() else np.arange(len(starts))
    ranked, i = starts[order], 0
    while i < len(order):
        a = int(ranked[i])
        j = int(np.searchsorted(ranked, a + CHUNK))
        at = order[i:j]
        sums = prefix_sums(data[a:int(ends[at].max())], which)
        out[at] = span_hashes(sums, starts[at] - a, ends[at] - a, which)
        i = j
    return out


#: Ranges beyond so many bytes are hashed and compared one by one, by C code.
LONG = 256
_SEEDS = _rng.integers(1, 1 << 63, 2, dtype=np.uint64)
_TAILS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def limbs(data: np.ndarray) -> np.ndarray:
    """The eight bytes that follow each position (zeros behind the end), as one number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hashes of ranges data[start:end], each mixed eight bytes at a time, so that no
    structure of the bytes (as in sums of powers modulo 2^64) makes different ranges meet."""
    sizes = np.asarray(ends - starts, dtype=np.int64)
    out = mixed(_SEEDS[which] + sizes.astype(np.uint64))
    eight, left, k = limbs(data), np.flatnonzero((sizes > 0) & (sizes <= LONG)), 0
    while len(left):
        rest = sizes[left] - k
        limb = eight[starts[left] + k] & _TAILS[np.minimum(rest, 8)]
        out[left] = mixed((out[left] ^ limb) + _SEEDS[which])
        left, k = left[rest > 8], k + 8
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes(), int(_SEEDS[which]))
    return out


def same_ranges(a: np.ndarray, a_starts: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray,
                eight: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Whether the bytes a[start:end] and b[start:end] are equal, pair by pair; ``eight``: the
    limbs of both, where they are there already."""
    sizes = np.asarray(a_ends - a_starts, dtype=np.int64)
    same = sizes == b_ends - b_starts
    (eight_a, eight_b), left, k = eight or (limbs(a), limbs(b)), np.flatnonzero(same & (sizes > 0) & (sizes <= LONG)), 0
    while len(left):
        rest = sizes[left] - k
        equal = ((eight_a[a_starts[left] + k] ^ eight_b[b_starts[left] + k]) & _TAILS[np.minimum(rest, 8)]) == 0
        same[left[~equal]] = False
        left, k = left[equal & (rest > 8)], k + 8
    for i in np.flatnonzero(same & (sizes > LONG)).tolist():
        same[i] = np.array_equal(a[a_starts[i]:a_ends[i]], b[b_starts[i]:b_ends[i]])
    return same


def _cuts(data: np.ndarray, a: int, b: int, separator: np.ndarray):
    """Split data[a:b] at separators into ranges of about CHUNK bytes."""
    while b - a > CHUNK:
        at, step = a + CHUNK, 4096
        while at < b and not (found := np.flatnonzero(separator[data[at:min(b, at + step)]])).size:
            at = min(b, at + step)
        cut = at if at >= b else at + int(found[0])
        yield a, cut
        a = cut
    yield a, b


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = ASCII_SPACE, lower: bool = True):
    """Runs of bytes that are no separators, never across rows: starts, ends, 64-bit hashes.

    A-Z count as lower case for the hashes. Works in chunks that end at separators, so the
    arrays beside the result stay small for a long row too.
    """
    out = []
    fold = LOWER if lower else np.arange(256, dtype=np.uint8)
    for i, j in row_slices(offsets):
        for a, b in _cuts(data, int(offsets[i]), int(offsets[j]), separator):
            if a == b:
                continue
            part = data[a:b]
            inside = ~separator[part]
            first = np.zeros(b - a + 1, dtype=bool)
            rows = offsets[i:j + 1] - a
            first[rows[(rows >= 0) & (rows <= b - a)]] = True
            starts = inside.copy()
            starts[1:] &= ~inside[:-1] | first[1:-1]
            ends = inside.copy()
            ends[:-1] &= ~inside[1:] | first[1:-1]
            s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
            out.append((s + a, e + a, range_hashes(fold[part], s, e)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row of each byte position."""
    return np.searchsorted(offsets, starts, side="right") - 1


def ragged(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


__all__ = ["ASCII_SPACE", "LOWER", "CHUNK", "limbs", "string_bytes", "row_slices", "powers", "mixed", "prefix_sums", "span_hashes", "window_hashes",
           "range_hashes", "same_ranges", "words", "rows_of", "ragged"]
