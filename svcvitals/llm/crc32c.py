"""CRC-32C of many byte ranges at once (numpy).

The checksum is linear over GF(2): ranges are padded in front with zeros to whole blocks,
all blocks are run side by side eight bytes a step, and a block's remainder is carried over
the blocks behind it by tables for 1, 2, 4, ... blocks of zeros.
"""

from __future__ import annotations

import numpy as np

POLYNOMIAL = 0x82F63B78
BLOCK = 512
MASK_DELTA = 0xA282EAD8
_U = np.uint32


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & _U(1), (t >> _U(1)) ^ _U(POLYNOMIAL), t >> _U(1))
    return t


_T0 = _byte_table()


def _zero_bytes(values: np.ndarray, n: int) -> np.ndarray:
    """Remainders after n further zero bytes."""
    for _ in range(n):
        values = (values >> _U(8)) ^ _T0[values & _U(255)]
    return values


def _halves(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables of a linear map of 32 bits, by its low and its high 16 bits."""
    out = []
    for base in (0, 16):
        t = np.zeros(1, dtype=np.uint32)
        for bit in range(16):
            t = np.concatenate([t, t ^ columns[base + bit]])
        out.append(t)
    return out[0], out[1]


_UNIT = _U(1) << np.arange(32, dtype=np.uint32)
_NEAR = _halves(_zero_bytes(_UNIT, 8))  # the four bytes read first
_FAR = _halves(_zero_bytes(_UNIT, 4))
_carry: list[tuple[np.ndarray, np.ndarray]] = []


def _apply(tables, x: np.ndarray) -> np.ndarray:
    return tables[0][x & _U(0xFFFF)] ^ tables[1][x >> _U(16)]


def _carried(k: int):
    """Tables for 2^k blocks of zeros."""
    while len(_carry) <= k:
        columns = _zero_bytes(_UNIT, BLOCK) if not _carry else _apply(_carry[-1], _apply(_carry[-1], _UNIT))
        _carry.append(_halves(columns))
    return _carry[k]


def crc32c_rows(data: np.ndarray) -> np.ndarray:
    """Checksums of the rows of a (n, length) byte matrix, length a multiple of 8."""
    w = np.ascontiguousarray(data).view("<u4").astype(np.uint32)
    state = np.full(len(data), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, w.shape[1], 2):
        state = _apply(_NEAR, state ^ w[:, k]) ^ _apply(_FAR, w[:, k + 1])
    return state ^ _U(0xFFFFFFFF)


def crc32c(data: np.ndarray, starts, ends) -> np.ndarray:
    """Checksums of data[start:end] for each range, of at least four bytes each."""
    starts, ends = np.asarray(starts, dtype=np.int64), np.asarray(ends, dtype=np.int64)
    if not len(starts):
        return np.zeros(0, dtype=np.uint32)
    blocks = -(-(ends - starts) // BLOCK)
    last = np.cumsum(blocks)
    padded = np.zeros(int(last[-1]) * BLOCK, dtype=np.uint8)
    for a, b, to in zip(starts.tolist(), ends.tolist(), (last * BLOCK).tolist()):
        at = to - (b - a)
        padded[at:to] = data[a:b]
        padded[at:at + 4] ^= 0xFF  # the initial value, folded into the first four bytes
    w = padded.view("<u4").reshape(-1, BLOCK // 4).T.astype(np.uint32, order="C")
    state = np.zeros(len(padded) // BLOCK, dtype=np.uint32)
    for k in range(0, BLOCK // 4, 2):
        state = _apply(_NEAR, state ^ w[k]) ^ _apply(_FAR, w[k + 1])
    behind = np.repeat(last, blocks) - 1 - np.arange(int(last[-1]))
    for k in range(int(behind.max()).bit_length()):
        moved = (behind >> k) & 1 == 1
        state[moved] = _apply(_carried(k), state[moved])
    return np.bitwise_xor.reduceat(state, last - blocks) ^ _U(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """The stored form: rotated by 15 bits, plus a constant."""
    return ((crc >> _U(15)) | (crc << _U(17))) + _U(MASK_DELTA)


__all__ = ["crc32c", "crc32c_rows", "masked", "BLOCK"]
