"""CRC-32 of every word n-gram of many texts from one scan of their bytes.

CRC-32 without its first and last inversion is linear over GF(2): if R(p) is the running value after p bytes, the value of
the bytes a to b alone is R(b) xor R(a) shifted by b - a zero bytes. So one pass stores the running
values, and any run of words costs two look-ups and one shift, however long it is.

The pass itself works on many stretches of the bytes at once; the value before a stretch is the shifted value
behind the stretch before it. A shift by n bytes is a multiplication with a fixed 32 x 32 matrix: as four
tables of 256 for small n, and by powers of two beyond.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# The reversed polynomial of CRC-32, as in zip files (fixed value).
POLYNOMIAL = 0xEDB88320
STRETCHES = 2048
DIRECT_SHIFTS = 64
_ONES = np.uint32(0xFFFFFFFF)


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


def _apply(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    return tables[0][values & 255] ^ tables[1][values >> 8 & 255] ^ tables[2][values >> 16 & 255] ^ tables[3][values >> 24]


@lru_cache(maxsize=64)
def _shift_tables(power: int) -> np.ndarray:
    """Tables that shift by 2**power bytes: those of half the way, applied twice."""
    if power == 0:
        byte = _byte_table()
        values = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
        return byte[values & 255] ^ values >> 8
    half = _shift_tables(power - 1)
    return _apply(half, half)


@lru_cache(maxsize=1)
def _direct_tables() -> np.ndarray:
    """(4, shifts, 256) tables for each number of bytes below DIRECT_SHIFTS."""
    values = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    steps = [values]
    for _ in range(DIRECT_SHIFTS - 1):
        steps.append(_apply(_shift_tables(0), steps[-1]))
    return np.ascontiguousarray(np.stack(steps, axis=1))


def shifted(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each value behind so many zero bytes more."""
    tables, low = _direct_tables(), lengths % DIRECT_SHIFTS
    out = tables[0][low, values & 255] ^ tables[1][low, values >> 8 & 255] ^ tables[2][low, values >> 16 & 255] ^ tables[3][low, values >> 24]
    power, rest = DIRECT_SHIFTS.bit_length() - 1, lengths // DIRECT_SHIFTS
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        if len(odd):
            out[odd] = _apply(_shift_tables(power), out[odd])
        rest, power = rest >> 1, power + 1
    return out


class Prefixes:
    """Running values of some bytes, scanned once in stretches that each start from zero.

    The value before a stretch cancels out for spans inside it, so it is worked in only for spans that cross one's end.
    """

    def __init__(self, data: np.ndarray) -> None:
        lanes = max(1, min(STRETCHES, len(data) // 64))
        self.width = max(1, -(-len(data) // lanes))
        cells = np.zeros(lanes * self.width, np.uint8)
        cells[: len(data)] = data
        inside = np.zeros((self.width + 1, lanes), np.uint32)
        table, value = _byte_table(), inside[0]
        for at, step in enumerate(np.ascontiguousarray(cells.reshape(lanes, self.width).T), 1):
            value = table.take((value ^ step) & 255) ^ value >> 8
            inside[at] = value
        self.inside = np.ascontiguousarray(inside.T)

    @property
    def before(self) -> np.ndarray:
        """The value before each stretch: the one behind the last, shifted by a stretch."""
        values = [0]
        tables = [t.tolist() for t in self._by_stretch()]
        for end in self.inside[:-1, -1].tolist():
            v = values[-1]
            values.append(tables[0][v & 255] ^ tables[1][v >> 8 & 255] ^ tables[2][v >> 16 & 255] ^ tables[3][v >> 24] ^ end)
        return np.array(values, np.uint32)

    def _by_stretch(self) -> np.ndarray:
        ones = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
        return shifted(ones.ravel(), np.full(ones.size, self.width)).reshape(ones.shape)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes from each start to its end."""
        lane = np.minimum(starts // self.width, len(self.inside) - 1)
        begin, end = starts - lane * self.width, ends - lane * self.width
        across = np.flatnonzero(end > self.width)
        first, last = self.inside[lane, begin], self.inside[lane, np.minimum(end, self.width)]
        if len(across):
            before, other = self.before, np.minimum(ends[across] // self.width, len(self.inside) - 1)
            there = ends[across] - other * self.width
            first[across] ^= shifted(before[lane[across]], begin[across])
            last[across] = self.inside[other, there] ^ shifted(before[other], there)
        return last ^ shifted(first ^ _ONES, ends - starts) ^ _ONES
