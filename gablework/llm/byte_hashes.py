"""Hashes of pieces of many byte strings at once, for use inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _table(seed: int) -> np.ndarray:
    """A 64-bit number for each byte value, from a rule (splitmix steps from the seed)."""
    x = (np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000)) * _MIX
    return mixed(mixed(x))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts without nulls, and where each text begins (one more for the end)."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    offsets = offsets.astype(np.int64)
    return data[offsets[0]:offsets[-1]] if len(offsets) else data[:0], offsets - (offsets[0] if len(offsets) else 0)


class Rolling:
    """Hashes of any stretch of a byte array of at most ``longest`` bytes, by sums of powers modulo 2^64."""

    def __init__(self, longest: int, seed: int):
        self.table = _table(seed)
        base = int(mixed(np.array([seed + 77], np.uint64))[0]) | 1
        self.base = base
        inverse = pow(base, -1, 2 ** 64)
        self.power, self.inverse = (self._powers(b, longest) for b in (base, inverse))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.empty(n + 1, np.uint64)
        out[0] = 1
        have, step = 1, base
        while have <= n:  # doubling: the next stretch is the one before times a power
            take = min(have, n + 1 - have)
            out[have:have + take] = out[:take] * np.uint64(step)
            have += take
            step = step * step % 2 ** 64
        return out

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[:len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of each stretch [start, stop); lengths enter too."""
        return mixed((sums[stop] - sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64) * _MIX)


def gram_hashes(data: np.ndarray, table: np.ndarray, doublings: int) -> np.ndarray:
    """Hash of the 2^doublings bytes from each place on (as many places as there are whole grams)."""
    h = table[data]
    for i in range(doublings):
        step = 1 << i
        if len(h) <= step:
            return h[:0]
        h = h[:-step] * np.uint64(0xD6E8FEB86659FD93 + 2 * i) + h[step:]
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    have = 1
    out = x
    while have < width:
        step = min(have, width - have)
        if len(out) <= step:
            return out[:0]
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def cut(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of whole texts of at most ``most`` bytes together; a longer one comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = max(j, i + 1)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, rolling: Rolling, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts whose words are parted by single blanks, and where each text's words begin.

    Texts longer than ``most`` are cut at blanks; ``rolling`` covers twice ``most``, and a longer word is hashed whole.
    """
    found: list[np.ndarray] = []
    counts = np.zeros(len(offsets) - 1, np.int64)
    for i, j in cut(offsets, most):
        start, stop = int(offsets[i]), int(offsets[j])
        while start < stop:
            end = stop
            if end - start > most:  # one long text: up to a blank
                blanks = np.flatnonzero(data[start:start + most] == 32)
                if len(blanks):
                    end = start + int(blanks[-1]) + 1
                else:
                    later = np.flatnonzero(data[start + most:stop] == 32)
                    end = start + most + int(later[0]) + 1 if len(later) else stop
            part = data[start:end]
            gap = part == 32
            first = ~gap
            first[1:] &= gap[:-1]
            edges = offsets[i:j + 1] - start if end == stop and start == offsets[i] else np.array([0, end - start])
            inner = edges[1:-1]
            inner = inner[(inner > 0) & (inner < len(part))]
            first[inner] = ~gap[inner]
            begins = np.flatnonzero(first)
            bounds = np.union1d(np.flatnonzero(gap), np.append(inner, len(part)))
            ends = bounds[np.searchsorted(bounds, begins, side="right")] if len(begins) else begins
            if len(begins):
                if int((ends - begins).max()) > 2 * most or len(part) > 2 * most:
                    found.append(np.array([int.from_bytes(hashlib.blake2b(part[a:b].tobytes(), digest_size=8).digest(), "little")
                                           for a, b in zip(begins, ends)], np.uint64))
                else:
                    found.append(rolling.of(rolling.sums(part), begins, ends))
                owner = np.searchsorted(offsets, begins + start, side="right") - 1
                np.add.at(counts, owner, 1)
            start = end
    words = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return words, np.append(0, np.cumsum(counts))
