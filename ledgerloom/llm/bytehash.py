"""Hashes of many byte ranges at once, for the tasks that work on words, shingles and byte windows.

The hash of the bytes ``b[s:e]`` mixes two sums ``sum(T[b[i]] * C**(i - s))`` with random tables ``T``: one modulo 2**64
with an odd ``C``, one modulo the prime 2**31 - 1. Alone the first has pairs of words that collide whatever its table and base
(Thue-Morse words of 1,024 letters); modulo a prime they differ. Both come from running sums, so ranges of any length cost the
same, and the hash depends on the content alone. Hashes of all ranges of one small width (:meth:`Prefix.every`) use the
first sum only; such words are longer than those ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_C = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Bytes hashed at once; eight bytes per array element make this the memory of a task.
CHUNK = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of the splitmix generator); one-to-one."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    out[1:] = U(base)
    return np.multiply.accumulate(out)


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(_C))
LOWER = np.arange(256)
LOWER[65:91] += 32
LOWER_VALUES = BYTE_VALUES[LOWER]
#: Words of letters: ASCII letters and all bytes outside ASCII.
LETTER_RUNS = np.zeros(256, bool)
LETTER_RUNS[65:91] = LETTER_RUNS[97:123] = LETTER_RUNS[128:] = True
_UP, _DOWN = _powers(_C, CHUNK + 1), _powers(pow(_C, -1, 1 << 64), CHUNK + 1)


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers for ``n`` bytes; only a single range above ``CHUNK`` needs more than the stored ones."""
    if n <= CHUNK:
        return _UP, _DOWN
    return _powers(_C, n + 1), _powers(pow(_C, -1, 1 << 64), n + 1)


PRIME = U((1 << 31) - 1)
_BASE = 1_664_525


def _folded(x: np.ndarray) -> np.ndarray:
    """Less than 2**31 + 2**31 with the same remainder modulo ``PRIME``, for any 62 bits."""
    return (x & PRIME) + (x >> U(31))


def _remainder(x: np.ndarray) -> np.ndarray:
    x = _folded(_folded(x))
    return np.where(x >= PRIME, x - PRIME, x)


def _prime_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    have = 1
    while have < n:
        step = min(have, n - have)
        out[have: have + step] = _remainder(out[:step] * U(pow(base, have, int(PRIME))))
        have += step
    return out


_PRIME_UP, _PRIME_DOWN = (_prime_powers(b, CHUNK + 1) for b in (_BASE, pow(_BASE, -1, int(PRIME))))


def _prime_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= CHUNK:
        return _PRIME_UP, _PRIME_DOWN
    return _prime_powers(_BASE, n + 1), _prime_powers(pow(_BASE, -1, int(PRIME)), n + 1)


class Prefix:
    """Running sums over a stretch of bytes."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> None:
        up, self.down = _up_to(len(data))
        self.data, self.values, self.prime = data, values, None
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(values[data] * up[: len(data)], out=self.sums[1:])

    def _prime_sums(self) -> tuple[np.ndarray, np.ndarray]:
        if self.prime is None:
            up, down = _prime_up_to(len(self.data))
            sums = np.zeros(len(self.data) + 1, U)  # of terms below 2**32, for at most 2**30 bytes
            np.cumsum(_folded((self.values >> U(33))[self.data] * up[: len(self.data)]), out=sums[1:])
            self.prime = sums, down
        return self.prime

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums, down = self._prime_sums()
        prime = _remainder(_remainder(sums[end] - sums[start]) * down[start])
        return mix(mix((self.sums[end] - self.sums[start]) * self.down[start]) ^ prime)

    def every(self, width: int) -> np.ndarray:
        """Hashes of all ranges of ``width`` bytes, by start."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, U)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and the limits of its rows in them. Nulls are filled beforehand."""
    wide = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    limits = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, 8 * wide.offset) if len(wide) else np.zeros(1, np.int64)
    held = wide.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[limits[0]: limits[-1]], limits - limits[0]


def word_ranges(data: np.ndarray, limits: np.ndarray, inside: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a batch: longest runs of bytes with ``inside[b]``, never across rows.

    ``cut`` holds further positions at which a new word starts, as a mask over ``data``.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of = inside[data]
    first = np.zeros(len(data), bool)
    first[limits[:-1][limits[:-1] < len(data)]] = True
    if cut is not None:
        first |= cut
    starts = of.copy()
    starts[1:] &= ~of[:-1] | first[1:]
    ends = of.copy()
    ends[:-1] &= ~of[1:] | first[1:]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Hashes of disjoint ascending ranges, hashed in stretches of about ``CHUNK`` bytes."""
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
        base = starts[at]
        out[at:to] = Prefix(data[base: ends[to - 1]], values).of(starts[at:to] - base, ends[at:to] - base)
        at = to
    return out


def row_of(starts: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """First range of each row: row ``i`` has the ranges ``out[i]:out[i + 1]``."""
    return np.searchsorted(starts, limits, "left")


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``limit`` bytes of text, whatever the size of the batches."""
    for batch in batches:
        _, limits = text_bytes(batch.column(column).fill_null("") if batch.column(column).null_count else batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(limits, limits[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
