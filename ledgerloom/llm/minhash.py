"""HyperMinHash sketches of word-shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .bytehash import LOWER_VALUES, mix, range_hashes, row_of, text_bytes, word_ranges

#: What separates words (space, tab, line feed, vertical tab, form feed, carriage return).
GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
U = np.uint64


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the shingles of ``size`` words of each text.

    A text with fewer words, but not none, has one shingle of all its words.
    """
    data, limits = text_bytes(column)
    starts, ends = word_ranges(data, limits, ~GAP)
    first = row_of(starts, limits)
    words = range_hashes(data, starts, ends, LOWER_VALUES)
    n = max(0, len(words) - size + 1)
    joined = np.zeros(n, U)
    for j in range(size):
        joined = joined * U(0xD6E8FEB86659FD93) + words[j: j + n]
    joined = mix(joined + U(size))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(joined[a: b - size + 1]))
        elif b > a:
            whole = np.array([b - a], U)
            for j in range(a, b):
                whole = mix(whole * U(0xD6E8FEB86659FD93) + words[j: j + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, U))
    return out


class Sketcher:
    """Sketches of ``bands * rows`` one-byte registers, and how many hashes fell into each bucket.

    A register keeps the smallest hash of its bucket in the compressed form of HyperMinHash: the count of leading zeros
    (up to 15) in its upper half and the first four bits after the leading one in its lower half. An empty bucket takes
    the register of another bucket, always probing the same buckets in the same order, so that small sets fill their
    sketch too.
    """

    MANTISSA = 4

    def __init__(self, bands: int = 42, rows: int = 6) -> None:
        self.bands, self.rows = bands, rows
        self.size = bands * rows
        self.probe = np.random.default_rng(11).integers(0, self.size, (self.size, 64))

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m, r = self.size, self.MANTISSA
        bucket = ((hashes >> U(32)) * U(m)) >> U(32)
        held = (bucket << U(52)) | (mix(hashes ^ U(0x5851F42D4C957F2D)) >> U(12))
        held.sort()
        bucket = (held >> U(52)).astype(np.int64)
        counts = np.minimum(np.bincount(bucket, minlength=m), 255).astype(np.uint8)
        new = np.ones(len(held), bool)
        new[1:] = bucket[1:] != bucket[:-1]
        bucket, low = bucket[new], held[new] & U((1 << 52) - 1)
        part, exponent = np.frexp(low.astype(float))
        zeros = np.minimum(52 - exponent, 15)
        bits = ((part - 0.5) * (2 << r)).astype(np.int64) * (low > 0)
        out = np.zeros(m, np.uint8)
        out[bucket] = (zeros << r) | bits
        if 0 < len(bucket) < m:
            full = np.zeros(m, bool)
            full[bucket] = True
            empty = np.flatnonzero(~full)
            tries = full[self.probe[empty]]
            donor = self.probe[empty, tries.argmax(1)]
            lost = ~tries.any(1)
            donor[lost] = bucket[np.searchsorted(bucket, empty[lost]) % len(bucket)]
            out[empty] = out[donor]
        return out, counts

    def band_keys(self, sketches: np.ndarray) -> np.ndarray:
        """One 64-bit key per sketch and band."""
        parts = sketches.reshape(len(sketches), self.bands, self.rows).astype(U)
        key = np.broadcast_to(mix(np.arange(1, self.bands + 1, dtype=U)), parts.shape[:2]).copy()
        for j in range(self.rows):
            key = mix(key * U(0xD6E8FEB86659FD93) + parts[:, :, j])
        return key

    def possible(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, n_a, n_b, limit: float, deviations: float = 6.0) -> np.ndarray:
        """Which pairs may reach the similarity ``limit``.

        Three tests: the sizes; the counts per bucket, whose difference is never above the number of hashes in which two
        sets differ; and the registers, whose share that agrees, less what agrees by chance (the HyperMinHash correction
        for two sets of these sizes), estimates the similarity. The last is a statistic: a pair fails it wrongly if the
        estimate is off by ``deviations`` standard deviations.
        """
        n_a, n_b = np.asarray(n_a, float), np.asarray(n_b, float)
        small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
        ok = small >= limit * large - 1e-9
        differ = np.abs(of_a.astype(np.int16) - of_b).sum(-1)
        ok &= differ <= (1 - limit) / (1 + limit) * (n_a + n_b) + 1e-6
        ratio = small / large
        chance = np.minimum(self.size * 0.1699194871597391 * 4 * ratio / (1 + ratio) ** 2 / 2**self.MANTISSA, self.size / 2)
        estimate = ((a == b).sum(-1) - chance) / (self.size - chance)
        margin = deviations * np.sqrt(limit * (1 - limit) / np.minimum(small, self.size)) + 0.01
        return ok & (estimate >= limit - margin)
