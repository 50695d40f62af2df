"""Word digests and Rabin-Karp fingerprints of stretches of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

#: A factor that is odd has an inverse modulo 2^64, so prefix sums can be scaled back to any place.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse; a worker keeps them as long as its longest block."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        steps = np.full(size, _FACTOR, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
        steps[1:] = _INVERSE
        _inverses = np.multiply.accumulate(steps)
    return _powers[:n], _inverses[:n]


class Rolling:
    """Fingerprints of the stretches of a sequence of 64-bit values, modulo 2^64, from prefix sums."""

    def __init__(self, values: np.ndarray):
        self.powers, inverses = _tables(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * inverses[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return (self.sums[starts + lengths] - self.sums[starts]) * self.powers[starts]

    def windows(self, length: int) -> np.ndarray:
        """Of every window of one length."""
        n = max(len(self.sums) - length, 0)
        return (self.sums[length:] - self.sums[:n]) * self.powers[:n] if n else np.zeros(0, np.uint64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Bits spread over the whole word, so that order and low bits say nothing of the values."""
    z = x + np.uint64(salt)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return z ^ (z >> np.uint64(31))


def pieces(raw: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes that end at white space."""
    at = 0
    while at < len(raw):
        gap = _SPACE.search(raw, at + size) if at + size < len(raw) else None
        end = gap.start() if gap else len(raw)
        yield raw[at:end]
        at = end


def word_digests(raw: bytes) -> np.ndarray:
    """64-bit digests of the words, which ASCII white space separates."""
    parts = []
    for piece in pieces(raw):
        words = piece.split()
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint64)
