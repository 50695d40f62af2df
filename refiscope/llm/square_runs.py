"""Periodic runs of words by online dyadic square catching.

The words of a text are appended in order. Whenever a block of 2^k words that begins at a multiple of
2^k is complete, it becomes a catcher of level k for the 2^k suffixes that begin in the next block.
An appended word completes one suffix of 2^k words on every level; its fingerprint is compared with
that of the one catcher on duty. If they agree, the text repeats at the distance q of the two
(2^k <= q < 2^(k+1)), and the catch grows by suffix comparisons to both sides into the longest
stretch with period q. Catches of one stretch merge into one run; a run that reaches the last word is
open and goes on growing with the words appended later.

Levels are served from small to large. A catch inside a run that a smaller level has found repeats a
multiple of that run's period and is dropped, so a run is reported with its smallest period. A run of
at least three periods always holds a whole catcher and its next occurrence, hence none is missed.

A word costs one comparison a level. Words that come together are compared in one vector operation.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rolling import Rolling, word_digests

LEAST_WORDS = 24
LEAST_PERIODS = 3
Run = tuple[int, int, int]  # first word, number of words, period


class SquareCatchers:
    """Runs of a growing sequence of 64-bit values."""

    def __init__(self):
        self.values = np.zeros(0, np.uint64)
        self.n = 0
        self.rolling = Rolling(self.values)
        #: Per level the runs found by its catchers: first word, end, period.
        self.caught: list[np.ndarray] = []

    def append(self, values: np.ndarray) -> None:
        before, self.n = self.n, self.n + len(values)
        self.values = np.concatenate([self.values, values]) if before else values
        self.rolling = Rolling(self.values)
        self._grow(before)
        level = 0
        while 2 << level <= self.n:
            if level == len(self.caught):
                self.caught.append(np.zeros((0, 3), np.int64))
            self._serve(level, before)
            level += 1

    def _grow(self, before: int) -> None:
        """Open runs take the words that keep their period."""
        for runs in self.caught:
            open_ = np.flatnonzero(runs[:, 1] == before)
            if len(open_) and before < self.n:
                end, period = runs[open_, 1], runs[open_, 2]
                runs[open_, 1] += self._forward(end - period, end, np.zeros(len(end), np.int64))

    def _serve(self, level: int, before: int) -> None:
        """Compares the suffixes that the new words complete with the catchers on duty."""
        size = 1 << level
        first, last = max(size, before - size + 1), self.n - size  # starts of the suffixes
        if first > last:
            return
        sums, powers = self.rolling.sums, self.rolling.powers
        suffixes = (sums[first + size : last + size + 1] - sums[first : last + 1]) * powers[first : last + 1]
        begin = np.arange(first // size - 1, last // size) * size
        catchers = np.repeat((sums[begin + size] - sums[begin]) * powers[begin], size)
        starts = np.flatnonzero(suffixes == catchers[first % size : first % size + len(suffixes)]) + first
        if not len(starts):
            return
        catchers_of = (starts // size - 1) * size
        known = np.concatenate(self.caught[:level]) if level else np.zeros((0, 3), np.int64)
        if len(known):  # inside a run of a smaller period
            known = known[np.argsort(known[:, 0], kind="stable")]
            reach = np.maximum.accumulate(known[:, 1])
            at = np.searchsorted(known[:, 0], catchers_of, "right") - 1
            new = (at < 0) | (reach[np.maximum(at, 0)] < starts + size)
            starts, catchers_of = starts[new], catchers_of[new]
            if not len(starts):
                return
        period = starts - catchers_of
        back = self._backward(catchers_of, starts)
        forth = self._forward(catchers_of, starts, np.full(len(starts), size))
        found = np.stack([catchers_of - back, starts + forth, period], axis=1)
        self.caught[level] = np.unique(np.concatenate([self.caught[level], found]), axis=0)

    def _forward(self, a: np.ndarray, b: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that begins at a and at b > a, of which ``equal`` words are known."""
        return self._longest(equal, self.n - b, lambda length: self.rolling.of(a, length) == self.rolling.of(b, length))

    def _backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that ends before a and before b > a."""
        return self._longest(np.zeros_like(a), a, lambda length: self.rolling.of(a - length, length) == self.rolling.of(b - length, length))

    @staticmethod
    def _longest(low: np.ndarray, high: np.ndarray, equal) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while np.any(low < high):
            middle = (low + high + 1) >> 1
            good = equal(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def runs(self, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[Run]:
        """All runs so far of so many words and periods, by first word and period; each is compared word by word."""
        if least_periods < 3:
            raise ValueError("runs of fewer than three periods may hold no whole catcher")
        found = np.concatenate(self.caught) if self.caught else np.zeros((0, 3), np.int64)
        size = found[:, 1] - found[:, 0]
        found = found[(size >= least_words) & (size >= least_periods * found[:, 2])]
        out = [(a, e - a, q) for a, e, q in found.tolist() if np.array_equal(self.values[a : e - q], self.values[a + q : e])]
        return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(values: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[Run]:
    """Runs of a whole sequence."""
    catchers = SquareCatchers()
    catchers.append(values)
    return catchers.runs(least_words, least_periods)


def top(runs: list[Run]) -> Run | None:
    """The run of the greatest exponent; ties go to the smallest first word, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def dropped(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) > 0


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period), strongest (the run of the
    greatest exponent, null without one) and collapsed (the words without those after the first period of
    a run, joined by one space) of every row.

    Null and empty texts have no words and no runs; repeated rows stay; a text of any length is one
    sequence; other columns are not read; an empty table gives an empty one.
    """

    @F.pandas_udf("n_words bigint, start array<bigint>, length array<bigint>, period array<bigint>, strongest array<bigint>, collapsed string")
    def searched(raws: pd.Series) -> pd.DataFrame:
        out = []
        for raw in raws:
            runs = runs_of(word_digests(raw), least_words, least_periods)
            words = raw.split()
            kept = compress(words, (~dropped(len(words), runs)).tolist()) if runs else words
            out.append((len(words), *([r[k] for r in runs] for k in range(3)), top(runs), b" ".join(kept).decode("utf-8", "replace")))
        return pd.DataFrame(out, columns=["n_words", "start", "length", "period", "strongest", "collapsed"])

    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    found = docs.select(F.col(doc_id).alias("doc_id"), searched(whole).alias("r")).select("doc_id", "r.*")
    best = F.struct(*[F.get("strongest", F.lit(k)).alias(c) for k, c in enumerate(("start", "length", "period"))])
    return found.select("doc_id", "n_words", F.arrays_zip("start", "length", "period").alias("runs"), F.when(F.col("strongest").isNotNull(), best).alias("strongest"), "collapsed")
