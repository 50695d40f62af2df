"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics of every whole text are measured inside Arrow batches and transformed to be roughly
normal. Spark sums the moments of both classes over all labelled training rows; from them come
class means and covariances, shrunk towards the pooled covariance and its mean variance. Only the
Cholesky factors of the two small matrices are kept; a score is the logistic of the difference of
two log-densities, each a Mahalanobis length through its cached factor, plus the log prior.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

STATISTICS = (
    "length", "words", "word_length", "upper", "signs", "digits", "spaces", "variety", "top_word", "line_variety", "word_spread", "repeats", "plain_ends",
)
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_SPACES = bytes([32, 9, 10, 11, 12, 13])
_PLAIN = b".,;:!?'\"()-"
_ENDS = frozenset(b".!?")


def _logit(part: float, whole: float) -> float:
    """Of a share, with half a case added to both sides."""
    return math.log((part + 0.5) / (whole - part + 0.5))


def statistics(text: str | None) -> tuple[float, ...]:
    """In the order of ``STATISTICS``; an empty text has defined values."""
    raw = (text or "").encode("utf-8", "replace")
    n = len(raw)
    upper = n - len(raw.translate(None, _UPPER))
    letters = n - len(raw.translate(None, _LETTERS))
    digits = n - len(raw.translate(None, _DIGITS))
    spaces = n - len(raw.translate(None, _SPACES))
    plain = n - len(raw.translate(None, _PLAIN))
    words = raw.split()
    counts = Counter(words)
    k = len(words)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / k if k else 0.0
    spread = math.sqrt(sum((x - mean) ** 2 for x in lengths) / k) if k else 0.0
    lines = [x for x in raw.split(b"\n") if x.strip()]
    adjacent = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(w[-1] in _ENDS for w in words)
    signs = max(0, n - letters - digits - spaces - plain)
    return (
        math.log1p(n), math.log1p(k), math.log1p(mean), _logit(upper, letters), _logit(signs, n), _logit(digits, n), _logit(spaces, n),
        math.log((len(counts) + 1) / (k + 1) ** 0.75), _logit(max(counts.values(), default=0), k),
        _logit(len(set(lines)), len(lines)), math.log1p(spread), _logit(adjacent, k), _logit(ends, k),
    )


def measured(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return rows(text)


@dataclass(frozen=True)
class Discriminant:
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]  # inverses of the lower Cholesky factors
    log_dets: tuple[float, float]
    log_prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            z = (x - mean) @ factor.T
            density.append(-0.5 * ((z * z).sum(1) + log_det))
        margin = density[1] - density[0] + self.log_prior
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def _moments(rows: DataFrame, d: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: count, sums and sums of products, over all rows of (label, x)."""
    x = [F.col("x")[i] for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    out = {}
    for r in rows.groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect():  # one row a class
        s = np.array([r[f"s{i}"] for i in range(d)])
        p = np.zeros((d, d))
        for i in range(d):
            for j in range(i + 1):
                p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        out[r["label"]] = (float(r["n"]), s, p)
    return out


def fit(rows: DataFrame, shrink: float = 0.1, ridge: float = 0.02) -> Discriminant | None:
    """``rows``: label 0 or 1 and x, the array of statistics. All rows are used, through sums.

    ``shrink`` is the weight of the pooled covariance, ``ridge`` of its diagonal. None if a class has no rows.
    """
    d = len(STATISTICS)
    found = _moments(rows.where("label in (0, 1)"), d)
    if set(found) != {0, 1}:
        return None
    n = [found[c][0] for c in (0, 1)]
    means = [found[c][1] / found[c][0] for c in (0, 1)]
    scatter = [found[c][2] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / max(1.0, sum(n) - 2)
    base = np.diag(np.diag(pooled)) + np.eye(d) * (1e-6 + 1e-3 * np.trace(pooled) / d)
    factors, log_dets = [], []
    for c in (0, 1):
        own = scatter[c] / max(1.0, n[c] - 1)
        cov = (1 - shrink - ridge) * own + shrink * pooled + ridge * base
        lower = np.linalg.cholesky(cov + np.eye(d) * 1e-9)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * float(np.log(np.diag(lower)).sum()))
    return Discriminant((means[0], means[1]), (factors[0], factors[1]), (log_dets[0], log_dets[1]), math.log(n[1] / n[0]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _learn(known: DataFrame, labels: DataFrame, doc_id: str, label: str) -> Discriminant | None:
    taught = labels.where(~held_out(F.col(doc_id))).select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    return fit(known.join(taught.where("label is not null"), "doc_id"))


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for every row of ``docs``.

    Learns from the labels of documents that are not held out; null labels and ids teach nothing,
    repeated label rows count repeatedly. Null texts are scored as empty. Without examples of both
    classes every score is 0.5. Labels and other columns of ``docs`` are never read for a score.
    """
    known = stage(docs.select(F.col(doc_id).alias("doc_id"), measured(F.col(text)).alias("x")), "quality-statistics")
    model = _learn(known, labels, doc_id, label)

    @F.pandas_udf("double")
    def scored(rows: pd.Series) -> pd.Series:
        if model is None or not len(rows):
            return pd.Series([0.5] * len(rows), dtype="float64")
        return pd.Series(model.scores(np.stack(rows.to_numpy())))

    out = known.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that ``score`` predicts as 1, all columns as they were.

    The statistics of labelled documents are measured once to learn and every text once to judge,
    so no text is shuffled.
    """
    known = stage(docs.select(F.col(doc_id).alias("doc_id"), measured(F.col(text)).alias("x")), "quality-statistics")
    model = _learn(known, labels, doc_id, label)

    @F.pandas_udf("boolean")
    def fine(texts: pd.Series) -> pd.Series:
        if model is None or not len(texts):
            return pd.Series([True] * len(texts), dtype="bool")
        return pd.Series(model.scores(np.array([statistics(t) for t in texts])) >= 0.5)

    return docs.where(fine(F.col(text)))
