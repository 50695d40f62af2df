"""Embedding near-duplicates with an inverted multi-index.

The two halves of the unit vectors have codebooks of their own, trained on a bounded sample; pairs
of their words form the cells of a product grid, and every vector is filed in one cell. A vector
asks cells in the order of the summed squared distances to the two words, by multi-sequence
traversal, until the excess over its own cell passes a reach. A pair is met if either side asks the
other's cell. The reach is set on sample vectors with made neighbours at exactly the threshold, the
hardest pairs to meet, such that ``recall`` of these pairs are met. Everything met is verified in double
precision.

Equal vectors are one entry with a count. Members and askers of a cell are compared in chunks, a
task a pair of chunks; a task returns the number of links of each vector and a spanning forest,
never pairs. A pair that meets in two cells counts in the one with the smaller number.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .components import components

SAMPLE = 20_000
TRIALS = 4_000
CHUNK = 512
MAX_WORDS = 1024


def unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def train(points: np.ndarray, words: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Codebook of a half by k-means; words without points move to points far from theirs."""
    rng = np.random.default_rng(seed)
    book = points[rng.choice(len(points), words, replace=False)].copy()
    for _ in range(rounds):
        gap = _distances(points, book)
        own = gap.argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=words)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
        empty = np.flatnonzero(n == 0)
        if len(empty):
            book[empty] = points[np.argsort(gap[np.arange(len(points)), own])[-len(empty) :]]
    return book


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (points * points).sum(1)[:, None] - 2 * points @ book.T + (book * book).sum(1)[None, :])


class Grid:
    """Two codebooks and the reach of the traversal."""

    def __init__(self, first: np.ndarray, second: np.ndarray, reach: float = 0.0):
        self.books = (first, second)
        self.cut = first.shape[1]
        self.reach = reach

    def gaps(self, x: np.ndarray) -> list[np.ndarray]:
        """Per half, squared distances in excess of the nearest word's."""
        out = []
        for half, book in zip((x[:, : self.cut], x[:, self.cut :]), self.books, strict=True):
            d = _distances(half, book)
            out.append(d - d.min(1, keepdims=True))
        return out

    def home(self, gaps: list[np.ndarray]) -> np.ndarray:
        return gaps[0].argmin(1).astype(np.int64) * len(self.books[1]) + gaps[1].argmin(1)

    def visit(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Cells by growing excess, the own one first, until the reach is passed."""
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        a, b = a[first[a] <= self.reach], b[second[b] <= self.reach]
        out, heap, width = [], [(0.0, 0, 0)], len(self.books[1])
        while heap:
            excess, i, j = heapq.heappop(heap)
            if excess > self.reach:
                break
            out.append(int(a[i]) * width + int(b[j]))
            if i + 1 < len(a):
                heapq.heappush(heap, (float(first[a[i + 1]] + second[b[j]]), i + 1, j))
            if i == 0 and j + 1 < len(b):
                heapq.heappush(heap, (float(first[a[0]] + second[b[j + 1]]), 0, j + 1))
        return out

    def calibrate(self, sample: np.ndarray, threshold: float, recall: float, seed: int = 11) -> None:
        """Reach at which ``recall`` of made pairs at the threshold are met, from either side."""
        rng = np.random.default_rng(seed)
        x = sample[rng.integers(0, len(sample), TRIALS)]
        side = rng.standard_normal(x.shape)
        side -= (side * x).sum(1, keepdims=True) * x
        side /= np.sqrt((side * side).sum(1, keepdims=True))
        y = threshold * x + math.sqrt(1 - threshold**2) * side
        gx, gy = self.gaps(x), self.gaps(y)
        rows = np.arange(len(x))
        asked = gx[0][rows, gy[0].argmin(1)] + gx[1][rows, gy[1].argmin(1)]
        asking = gy[0][rows, gx[0].argmin(1)] + gy[1][rows, gx[1].argmin(1)]
        self.reach = float(np.quantile(np.minimum(asked, asking), recall)) + 1e-9


def fit(vectors: DataFrame, n: int, dims: int, threshold: float, recall: float) -> Grid:
    """``vectors``: id, v. Trained on the ``SAMPLE`` vectors with the smallest id digests."""
    rows = vectors.select("v", F.xxhash64("id").alias("h")).orderBy("h").limit(SAMPLE).select("v").collect()
    sample = unit(np.array([r["v"] for r in rows], np.float64))
    words = max(1, min(MAX_WORDS, len(sample) // 4, round(math.sqrt(n / 16))))
    cut = (dims + 1) // 2
    second = sample[:, cut:] if dims > 1 else np.zeros((len(sample), 1))
    grid = Grid(train(sample[:, :cut], words), train(second, words) if dims > 1 else np.zeros((1, 0)))
    grid.calibrate(sample, threshold, recall)
    return grid


def _filed(grid: Grid):
    @F.pandas_udf("array<bigint>")
    def cells(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if not len(batch):
                yield pd.Series([], dtype=object)
                continue
            gaps = grid.gaps(unit(np.stack(batch.to_numpy())))
            yield pd.Series([grid.visit(a, b) for a, b in zip(*gaps, strict=True)])

    return cells


def _compare(threshold: float):
    def compare(block: pd.DataFrame) -> pd.DataFrame:
        """One pair of chunks of one cell: rows on side 0 are members, those on side 1 members and askers."""
        left, right = block[block["side"] == 0], block[block["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        cell = int(left["cell"].iloc[0])
        ids, others = left["id"].to_numpy(), right["id"].to_numpy()
        near = unit(np.stack(left["v"].to_numpy())) @ unit(np.stack(right["v"].to_numpy())).T >= threshold
        member = right["home"].to_numpy() == cell
        near &= np.where(member[None, :], ids[:, None] < others[None, :], True)
        # An asker whose own cell is asked by the member meets it there as well; the smaller cell counts.
        homes = right["home"].to_numpy()
        away = np.flatnonzero(~member & (homes < cell))
        i, j = np.nonzero(near[:, away])
        if len(i):
            cells = left["cells"].to_list()
            rows = np.unique(i)
            asks = pd.MultiIndex.from_arrays([
                np.repeat(rows, [len(cells[k]) for k in rows]), np.concatenate([cells[k] for k in rows])])
            twice = pd.MultiIndex.from_arrays([i, homes[away[j]]]).isin(asks)
            near[i[twice], away[j[twice]]] = False
        copies, other_copies = left["copies"].to_numpy(), right["copies"].to_numpy()
        counts = [(int(i), None, int(n)) for i, n in zip(ids, near @ other_copies, strict=True) if n]
        counts += [(int(i), None, int(n)) for i, n in zip(others, copies @ near, strict=True) if n]
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges = []
        for i in np.flatnonzero(near.any(1)):
            for j in np.flatnonzero(near[i]):
                a, b = root(int(ids[i])), root(int(others[j]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((int(ids[i]), int(others[j]), 0))
        return pd.DataFrame(counts + edges, columns=["a", "b", "n"]).astype({"a": "int64", "b": "Int64", "n": "int64"})

    return compare


def usable(v):
    """Not null or empty, no null or non-finite component, not all zero."""
    parts = v.cast("array<double>")
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & fine & F.exists(parts, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, recall: float = 0.99, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Vectors of different lengths never link; an unusable vector (see ``usable``) stands alone. Rows
    of one id are rows of their own. A null id is named like the smallest long and shown as null.
    """
    # Equal vectors share an entry that goes by their smallest id.
    least = -(1 << 63)
    own = vectors.select(F.coalesce(F.col(vec_id).cast("bigint"), F.lit(least)).alias("id"), F.col(embedding).alias("v"))
    single = own.schema["v"].dataType == T.ArrayType(T.FloatType())  # exact as it is and half the size
    own = own.withColumn("v", F.when(usable(F.col("v")), F.col("v") if single else F.col("v").cast("array<double>")))
    entries = own.where("v is not null").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    entries = stage(entries, "vectors")
    tables = None
    for dims, n in entries.groupBy(F.size("v").alias("dims")).count().collect():  # a row a vector length
        part = entries.where(F.size("v") == dims)
        grid = fit(part, n, dims, threshold, recall)
        filed = stage(part.withColumn("cells", _filed(grid)("v")), "vectors-filed").withColumn("home", F.col("cells")[0])
        members = filed.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("members"))
        asked = filed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("all"))
        sizes = members.join(asked, "cell").where("`all` > 1").select(
            "cell", F.ceil(F.col("members") / CHUNK).cast("int").alias("p"), F.ceil(F.col("all") / CHUNK).cast("int").alias("q"))
        sizes = stage(sizes, "vector-cells")
        rows = filed.select("id", "v", "copies", "cells", "home", F.explode("cells").alias("cell")).join(sizes, "cell")
        h = F.xxhash64("id")
        p, q = F.pmod(h, F.col("p")), F.pmod(h, F.col("q"))
        sides = F.array(F.lit(0), F.lit(1))
        rows = rows.withColumn("side", F.explode(F.when(F.col("home") == F.col("cell"), sides).otherwise(F.array(F.lit(1)))))
        rows = rows.withColumn("x", F.explode(F.when(F.col("side") == 0, F.sequence(F.lit(0), F.col("q") - 1)).otherwise(F.sequence(F.lit(0), F.col("p") - 1))))
        rows = rows.select("cell", "side", "id", "v", "copies", F.when(F.col("side") == 0, F.col("cells")).alias("cells"), "home",
                           F.when(F.col("side") == 0, p).otherwise(F.col("x")).alias("i"), F.when(F.col("side") == 0, F.col("x")).otherwise(q).alias("j"))
        found = rows.groupBy("cell", "i", "j").applyInPandas(_compare(threshold), "a bigint, b bigint, n bigint")
        tables = found if tables is None else tables.unionByName(found)
    if tables is None:
        tables = entries.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0).cast("bigint").alias("n"))
    tables = stage(tables, "vector-links")
    links = tables.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    roots = components(tables.where("b is not null").select("a", "b"))
    known = entries.join(links, entries["id"] == links["a"], "left").join(roots, entries["id"] == roots["node"], "left")
    known = stage(known.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")), "vector-entries")
    out = own.join(known, "v", "left")
    component = F.coalesce("component_id", "id")
    shown = F.when(F.col("id") != least, F.col("id"))
    return out.select(shown.alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.when(component != least, component).alias("component_id"), (F.col("id") == component).alias("kept"))
