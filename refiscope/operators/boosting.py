"""Gradient-boosted trees by histograms, many parameter sets ("trials") grown side by side.

Features are cut into bins once, at quantiles of the training rows; a row becomes one byte per
feature. Rows are staged in blocks of columns, dealt over all cores whatever their size, and every pass
runs over the same RDD of blocks. Trees grow level by level: one pass over the rows adds up gradients and
hessians of all trials by (trial, node, feature, bin), so the number of passes is that of the
longest trial, not of all together. Below the root only the lighter child of every cut is added up, from its drawn rows
alone: the sums of its sibling are what is left of the parent's. Sums of map tasks travel as one array a trial; the
driver gets one such array per trial, whatever the number of rows, and finds the best cut of every node. Categories come as
dense codes, one column of codes for each categorical column; a cut asks whether a row has one code, as an
indicator column would. Where a column has many codes, sums are kept by (node, code) for the codes that occur, meet in blocks
of codes, and the best cuts are found there, so a vocabulary may have any size. The finished
model names only the categories that it asks for. Gradients are whole numbers of 2^-20, so a sum does not depend on its order and a
fit gives the same trees for any partitioning.

Margins are written with the rows every few trees and recomputed from these trees in between: a lost executor
costs its tasks only. They may be made from the last blocks in memory some times before files are written. Validation areas come from the same passes, from counts of
labels in fine score bins; trials that fall behind the median of the others, or do not improve,
stop early.
"""

from __future__ import annotations

import ctypes
import gc
import json
import math
from collections import namedtuple
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import release, stage

BINS = 64
#: Bins in which validation scores are counted.
SCORE_BINS = 4096
#: Trees after which margins are kept anew, and times after which they are kept in files.
TREES_BETWEEN, TIMES_BETWEEN_FILES = 6, 1
#: Partial histograms that are added up in one task.
FAN_IN = 128
#: Rows that travel as one record, at most, and at least if there are as many for every core.
BLOCK_ROWS, SMALL_BLOCK_ROWS = 1 << 16, 256
#: Blocks of one task, when every core has some.
TASK_BLOCKS = 13
#: Levels of a tree that are walked by masks.
_MASKED_LEVELS = 8
#: Sums by node and code are kept for all codes of a column up to so many, beyond it for those that occur.
_DENSE_CODES = 1 << 14
#: Combinations of codes that are added up together, and sums of all tasks that the driver adds up itself.
_JOINT_CODES, _FEW_SUMS = 1 << 10, 1 << 20
_UNIT = float(1 << 20)
_TRAIN, _VALID = 0, 1


@dataclass(frozen=True)
class Params:
    max_depth: int = 3
    learning_rate: float = 0.1
    n_trees: int = 50
    min_child_weight: float = 5.0
    subsample: float = 0.8
    feature_share: float = 0.8
    reg_alpha: float = 0.01
    reg_lambda: float = 1.0


@dataclass
class Tree:
    """A full binary tree by levels: node i has children 2i+1 and 2i+2. A node without a cut (feature -1)
    sends every row to the left; ``value`` is of the lowest level, ``cover`` the hessian of every node.
    Features from ``first_code`` on are codes: rows with the code of the cut go right."""

    feature: np.ndarray
    cut: np.ndarray  # rows with a bin up to it go left
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    first_code: int = 1 << 30

    def leaf_of(self, binned: np.ndarray, levels: int | None = None) -> np.ndarray:
        """Place of every row on a level, from 0."""
        at = np.zeros(len(binned), np.int64)
        rows = np.arange(len(binned))
        depth = len(self.value).bit_length() - 1 if levels is None else levels
        for _ in range(depth):
            f, cut = self.feature[at], self.cut[at]
            cell = binned[rows, np.maximum(f, 0)]
            at = 2 * at + 1 + ((f >= 0) & np.where(f < self.first_code, cell > cut, cell == cut))
        return at - ((1 << depth) - 1)

    def leaf_of_columns(self, cells: Sequence[np.ndarray], levels: int | None = None, n: int | None = None) -> np.ndarray:
        """``leaf_of`` for one array per feature: every node compares its column once and passes on which of the
        rows are its own. ``n``: number of rows, if there may be no feature."""
        n = len(cells[0]) if n is None else n
        depth = len(self.value).bit_length() - 1 if levels is None else levels
        if depth > _MASKED_LEVELS:
            return self.leaf_of(np.stack([c.astype(np.int64) for c in cells], axis=1), levels) if len(cells) else np.zeros(n, np.int64)
        leaf = np.zeros(n, np.uint8)
        feature, cut = self.feature.tolist(), self.cut.tolist()
        nodes: list[tuple[int, np.ndarray | None]] = [(0, None)]  # that rows may be in, None: all of them
        for level in range(depth):
            leaf <<= 1
            below: list[tuple[int, np.ndarray | None]] = []
            for node, own in nodes:
                f = feature[node]
                if f < 0:
                    below.append((2 * node + 1, own))
                    continue
                right = cells[f] > cut[node] if f < self.first_code else cells[f] == cut[node]
                if own is not None:
                    right &= own
                leaf |= right.view(np.uint8)
                if level + 1 < depth:
                    below += [(2 * node + 1, ~right if own is None else own ^ right), (2 * node + 2, right)]
            nodes = below
        return leaf

    def margin(self, binned: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(binned)]


@dataclass
class BoostedModel:
    """Trees over binned features; scores need nothing but this object."""

    features: list[str]
    edges: list[np.ndarray]
    trees: list[Tree]
    params: Params
    valid_auc: float = float("nan")
    #: Features that stand for a category: name -> (column, category).
    indicators: dict[str, tuple[str, str]] = field(default_factory=dict)

    def columns(self, have: Sequence[str] | None = None) -> dict[str, Column]:
        """The features of a row: numbers (null as 0) and indicators (null or unknown as 0). With ``have``,
        columns that are not in it count as 0."""
        out = {}
        for name in self.features:
            source, category = self.indicators.get(name, (name, None))
            if have is not None and source not in have:
                out[name] = F.lit(0.0)
            elif category is None:
                out[name] = F.coalesce(F.col(f"`{source}`").cast("double"), F.lit(0.0))
            else:
                out[name] = F.coalesce((F.col(f"`{source}`").cast("string") == category).cast("double"), F.lit(0.0))
        return out

    def binned(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.edges)

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.margins_of_columns(list(x.T), len(x))

    def margins_of_columns(self, columns: Sequence[np.ndarray], n: int) -> np.ndarray:
        """Margins of ``n`` rows, given as one array per feature."""
        cells = [np.searchsorted(e, np.ascontiguousarray(c), "left").astype(np.uint8) for e, c in zip(self.edges, columns, strict=True)]
        total = np.zeros(n)
        for tree in self.trees:
            total += tree.value.take(tree.leaf_of_columns(cells, n=n))
        return total

    def importances(self) -> list[float]:
        """Share of each feature in the gain of all cuts."""
        gains = np.zeros(len(self.features))
        for t in self.trees:
            np.add.at(gains, t.feature[t.feature >= 0], t.gain[t.feature >= 0])
        return (gains / gains.sum() if gains.sum() else gains).tolist()

    def to_json(self) -> str:
        trees = [{k: v.tolist() for k, v in t.__dict__.items() if k != "first_code"} for t in self.trees]
        return json.dumps({"features": self.features, "edges": [e.tolist() for e in self.edges], "trees": trees, "params": asdict(self.params),
                           "valid_auc": self.valid_auc, "indicators": self.indicators})

    @staticmethod
    def from_json(text: str) -> BoostedModel:
        d = json.loads(text)
        trees = [Tree(*[np.array(t[k], kind) for k, kind in (("feature", np.int64), ("cut", np.int64), ("value", float), ("cover", float), ("gain", float))]) for t in d["trees"]]
        edges = [np.array(e, float) for e in d["edges"]]
        return BoostedModel(d["features"], edges, trees, Params(**d["params"]), d["valid_auc"], {k: tuple(v) for k, v in d["indicators"].items()})


def matrix(features: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features])


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of every value; a value on an edge belongs below it."""
    return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)], axis=1).astype(np.uint8) if len(edges) else np.zeros((len(x), 0), np.uint8)


def bin_edges(train: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins`` - 1 edges per feature, at quantiles of the rows; one aggregation of sketches."""
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins fit in a byte")
    at = [k / bins for k in range(1, bins)]
    cuts = [F.percentile_approx(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)), at, 20 * bins).alias(f"q{k}") for k, c in enumerate(features)]
    tops = [F.max(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))).alias(f"m{k}") for k, c in enumerate(features)]
    row = train.agg(*cuts, *tops).first()
    # The largest value is no edge: nothing lies above it.
    return [np.array(sorted({q for q in row[f"q{k}"] or [] if q < row[f"m{k}"]}), float) for k in range(len(features))]


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) drawn from keys."""
    with np.errstate(over="ignore"):
        z = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)


@dataclass
class Trial:
    """What is known of one parameter set while it grows."""

    number: int
    params: Params
    seed: int
    trees: list[Tree] = field(default_factory=list)
    areas: list[float] = field(default_factory=list)  # validation area after each tree
    active: bool = True
    why: str = ""
    growing: Tree | None = None
    sums: dict[int, tuple[float, float]] = field(default_factory=dict)  # gradient and hessian of open nodes
    held: dict[int, np.ndarray] = field(default_factory=dict)  # sums of the last level by feature, all numbers at 0

    def salt(self, what: int) -> int:
        return (self.seed * 1_000_003 + self.number) * 1_000_003 + 2 * len(self.trees) + what

    def chosen(self, n_features: int) -> np.ndarray:
        """Features of the tree that grows now, the same on every level."""
        rng = np.random.default_rng(self.salt(1))
        return np.sort(rng.choice(n_features, max(1, round(self.params.feature_share * n_features)), replace=False))

    def totals(self, level: int) -> np.ndarray:
        """Gradient and hessian of the nodes of a level."""
        out = np.zeros((1 << level, 2))
        for node, sums in self.sums.items():
            out[node - ((1 << level) - 1)] = sums
        return out

    def counted(self, level: int) -> np.ndarray:
        """Nodes of a level whose rows are added up: of the children of every cut the lighter one."""
        tree, first = self.growing, (1 << level) - 1
        cut = np.flatnonzero(tree.feature[first >> 1 : first] >= 0)
        left = 2 * cut
        return left + (tree.cover[first + left] > tree.cover[first + left + 1])

    def best(self) -> int:
        """Trees through the best validation area."""
        return int(np.argmax(self.areas)) + 1 if self.areas else len(self.trees)


@dataclass(frozen=True)
class _Work:
    """What a pass needs of one trial: trees since margins were written, the tree that grows, its features."""

    number: int
    params: Params
    since: tuple[Tree, ...]
    growing: Tree | None  # None where cuts are found
    levels: int
    chosen: np.ndarray
    salt: int
    measure: bool
    totals: np.ndarray | None  # of the level's nodes; None: only the root's sums are asked for
    counted: np.ndarray | None = None  # nodes whose rows are added up, None: all

    @property
    def nodes(self) -> int:
        return 1 << self.levels if self.counted is None else len(self.counted)


Sums = dict[tuple[int, int, int], np.ndarray]  # by trial, feature and block of codes
_AREA, _ROOT = -1, -2  # in place of a feature: label counts by score, sums of the root
_JOINED = -3  # in place of a feature: all sums of a trial that have a fixed size, in one array
_CODE_BITS = 32
_BLOCK_BITS = 12  # codes of one block
_EVERY = -1  # in place of node and code: all rows of the root


def _by_code(node: np.ndarray, code: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Rows key (node and code), gradient, hessian; one column per key that occurs."""
    span = int(code.max()) + 1 if len(code) else 1
    size = (int(node.max()) + 1) * span if len(code) else 0
    if size <= 4 * len(code):  # few codes: count in place of a sort
        at = node * span + code
        there = np.flatnonzero(np.bincount(at, minlength=size))
        key = there // span << _CODE_BITS | there % span
        return np.stack([key, np.bincount(at, g, size)[there].astype(np.int64), np.bincount(at, h, size)[there].astype(np.int64)])
    key, at = np.unique(node << _CODE_BITS | code, return_inverse=True)
    return np.stack([key, np.bincount(at, g, len(key)).astype(np.int64), np.bincount(at, h, len(key)).astype(np.int64)])


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    if len(parts) == 1:
        return parts[0]
    every = np.concatenate(parts, axis=1)
    every = every[:, np.argsort(every[0], kind="stable")]
    first = np.flatnonzero(np.append(True, every[0, 1:] != every[0, :-1])) if every.shape[1] else np.zeros(0, np.int64)
    return np.stack([every[0, first], *(np.add.reduceat(row, first) for row in every[1:])]) if len(first) else every


def _code_type(span: int) -> str:
    """Type of a column of codes in a block; ``span`` itself stands for no code."""
    return "u1" if span < 1 << 8 else "<u2" if span < 1 << 16 else "<i4"


class _Block:
    """Rows that travel together, those of the train split first: one array per column, cells by feature
    (bins, then codes)."""

    def __init__(self, r: Row | tuple, n_numeric: int, spans: Sequence[int]):
        row_keys, self.n_train, labels, weights, bins, codes, margins = r
        self.keys, self.label, self.weight = np.frombuffer(row_keys, "<u8"), np.frombuffer(labels, np.uint8), np.frombuffer(weights, "<f8")
        self.n = len(self.keys)
        self.bins = np.frombuffer(bins, np.uint8).reshape(n_numeric, self.n)
        self.codes, at = [], 0
        for kind in map(np.dtype, map(_code_type, spans)):
            self.codes.append(np.frombuffer(codes, kind, self.n, at))
            at += self.n * kind.itemsize
        self.margins = np.frombuffer(margins, "<f4").reshape(-1, self.n)

    def cells(self, rows: slice | np.ndarray) -> list[np.ndarray]:
        if isinstance(rows, slice):
            return [*self.bins[:, rows], *(c[rows] for c in self.codes)]
        return [*self.bins.take(rows, axis=1), *(c.take(rows) for c in self.codes)]

    def margin(self, given: int, trees: Sequence[Tree], cells: list[np.ndarray], rows: slice | np.ndarray = slice(None)) -> np.ndarray:
        """Margins of rows, whose cells are given."""
        out = self.margins[given][rows].astype(float)
        for tree in trees:
            out += tree.value.take(tree.leaf_of_columns(cells, n=len(out)))
        return out

    def probability(self, *of) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(*of)))


_settled = False  # whether this process is set up for passes


def settle() -> None:
    """Sets up a Python worker, once. It collects garbage after every task: what it has imported is taken out of that, as
    looking through it takes longer than the task of a small table. Arrays of a block come from the heap, which keeps
    up to 64 MB: by default each would be mapped and its pages zeroed anew, which takes longer than filling it."""
    global _settled
    if not _settled:
        _settled = True
        gc.freeze()
        try:
            mallopt = ctypes.CDLL(None).mallopt  # of the GNU C library
        except (AttributeError, OSError, TypeError):
            return
        mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
        mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD


def _pieces(w: _Work, n_numeric: int, bins: int, spans: list[int]) -> list[tuple[int, int]]:
    """Feature and size of everything that has a place in a trial's joined array: label counts by score, sums of
    the root, gradients then hessians by node and bin, the same by node and code where these are few."""
    codes = [(f, 2 * w.nodes * (span + 1)) for f, span in enumerate(spans, n_numeric) if _few(span, w.levels)]
    return [*[(_AREA, 2 * SCORE_BINS)] * w.measure, *[(_ROOT, 2)] * (w.totals is None), *((f, 2 * w.nodes * bins) for f in w.chosen.tolist()), *codes]


def _few(span: int, level: int) -> bool:
    return (span + 1) << level <= _DENSE_CODES


def _drawn_codes(w: _Work, feature: int, code: np.ndarray) -> np.ndarray:
    """Which codes of a column the growing tree may ask for."""
    return _mixed((code | feature << 40).astype(np.uint64), w.salt + 1) < w.params.feature_share


def _histograms(work: list[_Work], column: dict[int, int], n_numeric: int, bins: int, spans: list[int]):
    """Per map task and trial: sums by node and bin, or by node and code, joined; per (trial, feature, block): sums
    of columns with many codes. ``spans``: of every column of codes, how many there may be."""
    pieces = {w.number: _pieces(w, n_numeric, bins, spans) for w in work}
    place = {}  # of a level's node among those that count
    for w in work:
        place[w.number] = np.full(1 << w.levels, -1, np.int8 if w.levels < 8 else np.int64)
        place[w.number][slice(None) if w.counted is None else w.counted] = np.arange(w.nodes)
    few = [f for f, span in enumerate(spans, n_numeric) if all(_few(span, w.levels) for w in work)]
    shape = [spans[f - n_numeric] + 1 for f in few]
    together = few if len(few) > 1 and math.prod(shape) <= _JOINT_CODES else []  # columns whose combinations are few

    def by_cell(cell: np.ndarray, gh: np.ndarray, size: int) -> np.ndarray:
        """Gradients, then hessians; a complex number holds a row's both, so that they are added in one go."""
        out = np.zeros(size, complex)
        np.add.at(out, cell, gh)
        return out.view(float).reshape(size, 2).T

    def of(rows: Iterator[Row | tuple]) -> Iterator[tuple[tuple[int, int, int], np.ndarray]]:
        settle()
        joined = {number: np.zeros(sum(size for _, size in own), np.int64) for number, own in pieces.items()}
        by_code: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in rows:
            block = _Block(r, n_numeric, spans)
            train, valid = slice(0, block.n_train), slice(block.n_train, None)
            own, of_valid = block.cells(train), block.cells(valid)
            keys, joint = block.keys[train], np.zeros(0, np.uint16)
            for i, f in enumerate(together):
                joint = own[f].astype(np.uint16) if i == 0 else joint * np.uint16(shape[i]) + own[f]
            for w in work:
                # The drawn rows of the nodes that count, and only these.
                if w.levels:
                    node = place[w.number].take(w.growing.leaf_of_columns(own, w.levels, block.n_train))
                    at = np.flatnonzero(node >= 0)
                    at = at[_mixed(keys.take(at), w.salt) < w.params.subsample]
                    node = node.take(at).astype(np.intp)
                else:
                    at = np.flatnonzero(_mixed(keys, w.salt) < w.params.subsample)
                    node = np.zeros(len(at), np.intp)
                cells, weight = block.cells(at), block.weight.take(at)
                p = block.probability(column[w.number], w.since, cells, at)
                g = np.rint(weight * (p - block.label.take(at).astype(float)) * _UNIT)
                h = np.rint(weight * p * (1.0 - p) * _UNIT)
                gh = np.empty(len(at), complex)
                gh.real, gh.imag = g, h
                by_joint = {}
                if together:
                    size = w.nodes * math.prod(shape)
                    sums = by_cell(node * math.prod(shape) + joint.take(at), gh, size).reshape(2, w.nodes, *shape)
                    by_joint = {f: sums.sum(axis=tuple(k for k in range(2, 2 + len(shape)) if k != 2 + i)) for i, f in enumerate(together)}
                first, whole, start = node * bins, joined[w.number], 0
                for f, size in pieces[w.number]:
                    if f == _AREA:
                        score = np.minimum((block.probability(column[w.number], w.since, of_valid, valid) * SCORE_BINS).astype(np.int64), SCORE_BINS - 1)
                        found = np.bincount(score * 2 + block.label[valid], minlength=size)
                    elif f == _ROOT:
                        found = np.array([g.sum(), h.sum()])
                    elif f in by_joint:
                        found = by_joint[f]
                    else:
                        found = by_cell(first + cells[f] if f < n_numeric else node * (spans[f - n_numeric] + 1) + cells[f], gh, size >> 1)
                    whole[start : start + size] += found.astype(np.int64).reshape(-1)
                    start += size
                for f in {*range(n_numeric, len(own))}.difference(f for f, _ in pieces[w.number]):
                    slot = cells[f].astype(np.int64)
                    with_code = np.flatnonzero(slot < spans[f - n_numeric])
                    held = by_code.setdefault((w.number, f), [])
                    held.append(_by_code(node[with_code], slot[with_code], g[with_code], h[with_code]))
                    if len(held) >= 64:
                        held[:] = [_merged(held)]
        yield from (((number, _JOINED, 0), whole) for number, whole in joined.items())
        trials = {w.number: w for w in work}
        for (trial, f), held in by_code.items():
            w, whole = trials[trial], _merged(held)
            whole = whole[:, _drawn_codes(w, f, whole[0] & ((1 << _CODE_BITS) - 1))]
            block = (whole[0] & ((1 << _CODE_BITS) - 1)) >> _BLOCK_BITS
            root = [size for feature, size in pieces[trial] if feature in (_AREA, _ROOT)]
            for b in np.unique(block).tolist() if w.totals is not None else range(((spans[f - n_numeric] - 1) >> _BLOCK_BITS) + 1):
                part = whole[:, block == b]
                if w.totals is None:  # every block learns the root's sums
                    part = np.concatenate([np.array([[_EVERY], *joined[trial][sum(root) - 2 : sum(root)].reshape(2, 1)], np.int64), part], axis=1)
                yield (trial, f, b), part

    return of


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of one key from two tasks: by place, or by node and code."""
    return a + b if a.ndim == 1 else _merged([a, b])


def _soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


_CUTS = ["trial", "feature", "node", "cut", "gain", "gl", "hl", "g", "h"]
_Cut = namedtuple("_Cut", _CUTS)


def _gains(gl: np.ndarray, hl: np.ndarray, gt: np.ndarray, ht: np.ndarray, p: Params) -> np.ndarray:
    worth = lambda a, b: _soft(a, p.reg_alpha) ** 2 / (b + p.reg_lambda)
    gain = worth(gl, hl) + worth(gt - gl, ht - hl) - worth(gt, ht)
    gain[(hl < p.min_child_weight) | (ht - hl < p.min_child_weight)] = -np.inf
    return gain


def _table(trial: int, feature, node, cut, gain, gl, hl, gt, ht) -> np.ndarray:
    out = np.stack([np.full(len(node), trial), np.broadcast_to(feature, len(node)), node, cut, gain, gl, hl, gt, ht], axis=1)
    return out[ht > 0]


def _cuts_by_code(w: _Work, feature: int, totals: np.ndarray, key: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The best cut of every node; rows with the code go right."""
    node, cut = key >> _CODE_BITS, key & ((1 << _CODE_BITS) - 1)
    gt, ht = totals[node].T
    gl, hl = gt - g / _UNIT, ht - h / _UNIT
    gain = _gains(gl, hl, gt, ht, w.params)
    best = np.lexsort((cut, -gain, node))
    best = best[np.append(True, node[best][1:] != node[best][:-1])] if len(best) else best
    return _table(w.number, feature, *(x[best] for x in (node, cut, gain, gl, hl, gt, ht)))


def _cuts_by_bin(w: _Work, sums: np.ndarray) -> np.ndarray:
    """The same for all chosen numbers at once; sums by feature, gradient or hessian, node and bin."""
    sums = np.cumsum(sums / _UNIT, axis=3)
    gl, hl = (sums[:, k].reshape(-1, sums.shape[3]) for k in (0, 1))
    gt, ht = gl[:, -1:], hl[:, -1:]
    gain = _gains(gl, hl, gt, ht, w.params)
    cut, row = np.argmax(gain, axis=1), np.arange(len(gain))
    return _table(w.number, np.repeat(w.chosen, 1 << w.levels), row % (1 << w.levels), cut, gain[row, cut], gl[row, cut], hl[row, cut], gt[:, 0], ht[:, 0])


def _best_cuts(work: list[_Work]):
    """Of every (trial, feature, block) with many codes: the best cut of every node. Joined sums stay."""
    by_trial = {w.number: w for w in work}

    def cuts(trial: int, feature: int, total: np.ndarray) -> np.ndarray:
        w = by_trial[trial]
        if feature == _JOINED:
            return total
        if w.totals is None:
            return _cuts_by_code(w, feature, total[1:, :1].T / _UNIT, *total[:, 1:])
        return _cuts_by_code(w, feature, w.totals, *total)

    return lambda item: cuts(item[0][0], item[0][1], item[1])


def _with_siblings(w: _Work, part: np.ndarray, parents: np.ndarray | None) -> np.ndarray:
    """Sums of all nodes of a level (the last axis but one) from those of the nodes that were counted. Rows of a
    node without a cut are those of its left child."""
    if w.counted is None:
        return part
    out = np.zeros((*part.shape[:-2], 1 << w.levels, part.shape[-1]), np.int64)
    out[..., ::2, :] = parents
    out[..., w.counted, :] = part
    out[..., w.counted ^ 1, :] = parents[..., w.counted >> 1, :] - part
    return out


def _cuts_of(w: _Work, trial: Trial, total: np.ndarray, n_numeric: int, bins: int, spans: list[int]) -> np.ndarray:
    """From a trial's joined sums: the best cuts of every node by feature, the validation area and the root's
    sums. The trial keeps the level's sums for the next one."""
    out, at, totals, held = [], 0, w.totals, {}
    for f, size in _pieces(w, n_numeric, bins, spans):
        piece = total[at : at + size]
        if f == _AREA:
            out.append([[w.number, _AREA, 0, 0, _area(piece.reshape(-1, 2)), 0, 0, 0, 0]])
        elif f == _ROOT:
            totals = piece[None, :] / _UNIT
            out.append([[w.number, _ROOT, 0, 0, 0, 0, 0, *totals[0]]])
        elif f < n_numeric:
            if f == w.chosen[0]:
                numbers = total[at : at + size * len(w.chosen)].reshape(len(w.chosen), 2, w.nodes, bins)
                held[0] = _with_siblings(w, numbers, trial.held.get(0))
                out.append(_cuts_by_bin(w, held[0]))
        else:
            held[f] = _with_siblings(w, piece.reshape(2, w.nodes, -1), trial.held.get(f))
            sums = held[f][:, :, :-1]
            node, code = np.nonzero(sums.any(axis=0))  # what sums to nothing is no cut
            drawn = _drawn_codes(w, f, code)
            node, code = node[drawn], code[drawn]
            out.append(_cuts_by_code(w, f, totals, node << _CODE_BITS | code, *sums[:, node, code]))
        at += size
    trial.held = held
    return np.concatenate(out)


def _better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the cuts from two blocks of codes: the best of every node."""
    both = np.concatenate([a, b])
    both = both[np.lexsort((both[:, 3], -both[:, 4], both[:, 2]))]
    return both[np.append(True, both[1:, 2] != both[:-1, 2])] if len(both) else both


def _area(counts: np.ndarray) -> float:
    """ROC area from label counts by rising score; equal bins count one half."""
    neg, pos = counts[:, 0].astype(float), counts[:, 1].astype(float)
    if not neg.sum() or not pos.sum():
        return float("nan")
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / (neg.sum() * pos.sum()))


def _pass(blocks: RDD, work: list[_Work], column: dict[int, int], n_numeric: int, bins: int, spans: list[int]) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """One job over the blocks: every trial's joined sums, and the best cuts of columns with many codes, in the columns ``_CUTS``."""
    tasks = blocks.getNumPartitions()
    sums = blocks.mapPartitions(_histograms(work, column, n_numeric, bins, spans))
    plain = all(_few(span, w.levels) for w in work for span in spans)
    if plain and tasks * sum(size for w in work for _, size in _pieces(w, n_numeric, bins, spans)) <= _FEW_SUMS:
        whole: dict[int, np.ndarray] = {}
        for (number, _, _), part in sums.collect():
            whole[number] = whole[number] + part if number in whole else part
        return whole, np.zeros((0, len(_CUTS)))
    while tasks > FAN_IN:  # partial sums of many map tasks meet in groups first
        spread, tasks = min(tasks, FAN_IN), math.ceil(tasks / FAN_IN)
        parts = sums.mapPartitionsWithIndex(lambda i, items, groups=tasks: (((key, i % groups), v) for key, v in items))
        sums = parts.reduceByKey(_add, spread).map(lambda item: (item[0][0], item[1]))
    meet = max(1, min(tasks, len(work)))
    place = {w.number: i for i, w in enumerate(work)}  # one trial to a task, its blocks of codes to the next ones
    met = sums.reduceByKey(_add, meet, lambda key: place[key[0]] + key[2])
    if not plain:
        asked = [replace(w, since=(), growing=None) for w in work]
        met = met.map(lambda item, best=_best_cuts(asked): (item[0][:2], best(item)))
        if max(spans) > 1 << _BLOCK_BITS:  # of the blocks of one column the best cut of a node is enough
            met = met.reduceByKey(_better, meet)
    found = met.collect()  # no rows of data, and no row per code of a column with many
    return {key[0]: v for key, v in found if key[1] == _JOINED}, np.concatenate([np.zeros((0, len(_CUTS))), *(v for key, v in found if key[1] != _JOINED)])


def _start(trial: Trial, n_numeric: int) -> Tree:
    d = trial.params.max_depth
    inner = (1 << d) - 1
    return Tree(np.full(inner, -1, np.int64), np.zeros(inner, np.int64), np.zeros(1 << d), np.zeros(2 * inner + 1), np.zeros(inner), n_numeric)


def _grow(trial: Trial, level: int, cuts: np.ndarray) -> None:
    """Sets the cuts of one level and the sums of its children; leaves get their values."""
    tree, p = trial.growing, trial.params
    first = (1 << level) - 1
    cuts = cuts[(cuts[:, 0] == trial.number) & (cuts[:, 1] >= 0)]
    cuts = cuts[np.lexsort((cuts[:, 3], cuts[:, 1], -cuts[:, 4], cuts[:, 2]))]
    if level == 0:
        tree.cover[0] = trial.sums.get(0, (0.0, 0.0))[1]
    by_node: dict[int, _Cut] = {}
    for row in cuts[np.append(True, cuts[1:, 2] != cuts[:-1, 2])] if len(cuts) else ():
        r = _Cut(*row.tolist())
        by_node[int(r.node) + first] = r
    after: dict[int, tuple[float, float]] = {}
    for node, (g, h) in trial.sums.items():
        r = by_node.get(node)
        if r is not None and math.isfinite(r.gain) and r.gain > 1e-9:
            tree.feature[node], tree.cut[node], tree.gain[node] = int(r.feature), int(r.cut), r.gain
            after[2 * node + 1], after[2 * node + 2] = (r.gl, r.hl), (g - r.gl, h - r.hl)
        else:
            after[2 * node + 1] = (g, h)
        for child in (2 * node + 1, 2 * node + 2):
            if child in after:
                tree.cover[child] = after[child][1]
    trial.sums = after
    if level == p.max_depth - 1:
        for node, (g, h) in after.items():
            tree.value[node - ((1 << p.max_depth) - 1)] = -float(_soft(np.array(g), p.reg_alpha)) / (h + p.reg_lambda) * p.learning_rate
        trial.trees.append(tree)
        trial.growing = None


_BLOCK_DDL = "row_keys binary, n_train int, labels binary, weights binary, bins binary, codes binary, margins binary"


def _prepared(rows: DataFrame, features: Sequence[str], edges: list[np.ndarray], codes: Sequence[str], spans: Sequence[int], n_trials: int, label: str, weight: str, key: str) -> DataFrame:
    """The rows in blocks, dealt over the tasks of a pass: one for each core, more when they hold many rows."""
    part = F.when(F.col("split") == "train", _TRAIN).otherwise(_VALID)
    used = rows.where(F.col("split").isin("train", "valid") & F.col(label).isNotNull())
    given = used.select(
        F.xxhash64(F.col(key).cast("string")).alias("row_key"), part.alias("part"), F.col(label).cast("int").alias("label"),
        (F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight in rows.columns else F.lit(1.0)).alias("weight"),
        *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features)],
        *[F.coalesce(F.col(f"`{c}`").cast("int"), F.lit(span)).alias(f"c{i}") for i, (c, span) in enumerate(zip(codes, spans, strict=True))])
    cores, n = rows.sparkSession.sparkContext.defaultParallelism, used.count()
    size = min(BLOCK_ROWS, max(SMALL_BLOCK_ROWS, math.ceil(n / cores)))
    blocks = max(1, math.ceil(n / size))
    tasks = max(min(blocks, cores), math.ceil(blocks / TASK_BLOCKS))
    kinds = ["<i8", "u1", "u1", "<f8", *["u1"] * len(edges), *map(_code_type, spans)]

    def arrays(batch: pd.DataFrame) -> list[np.ndarray]:
        columns = [batch.iloc[:, i].to_numpy() for i in range(len(kinds))]
        columns[4 : 4 + len(edges)] = [np.searchsorted(e, c, "left") for e, c in zip(edges, columns[4:], strict=False)]
        return [c.astype(kind) for c, kind in zip(columns, kinds, strict=True)]

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list[np.ndarray]] = []
        there = 0

        def whole(last: bool) -> Iterator[pd.DataFrame]:
            """The rows that are held, in blocks; what is less than a block waits for more."""
            nonlocal held, there
            every = [np.concatenate(parts) for parts in zip(*held, strict=True)]
            at = 0
            while there - at >= size or last and at < there:
                own = [c[at : at + size] for c in every]
                order = np.argsort(own[1], kind="stable")
                keys, _, labels, weights, *cells = [c.take(order) for c in own]
                joined = [b"".join(c.tobytes() for c in some) for some in (cells[: len(edges)], cells[len(edges) :])]
                yield pd.DataFrame([[keys.tobytes(), int(np.count_nonzero(own[1] == _TRAIN)), labels.tobytes(), weights.tobytes(), *joined, bytes(4 * n_trials * len(order))]],
                                   columns=[c.split()[0] for c in _BLOCK_DDL.split(", ")])
                at += len(order)
            held, there = [[c[at:] for c in every]], there - at

        for batch in batches:
            held.append(arrays(batch))
            there += len(batch)
            if there >= size:
                yield from whole(False)
        if there:
            yield from whole(True)

    return given.repartition(tasks).mapInPandas(packed, _BLOCK_DDL)


#: Trees of the trials that go on since margins were last kept, and the place that their margins have there.
_Step = tuple[dict[int, tuple[Tree, ...]], dict[int, int]]


def _new_margins(r: Row | tuple, steps: Sequence[_Step], n_numeric: int, spans: Sequence[int]) -> bytes:
    """Margins of a block after some steps, of the last one's trials alone and in their order."""
    block = _Block(r, n_numeric, spans)
    cells = block.cells(slice(None))
    for since, column in steps:
        block.margins = np.stack([block.margin(column[number], trees, cells).astype("<f4") for number, trees in since.items()])
    return block.margins.tobytes()


def _with_margins(table: DataFrame, steps: Sequence[_Step], n_numeric: int, spans: Sequence[int]) -> DataFrame:
    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(margins=[_new_margins(r, steps, n_numeric, spans) for r in batch.itertuples(index=False)])

    return table.mapInPandas(added, _BLOCK_DDL)


def _kept(blocks: RDD) -> RDD:
    """Every pass reads the blocks: executors keep them as bytes, what is lost is made from the files again."""
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def _blocks(table: DataFrame) -> RDD:
    return table.rdd.map(lambda r: tuple(bytes(v) if isinstance(v, bytearray) else v for v in r))


def _moved(blocks: RDD, step: _Step, n_numeric: int, spans: Sequence[int]) -> RDD:
    def moved(rows: Iterator[tuple]) -> Iterator[tuple]:
        settle()
        return ((*r[:-1], _new_margins(r, [step], n_numeric, spans)) for r in rows)

    return blocks.mapPartitions(moved)


@dataclass(frozen=True)
class Stopping:
    """A trial ends after ``patience`` trees without a better area, or if its area at one of the rungs is
    below the median of all trials at that rung."""

    patience: int = 25
    rungs: tuple[int, ...] = (10, 20, 40, 80, 160)


def _judge(trials: list[Trial], stopping: Stopping) -> None:
    for t in trials:
        n = len(t.areas)
        if not t.active or not n:
            continue
        if n in stopping.rungs:
            others = [max(o.areas[:n]) for o in trials if len(o.areas) >= n]
            if max(t.areas) < float(np.median(others)):
                t.active, t.why = False, "median"
        if n - t.best() >= stopping.patience:
            t.active, t.why = False, "patience"
        if n >= t.params.n_trees:
            t.active, t.why = False, t.why or "complete"
    for t in trials:  # whose areas are not known
        if t.active and len(t.trees) >= t.params.n_trees:
            t.active, t.why = False, "complete"


def fit_trials(rows: DataFrame, features: Sequence[str], params: Sequence[Params], label: str, weight: str = "weight", key: str = "loan_id",
               seed: int = 42, bins: int = BINS, stopping: Stopping = Stopping(), codes: Sequence[str] = ()) -> tuple[list[Trial], list[np.ndarray]]:
    """Grow all trials on the rows of split 'train', measured on 'valid'; returns them with the bin edges.

    ``features`` are numbers, ``codes`` columns of whole numbers from 0 that name a category, null for none.
    Rows with another split or a null label are left out; a null or absent weight counts as 1 and a null
    feature as 0. Without training rows every tree is empty; without both labels in 'valid' no area is
    known and every trial runs to its end. Rows that are equal are drawn alike.
    """
    features, n_numeric = list(features), len(features)
    edges = bin_edges(rows.where("split = 'train'"), features, bins)
    trials = [Trial(i, p, seed) for i, p in enumerate(params)]
    column = {t.number: t.number for t in trials}
    most = rows.agg(*[F.max(f"`{c}`").cast("int") for c in codes]).first() if codes else ()
    spans = [(m or 0) + 1 for m in most]
    table = stage(_prepared(rows, features, edges, codes, spans, len(trials), label, weight, key), "boosting-rows")
    blocks = _kept(_blocks(table))
    older: list[RDD] = []  # not read any more once the next pass is done
    steps: list[_Step] = []  # since the table was written
    written = {t.number: 0 for t in trials}

    def run(now: list[Trial], level: int) -> np.ndarray:
        part = level and all(_few(span, level) for span in spans)  # sums of a column with many codes are not kept
        work = [_Work(t.number, t.params, tuple(t.trees[written[t.number] :]), t.growing, level, t.chosen(n_numeric), t.salt(0),
                      level == 0 and bool(t.trees), t.totals(level) if level else None, t.counted(level) if part else None) for t in now]
        asked = [w for w in work if w.nodes]  # a tree without a cut on the level above has nothing to count
        sums, cuts = _pass(blocks, asked, column, n_numeric, bins, spans) if asked else ({}, np.zeros((0, len(_CUTS))))
        return np.concatenate([cuts, *(_cuts_of(w, trials[w.number], sums[w.number], n_numeric, bins, spans) for w in asked)])

    while True:
        now = [t for t in trials if t.active]
        for t in now:
            t.growing, t.sums, t.held = _start(t, n_numeric), {}, {}
        cuts = run(now, 0)  # areas of the trees so far; roots of the next ones and their cuts
        while older:
            older.pop().unpersist()
        for r in map(_Cut._make, cuts[cuts[:, 1] < 0].tolist()):
            t = trials[int(r.trial)]
            if r.feature == _AREA and math.isfinite(r.gain):
                t.areas.append(r.gain)
            elif r.feature == _ROOT and r.h > 0:
                t.sums = {0: (r.g, r.h)}
        _judge(trials, stopping)
        now = [t for t in now if t.active]
        if not now:
            break
        for level in range(max(t.params.max_depth for t in now)):
            deep = [t for t in now if level < t.params.max_depth]
            if level:
                cuts = run(deep, level)
            for t in deep:
                _grow(t, level, cuts)
        if max(len(t.trees) - written[t.number] for t in now) >= TREES_BETWEEN:
            steps.append(({t.number: tuple(t.trees[written[t.number] :]) for t in now}, column))
            older.append(blocks)
            if len(steps) < TIMES_BETWEEN_FILES:
                blocks = _kept(_moved(blocks, steps[-1], n_numeric, spans))
            else:
                old, table = table, stage(_with_margins(table, steps, n_numeric, spans), "boosting-rows")
                blocks, steps = _kept(_blocks(table)), []
                release(old)
            column = {t.number: i for i, t in enumerate(now)}
            written |= {t.number: len(t.trees) for t in now}
    blocks.unpersist()
    release(table)
    return trials, edges


def model_of(trial: Trial, features: Sequence[str], edges: list[np.ndarray], codes: Sequence[str] = (), vocabulary: DataFrame | None = None) -> BoostedModel:
    """The trial's trees through its best validation area. Codes that they ask for become indicator
    features; their categories are read from ``vocabulary`` (column_name, category, code), at most one a cut."""
    n = trial.best()
    area = trial.areas[n - 1] if trial.areas else float("nan")
    asked = sorted({(int(f), int(c)) for t in trial.trees[:n] for f, c in zip(t.feature, t.cut, strict=True) if f >= t.first_code})
    names: dict[tuple[int, int], tuple[str, str]] = {}
    if asked:
        rows = vocabulary.where(F.col("code").isin(sorted({c for _, c in asked}))).select("column_name", "category", "code").collect()
        known = {int(r["code"]): (r["column_name"], r["category"]) for r in rows}
        names = {key: known[key[1]] for key in asked}
    place = {key: len(features) + i for i, key in enumerate(asked)}
    trees = []
    for t in trial.trees[:n]:
        feature, cut = t.feature.copy(), t.cut.copy()
        for i in np.flatnonzero(feature >= t.first_code):
            feature[i], cut[i] = place[int(t.feature[i]), int(t.cut[i])], 0
        trees.append(Tree(feature, cut, t.value, t.cover, t.gain))
    indicators = {f"{column}_{category}": (column, category) for column, category in names.values()}
    return BoostedModel([*features, *indicators], [*edges, *[np.zeros(1)] * len(asked)], trees, trial.params, area, indicators)


def probability(model: BoostedModel, have: Sequence[str] | None = None) -> Column:
    """Probability of label 1 from the model's columns, in Arrow batches; see ``BoostedModel.columns``."""

    columns = list(model.columns(have).values())

    @F.arrow_udf("double")
    def scored(*xs: pa.Array) -> pa.Array:
        settle()
        margins = model.margins_of_columns([x.to_numpy(zero_copy_only=False) for x in xs[: len(model.features)]], len(xs[0]))
        return pa.array(1.0 / (1.0 + np.exp(-margins)))

    return scored(*(columns or [F.lit(0.0)]))
