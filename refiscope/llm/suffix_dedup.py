"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A suffix is cut off after ``length`` bytes (400). Suffixes go to buckets by the least hashed
64-byte window among those 400 bytes (shorter for strings under 128): equal suffixes have equal windows at equal places, so each
bucket can be sorted by itself. Neighbouring suffixes of a text share the window, which makes runs
("contexts") of suffixes around one anchor; a context whose bytes occur twice is settled as a whole,
and a bucket of one context cannot repeat. What is left are the contexts at the edges of repeats.

One bucket at a time they are sorted, but for suffixes whose first and last bytes occur once. Ties after the first bytes are not compared byte by byte:
ranks of a difference-cover sample, those positions whose offset modulo 21 is in {0, 1, 4, 14, 16},
are sorted first, by the 378 bytes from each of them: strings of 21 bytes get their rank in the order
of bytes, and pairs of ranks are doubled, as a step of 21 bytes leads from one sample position to the
next of the same kind. From any two suffixes the same step of at most 20 bytes leads to two sample
positions; contexts are laid out with their anchors at offset 0, so suffixes that can be equal have
equal offsets and the step is one table look-up. First 21 bytes, sample rank and last 22 bytes order
the 400 bytes, byte by byte without a digest. Memory is bounded by the bucket; a bucket of more than
``BUCKET`` different contexts is settled by counting its suffixes' digests with Spark instead.

Contexts that repeat as a whole, and suffixes of such large buckets, are told apart by 64-bit digests
inside one bucket.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import release, stage
from . import word_windows
from .base import small_batches

#: Bytes of the window that names a bucket are two to this power, fewer for short strings.
WINDOW_POWER = 6
COVER = (0, 1, 4, 14, 16)
PERIOD = 21
#: Steps from an offset to the next position of the cover.
STEPS = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
BUCKET = 8192
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_STARTS_AT_ONCE = 1 << 20
#: Short texts are digested together, in buffers of about so many bytes.
_BYTES_AT_ONCE = 1 << 16
_TEXTS_AT_ONCE = 256
#: Place of the cover's rank among the columns, after the part and the columns of the first bytes.
_RANKED = 4
_PLACE = np.uint64((1 << 21) - 1)
_CONTEXTS_AT_ONCE = 512
_MUL_A = np.uint64(0x9E3779B97F4A7C15)
_MUL_B = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * _MUL_A
    z += y
    z ^= z >> _SHIFT
    z *= _MUL_B
    return z


class Digests:
    """Digests of the substrings of a buffer, doubled from single bytes and made when asked for."""

    def __init__(self, data: np.ndarray):
        self.powers = [_BYTES[data]]

    def power(self, k: int) -> np.ndarray:
        while len(self.powers) <= k:
            half, step = self.powers[-1], 1 << (len(self.powers) - 1)
            self.powers.append(_mix(half[:-step], half[step:]) if len(half) > step else half[:0])
        return self.powers[k]

    def of(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Of strings of one length, from two overlapping powers."""
        k = length.bit_length() - 1
        whole = self.power(k)
        return _mix(whole[starts], whole[starts + (length - (1 << k))])


def anchors(texts: list[bytes], length: int = 400) -> list[tuple[np.ndarray, ...]]:
    """Runs of starts with one anchor: index of the text, lo, hi (both included), anchor, bucket, digest of
    the context. Texts under ``length`` bytes have none."""
    out = []
    power = max(0, min(WINDOW_POWER, length.bit_length() - 2))
    half = length.bit_length() - 1
    for first, begin, data, base in _buffers(texts, length):
        n = len(data) - length + 1
        digests = Digests(data)
        windows = digests.power(power)
        key = (windows & ~_PLACE) | np.arange(len(windows), dtype=np.uint64)  # leftmost of equal windows
        reach, width = 1, length - (1 << power) + 1
        while reach * 2 <= width:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        if width > reach:
            key = np.minimum(key[: -(width - reach)], key[width - reach :])
        key &= _PLACE
        place = key.view(np.int64)
        last = np.append(begin[1:], len(data)) - length  # start of a text
        new = np.append(True, place[1:] != place[:-1])
        new[begin] = True
        new[last[:-1] + 1] = True
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], n) - 1
        owner = np.searchsorted(begin, lo, "right") - 1
        whole_in = lo <= last[owner]  # what begins in one text and ends in the next is no string
        lo, hi, owner = lo[whole_in], hi[whole_in], owner[whole_in]
        at = place[lo]
        long = digests.power(half)
        size = hi - lo + length  # under four times the power: four strings of it cover all
        rest = size - (1 << half)
        whole = _mix(_mix(long[lo], long[lo + rest // 3]), _mix(long[lo + 2 * rest // 3], long[lo + rest]))
        whole = _mix(whole, size.astype(np.uint64))
        shift = base - begin[owner]
        out.append((first[owner], lo + shift, hi + shift, at + shift, windows[at].view(np.int64), whole.view(np.int64)))
    return out


def _buffers(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Short texts put together, as many as stay in a core's cache, and long ones in parts that overlap:
    indexes of the texts, where each begins, their bytes, and where the part of a long text begins."""
    held, size = [], 0

    def together() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        begin = np.cumsum([0, *(len(texts[i]) for i in held[:-1])])
        return np.array(held), begin, np.frombuffer(b"".join([texts[i] for i in held]), np.uint8), 0

    for i, raw in enumerate(texts):
        if len(raw) < length:
            continue
        if len(raw) > min(_BYTES_AT_ONCE, _STARTS_AT_ONCE):
            for base in range(0, len(raw) - length + 1, _STARTS_AT_ONCE):
                n = min(_STARTS_AT_ONCE, len(raw) - length + 1 - base)
                yield np.array([i]), np.zeros(1, np.int64), np.frombuffer(raw, np.uint8, n + length - 1, base), base
            continue
        held.append(i)
        size += len(raw)
        if size >= _BYTES_AT_ONCE:
            yield together()
            held, size = [], 0
    if held:
        yield together()


def _anchor_rows(length: int, rows_at_once: int = 20_000):
    def frame(parts: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(("k1", "k2", "lo", "hi", "at", "bucket", "whole"))})

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            for at in range(0, len(batch), _TEXTS_AT_ONCE):
                for text, *found in anchors(list(batch["raw"][at : at + _TEXTS_AT_ONCE]), length):
                    held.append((k1[at + text], k2[at + text], *found))
                    n += len(text)
                if n >= rows_at_once:
                    yield frame(held)
                    held, n = [], 0
        if held:
            yield frame(held)

    return rows


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks, from 0 without gaps, of the rows of key columns, the first of which counts most."""
    rank = np.unique(keys[0], return_inverse=True)[1]
    for key in keys[1:]:
        other = key if key.dtype == np.int64 else np.unique(key, return_inverse=True)[1]
        rank = np.unique(rank * (int(other.max(initial=0)) + 1) + other, return_inverse=True)[1]
    return rank


class Ordered:
    """Order of the substrings of a buffer, by 8 bytes at a time read as one number."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.words = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data)].copy().view(">u8").ravel().astype(np.uint64)

    def of(self, starts: np.ndarray, length: int) -> list[np.ndarray]:
        """Key columns of strings of one length; the last two may overlap."""
        places = [*range(0, length - 8, 8), length - 8] if length >= 8 else [0]
        keys = [self.words[starts + p] for p in places]
        return keys if length >= 8 else [keys[0] >> np.uint64(8 * (8 - length))]


def _cover_ranks(ordered: Ordered, size: int, blocks: int) -> np.ndarray:
    """Ranks of the strings of ``blocks`` periods that begin at the cover's positions, in their order in
    the buffer: first of one period each, then doubled, since a position one period on is in the cover too."""
    sample = (np.arange(0, size - size % PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
    at = np.minimum(sample, size - PERIOD)
    if len(at) >> 24:  # more ranks than three bytes hold
        rank, pieces = _dense(*ordered.of(at, PERIOD)), ()
    else:
        rank, pieces = np.unique(ordered.words[at], return_inverse=True)[1], ((8, 5), (13, 5), (18, 3))
    have = 1
    for begin, width in pieces:  # a rank and five bytes fill one number
        rank = np.unique(rank.astype(np.uint64) << np.uint64(40) | ordered.words[at + begin] >> np.uint64(64 - 8 * width), return_inverse=True)[1]
    while have < blocks:
        step = min(have, blocks - have)
        after = np.minimum(np.arange(len(rank)) + len(COVER) * step, len(rank) - 1)
        rank, have = _dense(rank, rank[after]), have + step
    return rank


def _suffix_keys(contexts: list[bytes], offsets: np.ndarray, runs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For all suffixes of contexts: index of the context, offset before the anchor and the columns by
    which they are sorted: first bytes, rank of the cover's string, last bytes."""
    width = np.array([len(c) for c in contexts])
    lead = (-offsets) % PERIOD  # anchors at offset 0 modulo the period
    begin = np.concatenate([[0], np.cumsum(-(-(lead + width) // PERIOD) * PERIOD + PERIOD)])
    data = np.zeros(begin[-1] + 2 * length, np.uint8)
    begin = begin[:-1] + lead
    for at, c in zip(begin.tolist(), contexts, strict=True):
        data[at : at + len(c)] = np.frombuffer(c, np.uint8)
    owner = np.repeat(np.arange(len(contexts)), runs)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts = begin[owner] + inside
    ordered, blocks = Ordered(data), (length - PERIOD + 1) // PERIOD
    if blocks < 1:  # too short for a cover
        return owner, offsets[owner] - inside, ordered.of(starts, length)
    rank = _cover_ranks(ordered, len(data), blocks)
    residue = starts % PERIOD
    slot = np.array([COVER.index((r + STEPS[r]) % PERIOD) for r in range(PERIOD)])[residue]
    ranked = rank[(starts + STEPS[residue]) // PERIOD * len(COVER) + slot]
    return owner, offsets[owner] - inside, [*ordered.of(starts, PERIOD), ranked, *ordered.of(starts + blocks * PERIOD, length - blocks * PERIOD)]


def _alike(bucket: np.ndarray, contexts: list[bytes], offsets: np.ndarray, runs: np.ndarray, length: int) -> np.ndarray:
    """Of all suffixes of contexts, those that another one has the bucket, the offset and, as far as a digest
    tells, the first and last bytes in common with. Equal suffixes always do."""
    data = np.frombuffer(b"".join([*contexts, bytes(8)]), np.uint8)
    words, width = Ordered(data).words, min(8, length)
    begin = np.cumsum([0, *map(len, contexts)])[:-1]
    owner = np.repeat(np.arange(len(contexts)), runs)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts, cut = begin[owner] + inside, np.uint64(8 * (8 - width))
    ends = _mix(words[starts] >> cut, words[starts + (length - width)] >> cut)
    key = _mix(_mix(ends, bucket[owner].astype(np.uint64)), (offsets[owner] - inside).astype(np.uint64))
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    out = np.zeros(len(key), bool)
    out[order] = same[1:] | same[:-1]
    return out


def repeated(group: np.ndarray, contexts: list[bytes], offsets: np.ndarray, copies: np.ndarray, length: int = 400) -> list[np.ndarray]:
    """Per context, which of its suffixes occur at least twice in their bucket ``group``, copies counted.

    Suffixes that are alone with their first and last bytes are left out before the sort. The others
    are put in the order of their cover ranks; where the bytes before and after these differ within
    one rank, by all columns.
    """
    runs = np.array([len(c) - length + 1 for c in contexts])
    first = np.cumsum(runs) - runs
    bucket = np.unique(group, return_inverse=True)[1]
    twice = np.repeat(copies >= 2, runs)
    alive = np.flatnonzero(_alike(bucket, contexts, offsets, runs, length))
    if len(alive):
        of = np.searchsorted(first, alive, "right") - 1
        edge = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        used, low = of[edge], alive[edge] - first[of[edge]]
        high = alive[np.append(edge[1:], len(alive)) - 1] - first[used]
        parts = [contexts[i][a : b + length] for i, a, b in zip(used.tolist(), low.tolist(), high.tolist(), strict=True)]
        sizes = high - low + 1
        owner, before, columns = _suffix_keys(parts, offsets[used] - low, sizes, length)
        own = np.repeat(np.arange(len(used)), np.diff(np.append(edge, len(alive))))
        at = alive - first[of] - low[own] + (np.cumsum(sizes) - sizes)[own]
        before, columns = before[at], [c[at] for c in columns]
        spread = int(before.max()) + 1 - int(before.min())
        columns.insert(0, bucket[of] * spread + before - int(before.min()))
        twice[alive] |= _equal_rows(columns, copies[of]) >= 2
    return np.split(twice, first[1:])


def _equal_rows(columns: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """For every row of key columns, the weight of all that are equal to it."""
    n = len(weights)
    order = np.lexsort((columns[_RANKED], columns[0])) if len(columns) > _RANKED else np.lexsort(columns[::-1])
    keys = [c[order] for c in columns]
    changed = [np.append(True, k[1:] != k[:-1]) for k in keys]
    new = changed[0] | changed[_RANKED] if len(columns) > _RANKED else np.logical_or.reduce(changed)
    other = np.logical_or.reduce(changed) & ~new
    number = np.cumsum(new) - 1
    if other.any():  # within one rank: by all columns
        mixed = np.flatnonzero(np.isin(number, number[other]))
        order[mixed] = order[mixed][np.lexsort([k[mixed] for k in keys[::-1]] + [number[mixed]])]
        keys = [c[order] for c in columns]
        number = np.cumsum(np.logical_or.reduce([np.append(True, k[1:] != k[:-1]) for k in keys])) - 1
    out = np.zeros(n)
    out[order] = np.bincount(number, weights=weights[order])[number]
    return out


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


_FOUND = "k1 bigint, k2 bigint, lo bigint, hi bigint"


def _sorted_buckets(length: int):
    """Rows arrive in the order of their buckets; a bucket is settled when all its contexts are there."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        found = repeated(rows["bucket"].to_numpy(), list(rows["context"]), rows["before"].to_numpy(), rows["n"].to_numpy(), length)
        out = [(k1, k2, lo + s, lo + e) for k1, k2, lo, n, mask in zip(rows["k1"], rows["k2"], rows["lo"], rows["n"], found, strict=True) if n == 1 and mask.any() for s, e in _runs(mask)]
        return pd.DataFrame(out, columns=["k1", "k2", "lo", "hi"], dtype="int64")

    def buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) > _CONTEXTS_AT_ONCE:
                edges = np.flatnonzero(held["bucket"].to_numpy()[1:] != held["bucket"].to_numpy()[:-1]) + 1
                ends = edges[edges >= min(_CONTEXTS_AT_ONCE, len(held))] if len(edges) else edges
                end = int(ends[0]) if len(ends) else int(edges[-1]) if len(edges) else 0
                if not end:
                    break  # the bucket goes on in the next batch
                yield settle(held[:end])
                held = held[end:].reset_index(drop=True)
        if held is not None and len(held):
            yield settle(held)

    return buckets


def _suffix_digests(length: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _CONTEXTS_AT_ONCE):
                part = batch[at : at + _CONTEXTS_AT_ONCE]
                contexts = list(part["context"])
                runs = np.array([len(c) - length + 1 for c in contexts])
                data = np.frombuffer(b"".join(contexts), np.uint8)
                begin = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])[:-1]
                owner = np.repeat(np.arange(len(contexts)), runs)
                inside = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
                found = Digests(data).of(begin[owner] + inside, length).view(np.int64)
                yield part.drop(columns=["context"]).assign(digests=np.split(found, np.cumsum(runs)[:-1]))

    return rows


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """k1 and k2 name a row by its id and text; equal rows share the name and the result."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.withColumn("k1", F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63)))).withColumn("raw", raw).withColumn("k2", F.xxhash64("raw"))


def repeated_starts(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """k1, k2, lo, hi: runs of starts (both included) whose next ``length`` bytes start elsewhere too."""
    return _repeated_starts(_keyed(docs, doc_id, text).select("k1", "k2", "raw"), length)


def _repeated_starts(named: DataFrame, length: int) -> DataFrame:
    schema = "k1 bigint, k2 bigint, lo bigint, hi bigint, at bigint, bucket bigint, whole bigint"
    found = named.where(F.length("raw") >= length).mapInPandas(_anchor_rows(length), schema)
    found = stage(found, "suffix-anchors")
    shared = found.groupBy("bucket").agg(F.count("*").alias("all")).where("all > 1").select("bucket")
    # From files both sides are shuffled for the join, so a hot bucket can be split.
    shared = stage(shared, "suffix-buckets")
    every = stage(found.join(shared, "bucket"), "suffix-shared")
    release(found, shared)

    entry = F.struct("k1", "k2", "lo", "hi", "at")
    contexts = stage(every.groupBy("bucket", "whole").agg(F.count("*").alias("n"), F.min(entry).alias("one")), "suffix-contexts")
    settled = every.join(contexts.where("n > 1").select("bucket", "whole"), ["bucket", "whole"]).select("k1", "k2", "lo", "hi")

    open_buckets = contexts.groupBy("bucket").agg(F.count("*").alias("different"), F.count_if(F.col("n") == 1).alias("single"))
    open_buckets = open_buckets.where("different > 1 AND single > 0").select("bucket", "different")
    wanted = contexts.join(stage(open_buckets, "suffix-open"), "bucket").select("bucket", "n", "different", "one.*")
    wanted = wanted.withColumn("before", F.col("at") - F.col("lo"))
    piece = F.substring(F.col("raw"), (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo") + length).cast("int"))
    cut = named.join(wanted, ["k1", "k2"]).select("bucket", "n", "different", "k1", "k2", "lo", "before", piece.alias("context"))
    cut = stage(cut.dropDuplicates(["bucket", "k1", "k2", "lo"]), "suffix-cut")

    small = cut.where(F.col("different") <= BUCKET).repartition("bucket").sortWithinPartitions("bucket", "k1", "k2", "lo")
    found = small.select("bucket", "n", "k1", "k2", "lo", "before", "context").mapInPandas(_sorted_buckets(length), _FOUND)

    digest_schema = "bucket bigint, n bigint, k1 bigint, k2 bigint, lo bigint, before bigint, digests array<bigint>"
    large = cut.where(F.col("different") > BUCKET).drop("different").mapInPandas(_suffix_digests(length), digest_schema)
    single = large.select("bucket", "n", "k1", "k2", "lo", "before", F.posexplode("digests").alias("i", "digest"))
    single = single.withColumn("offset", F.col("before") - F.col("i"))
    twice = single.groupBy("bucket", "offset", "digest").agg(F.sum("n").alias("total")).where("total > 1").drop("total")
    start = F.col("lo") + F.col("i")
    counted = single.where("n = 1").join(twice, ["bucket", "offset", "digest"]).select("k1", "k2", start.alias("lo"), start.alias("hi"))
    return settled.unionByName(found).unionByName(counted)


def spans(runs: list, length: int) -> list[tuple[int, int]]:
    """Bytes [begin, end) covered by the strings that start in the runs."""
    out: list[list[int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + length)
        else:
            out.append([lo, hi + length])
    return [(a, b) for a, b in out]


def _merged(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return spans([(a, b) for a, b in parts], 0)


def without(raw: bytes, removed: list[tuple[int, int]]) -> bytes:
    keep, at = [], 0
    for begin, end in removed:
        keep.append(raw[at:begin])
        at = end
    keep.append(raw[at:])
    return b"".join(keep)


def word_spans(raw: bytes, gone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Bytes [begin, end) of words [begin, end)."""
    if not gone:
        return []
    places = [m.span() for m in _WORD.finditer(raw)]
    return [(places[a][0], places[b - 1][1]) for a, b in gone]


def _with_runs(docs: DataFrame, length: int, words: int | None, doc_id: str, text: str) -> DataFrame:
    """``docs`` with k1, k2, raw, runs (of starts) and word_runs (packed windows of ``words`` words that occur twice)."""
    small_batches(docs.sparkSession)
    own = _keyed(docs, doc_id, text).select("k1", "k2", "raw")
    runs = _repeated_starts(own, length).groupBy("k1", "k2").agg(F.collect_list(F.array("lo", "hi")).alias("runs"))
    joined = _keyed(docs, doc_id, text).join(stage(runs, "suffix-runs"), ["k1", "k2"], "left")
    if not words:
        return joined.withColumn("word_runs", F.lit(None).cast("array<bigint>"))
    more = word_windows.repeated_windows(own, words, keep_first=False).groupBy("k1", "k2").agg(F.collect_list("run").alias("word_runs"))
    return joined.join(stage(more, "suffix-word-runs"), ["k1", "k2"], "left")


def _both() -> tuple[Column, Column]:
    return F.coalesce(F.col("runs"), F.array().cast("array<array<bigint>>")), F.coalesce(F.col("word_runs"), F.array().cast("array<bigint>"))


def _spans_of(runs, length: int) -> list[tuple[int, int]]:
    return spans([(int(r[0]), int(r[1])) for r in runs], length)


def removal_report(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row, null texts as empty; with ``words``
    also n_word_repeats, the words in passages of so many words that occur at two places.

    A byte goes if a string of ``length`` bytes over it starts at another place of any document,
    overlaps included; no first place is kept. Repeated rows count as places of their own. Words are
    counted, they don't go. Only the two columns are read.
    """
    joined = _with_runs(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), length, words, "doc_id", "text")

    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, n_word_repeats bigint")
    def report(raws: pd.Series, all_runs: pd.Series, all_words: pd.Series) -> pd.DataFrame:
        out = []
        for raw, own, counted in zip(raws, all_runs, all_words, strict=True):
            gone = _spans_of(own, length)
            again = sum(e - b for b, e in word_windows.intervals(counted, words)) if len(counted) else 0
            out.append((len(raw), sum(e - b for b, e in gone), len(gone), hashlib.sha256(without(raw, gone)).hexdigest(), again))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "n_word_repeats"])

    # Spans that touch are one maximal run.
    found = joined.select("doc_id", report("raw", *_both()).alias("r")).select("doc_id", "r.*")
    return found if words else found.drop("n_word_repeats")


def remove_repeats(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", words: int | None = None) -> DataFrame:
    """The documents with every repeated string cut out of the text; all rows and columns stay, null
    texts too. Every copy goes, the first as well, so two equal texts of at least ``length`` bytes are
    both left empty. A character of which only a part would be left goes with it. With ``words``,
    passages of so many words that occur twice go as well, however few bytes they have."""
    names = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    body = f"c{names.index(text)}"
    joined = _with_runs(own, length, words, f"c{names.index(doc_id)}", body)

    @F.pandas_udf("string")
    def kept(raws: pd.Series, all_runs: pd.Series, all_words: pd.Series) -> pd.Series:
        out = []
        for raw, own, counted in zip(raws, all_runs, all_words, strict=True):
            gone = _spans_of(own, length)
            if len(counted):
                gone = _merged(gone + word_spans(raw, word_windows.intervals(counted, words)))
            out.append(without(raw, gone).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    found = F.col("runs").isNotNull() | F.col("word_runs").isNotNull()
    done = {text: F.when(found, kept("raw", *_both())).otherwise(F.col(body))}
    return joined.select(*[done.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(names)])
