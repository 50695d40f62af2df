"""Removal of repeated passages by Rabin-Karp fingerprints of word windows, counted in Spark.

Every window of ``window`` words has a rolling fingerprint. So that not each of them travels, the
windows of a text are first put in runs: each window is named by the least fingerprint of its
``window // 4`` word stretches (its anchor), and neighbours that share the anchor's place form one run.
Equal windows have equal anchors at equal places, so all counting is within an anchor, and an anchor
that one run only has holds no repeat. The fingerprints are counted twice:

1. whole runs, by anchor and the fingerprint of all their words: every run but the first of its
   kind goes, since each of its windows starts earlier in the first one;
2. single windows of the first runs, where an anchor still has different ones: every window but the
   first of its fingerprint goes.

What goes is gathered per text as places and lengths, and overlapping ones merge into maximal
intervals. Counting is by hash aggregation with partial sums before the shuffle, so a passage or a
text that a third of the corpus repeats is one row per map task.

Words count as equal by 64-bit digests; windows by two fingerprints, of the anchor and of the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import release, stage
from .rolling import Rolling, mixed, word_digests

WINDOW = 20
#: Windows that are looked at together; longer texts are cut into blocks that overlap by a window.
_BLOCK = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
_ROWS = 50_000
#: Short texts are looked at together, about so many words and at most so many texts at once.
_WORDS_AT_ONCE, _TEXTS_AT_ONCE = 1 << 15, 64
_LENGTH_BITS = 20


def _anchor_words(window: int) -> int:
    return max(1, window // 4)


def runs_of_texts(texts: list[np.ndarray], window: int = WINDOW) -> list[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor: index of the text, first window, number of windows, words before the
    anchor, fingerprint of the anchor, fingerprint of all words of the run. ``texts``: word digests."""
    short, out = _anchor_words(window), []
    for first, begin, values, base in _buffers(texts, window):
        n = len(values) - window + 1
        rolling = Rolling(values)
        anchors = mixed(rolling.windows(short))
        key = (anchors & ~_PLACE) | np.arange(len(anchors), dtype=np.uint64)  # leftmost of equal anchors
        reach, width = 1, window - short + 1
        while reach * 2 <= width:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        if width > reach:
            key = np.minimum(key[: -(width - reach)], key[width - reach :])
        place = (key & _PLACE).astype(np.int64)
        last = np.append(begin[1:], len(values)) - window  # window of a text
        new = np.append(True, place[1:] != place[:-1])
        new[begin] = True
        new[last[:-1] + 1] = True
        lo = np.flatnonzero(new)
        size = np.diff(np.append(lo, n))
        owner = np.searchsorted(begin, lo, "right") - 1
        whole_in = lo <= last[owner]  # not from one text to the next
        lo, size, owner = lo[whole_in], size[whole_in], owner[whole_in]
        at = place[lo]
        whole = mixed(rolling.of(lo, size + window - 1), 1) ^ mixed((size << 20 | (at - lo)).astype(np.uint64))
        out.append((first[owner], lo + (base - begin[owner]), size, at - lo, anchors[at].view(np.int64), whole.view(np.int64)))
    return out


def runs_of(values: np.ndarray, window: int = WINDOW) -> list[tuple[np.ndarray, ...]]:
    """``runs_of_texts`` of one text, without its index."""
    return [part[1:] for part in runs_of_texts([values], window)]


def _buffers(texts: list[np.ndarray], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Short texts put together and long ones in blocks that overlap: indexes of the texts, where each
    begins, their digests, and where the block of a long text begins."""
    held, size = [], 0

    def together() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        return np.array(held), np.cumsum([0, *(len(texts[i]) for i in held[:-1])]), np.concatenate([texts[i] for i in held]), 0

    for i, values in enumerate(texts):
        if len(values) < window:
            continue
        if len(values) > min(_WORDS_AT_ONCE, _BLOCK):
            for base in range(0, len(values) - window + 1, _BLOCK):
                yield np.array([i]), np.zeros(1, np.int64), values[base : base + _BLOCK + window - 1], base
            continue
        held.append(i)
        size += len(values)
        if size >= _WORDS_AT_ONCE:
            yield together()
            held, size = [], 0
    if held:
        yield together()


def _run_rows(window: int):
    names = ["k1", "k2", "lo", "n", "before", "anchor", "whole"]

    def frame(parts: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(names)})

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            for at in range(0, len(batch), _TEXTS_AT_ONCE):
                for text, *found in runs_of_texts([word_digests(raw) for raw in batch["raw"][at : at + _TEXTS_AT_ONCE]], window):
                    parts.append((k1[at + text], k2[at + text], *found))
                    held += len(text)
                if held >= _ROWS:
                    yield frame(parts)
                    parts, held = [], 0
        if held:
            yield frame(parts)

    return rows


def _window_rows(window: int):
    """Fingerprints of the single windows of listed runs: one row a text with its runs, one row a window out."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k1, k2, raw, los, ns, befores, anchors in zip(*(batch[c] for c in ("k1", "k2", "raw", "lo", "n", "before", "anchor")), strict=True):
                values = word_digests(raw)
                for at in range(0, len(los), _BLOCK // window):
                    lo, n, before, anchor = (np.asarray(x[at : at + _BLOCK // window]) for x in (los, ns, befores, anchors))
                    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    place = np.repeat(lo, n) + inside
                    seen = np.unique(place[:, None] + np.arange(window)) if len(values) > _BLOCK else None
                    own = values if seen is None else values[seen]  # of a long text only the runs' words
                    starts = place if seen is None else np.searchsorted(seen, place)
                    print_ = mixed(Rolling(own).of(starts, window), 2).view(np.int64)
                    yield pd.DataFrame({"k1": k1, "k2": k2, "place": place, "anchor": np.repeat(anchor, n), "before": np.repeat(before, n) - inside, "print": print_})

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for part in rows(batches):
            parts.append(part)
            held += len(part)
            if held >= _ROWS:
                yield pd.concat(parts, ignore_index=True)
                parts, held = [], 0
        if held:
            yield pd.concat(parts, ignore_index=True)

    return joined


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """k1 and k2 name a row by id and text; equal rows share the name and the result."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    own = docs.select(F.col(doc_id).alias("doc_id"), raw.alias("raw"))
    return own.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64("raw").alias("k2"), "raw")


def _packed(lo: Column, n: Column) -> Column:
    return (F.shiftleft(lo, _LENGTH_BITS) + n).alias("run")


def repeated_windows(named: DataFrame, window: int = WINDOW, keep_first: bool = True) -> DataFrame:
    """k1, k2, run: windows, as first word and number of windows in one long, whose words also start
    earlier: in a text with a smaller id (null first; equal ids by the texts' hash) or before in the same
    text. Without ``keep_first`` all windows whose words start at two places. ``named``: k1, k2, raw."""
    if not 1 <= window < 1 << (_LENGTH_BITS - 2):
        raise ValueError("a window has at least one word and fewer than 2^18")
    schema = "k1 bigint, k2 bigint, lo bigint, n int, before int, anchor bigint, whole bigint"
    runs = stage(named.mapInPandas(_run_rows(window), schema), "window-runs")
    # Partial counts before the shuffle; an anchor with one run is left behind.
    shared = runs.groupBy("anchor").agg(F.count("*").alias("runs")).where("runs > 1").select("anchor")
    shared = stage(shared, "window-anchors")
    every = stage(runs.join(shared, "anchor"), "window-shared")
    release(runs, shared)

    entry = F.struct("k1", "k2", "lo")
    firsts = every.groupBy("anchor", "whole").agg(F.count("*").alias("copies"), F.min(entry).alias("first"), F.first("n").alias("n"), F.first("before").alias("before"))
    firsts = stage(firsts, "window-firsts")
    # 1. Runs that start earlier as a whole.
    twice, names = firsts.where("copies > 1"), ["anchor", "whole"]
    if keep_first:
        again = every.join(twice.select(*names, "first"), names).where(F.struct("k1", "k2", "lo") != F.col("first"))
    else:  # that it repeats is all there is to know of a run
        again = every.join(twice.select(*names), names, "left_semi")
    whole = again.select("k1", "k2", _packed(F.col("lo"), F.col("n").cast("bigint")))
    # 2. Windows of first runs whose anchor has several kinds.
    kinds = firsts.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    kinds = stage(kinds, "window-kinds")
    open_runs = firsts.join(kinds, "anchor").select("anchor", "first.*", "n", "before")
    listed = open_runs.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("lo", "n", "before", "anchor"))).alias("r"))
    listed = stage(listed.select("k1", "k2", *[F.col(f"r.{c}").alias(c) for c in ("lo", "n", "before", "anchor")]), "window-listed")
    release(kinds)
    texts = named.join(listed, ["k1", "k2"])
    single = texts.mapInPandas(_window_rows(window), "k1 bigint, k2 bigint, place bigint, anchor bigint, before int, print bigint")
    single = stage(single, "window-prints")
    release(listed)
    at = F.struct("k1", "k2", "place")
    counted = single.groupBy("anchor", "before", "print").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").drop("last")
    later = single.join(stage(counted, "window-repeats"), ["anchor", "before", "print"])
    later = later.where(at != F.col("first")) if keep_first else later
    return whole.unionByName(later.select("k1", "k2", _packed(F.col("place"), F.lit(1).cast("bigint"))).distinct())


def intervals(runs: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals [begin, end) of the words that packed runs of windows cover."""
    if not len(runs):
        return []
    runs = np.sort(runs)
    begin = runs >> _LENGTH_BITS
    end = np.maximum.accumulate(begin + (runs & ((1 << _LENGTH_BITS) - 1)) - 1 + window)
    cut = np.flatnonzero(begin[1:] > end[:-1]) + 1
    return list(zip(begin[np.append(0, cut)].tolist(), end[np.append(cut - 1, len(end) - 1)].tolist(), strict=True))


def _kept(raw: bytes, gone: list[tuple[int, int]]) -> tuple[int, list[bytes]]:
    words = raw.split()
    kept, at = [], 0
    for begin, end in gone:
        kept += words[at:begin]
        at = end
    return len(words), kept + words[at:]


def removal_spans(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, begins, ends (words [begin, end) that go, maximal), kept (the words that stay,
    joined by one space) of every row.

    A word goes if a window over it starts earlier, in a document with a smaller id or before in its
    own; windows are judged on the input, so what goes depends on no order of work. Null and empty
    texts have no words. Rows that are equal in id and text count as one document, each with its
    result; equal ids with different texts are ordered by the texts' hash; a null id comes first.
    Texts of any length are read whole; other columns are not read.
    """
    named = _named(docs, doc_id, text)
    runs = repeated_windows(named.select("k1", "k2", "raw"), window).groupBy("k1", "k2").agg(F.collect_list("run").alias("runs"))
    joined = named.join(stage(runs, "window-runs-of-texts"), ["k1", "k2"], "left")

    @F.pandas_udf("n_words bigint, begins array<bigint>, ends array<bigint>, kept string")
    def spans(raws: pd.Series, all_runs: pd.Series) -> pd.DataFrame:
        out = []
        for raw, own in zip(raws, all_runs, strict=True):
            gone = intervals(own, window)
            n, kept = _kept(raw, gone)
            out.append((n, [b for b, _ in gone], [e for _, e in gone], b" ".join(kept).decode("utf-8", "replace")))
        return pd.DataFrame(out, columns=["n_words", "begins", "ends", "kept"])

    return joined.select("doc_id", spans("raw", F.coalesce("runs", F.array().cast("array<bigint>"))).alias("r")).select("doc_id", "r.*")
