"""Fill-in-the-middle over seekable compressed frames.

A text is stored as independent zstandard frames with the number of units (lines), characters and
bytes before each of them. A cut after k units is found in the cumulative counts, so only the frame
that holds it is decompressed. The rearranged text is again a list of frames: whole frames move as
they are, and only the parts of cut frames are compressed anew. Digests and the way back stream the
frames in order, one at a time, so no text is ever held decompressed as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: Bytes of text in a frame, at least one character.
FRAME_BYTES = 1 << 16
LEVEL = 3
# The marks before the parts, and the order of the parts in each form.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}

Frames = list[bytes]


def _chars(data: np.ndarray) -> int:
    """Code points that begin in UTF-8 bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def pack(raw: bytes, frame_bytes: int = FRAME_BYTES) -> tuple[Frames, np.ndarray]:
    """Frames of a text and, before each of them and at the end, the line ends, characters and bytes."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    frames, counts, at = [], [(0, 0, 0)], 0
    while at < len(raw):
        end = min(at + frame_bytes, len(raw))
        while end < len(raw) and end > at + 1 and raw[end] & 0xC0 == 0x80:  # not inside a character
            end -= 1
        while end < len(raw) and raw[end] & 0xC0 == 0x80:  # one character is longer than a frame
            end += 1
        part = raw[at:end]
        frames.append(squeeze(part))
        lines, chars, _ = counts[-1]
        counts.append((lines + part.count(b"\n"), chars + _chars(np.frombuffer(part, np.uint8)), end))
        at = end
    return frames, np.array(counts, np.int64)


def unpack(frames: Frames) -> Iterator[bytes]:
    """The frames' texts in order."""
    open_ = zstandard.ZstdDecompressor().decompress
    return (open_(f) for f in frames)


class Cut:
    """Places of a stored text by its units; a frame with a cut is opened once."""

    def __init__(self, frames: Frames, counts: np.ndarray, n_units: int):
        self.frames, self.counts, self.n_units = frames, counts, n_units
        self.opened: dict[int, bytes] = {}

    def frame(self, i: int) -> bytes:
        if i not in self.opened:
            self.opened[i] = next(unpack(self.frames[i : i + 1]))
        return self.opened[i]

    def after(self, units: int) -> tuple[int, int, int]:
        """Frame, byte in the frame and characters before the place after so many units."""
        if units <= 0:
            return 0, 0, 0
        if units >= self.n_units:
            return len(self.frames), 0, int(self.counts[-1, 1])
        i = int(np.searchsorted(self.counts[1:, 0], units))
        data = np.frombuffer(self.frame(i), np.uint8)
        inside = int(np.flatnonzero(data == 10)[units - self.counts[i, 0] - 1]) + 1
        return i, inside, int(self.counts[i, 1]) + _chars(data[:inside])

    def between(self, a: tuple[int, int, int], b: tuple[int, int, int]) -> Frames:
        """Frames of the text between two places."""
        (i, x, _), (j, y, _) = a, b
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        if i == j:
            return [squeeze(self.frame(i)[x:y])] if y > x else []
        head = [squeeze(self.frame(i)[x:])] if x else [self.frames[i]]
        return head + self.frames[i + 1 : j] + ([squeeze(self.frame(j)[:y])] if y else [])


def rearrange(frames: Frames, counts: np.ndarray, n_units: int, form: str, first: int, second: int) -> tuple[Frames, int | None, int | None]:
    """Frames of the output, characters of prefix and of middle (none if plain)."""
    if form not in ORDERS:
        return frames, None, None
    text = Cut(frames, counts, n_units)
    ends = [(0, 0, 0), text.after(first), text.after(second), (len(frames), 0, int(counts[-1, 1]))]
    parts = {"prefix": (ends[0], ends[1]), "middle": (ends[1], ends[2]), "suffix": (ends[2], ends[3])}
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    out: Frames = []
    for part in ORDERS[form]:
        out += [squeeze(MARKS[part]), *text.between(*parts[part])]
    return out, ends[1][2], ends[2][2] - ends[1][2]


def parts_of(output: Frames, form: str) -> tuple[dict[str, tuple[int, int]], list[int], str]:
    """Byte ranges of the parts of an output, bytes before each frame, and its sha256; one pass.

    A mark is looked for from the end of the one before it; only the last bytes of a frame are kept
    for a mark that lies across two.
    """
    digest, begins, size, tail = hashlib.sha256(), [0], 0, b""
    wanted = list(ORDERS.get(form, ()))
    found: list[tuple[str, int]] = []
    keep = max(map(len, MARKS.values())) - 1
    for data in unpack(output):
        digest.update(data)
        seen = tail + data
        base = size - len(tail)
        at = max(0, found[-1][1] - base) if found else 0
        while len(found) < len(wanted):
            mark = MARKS[wanted[len(found)]]
            hit = seen.find(mark, at)
            if hit < 0:
                break
            at = hit + len(mark)
            found.append((wanted[len(found)], base + at))
        size += len(data)
        begins.append(size)
        tail = seen[max(len(seen) - keep, 0) :]
    ends = [begin - len(MARKS[part]) for part, begin in found[1:]] + [size]
    return {part: (begin, end) for (part, begin), end in zip(found, ends, strict=False)}, begins, digest.hexdigest()


def stream(frames: Frames, begins: list[int], lo: int, hi: int) -> Iterator[bytes]:
    """Bytes [lo, hi), opening only the frames that hold some of them."""
    i = max(int(np.searchsorted(begins, lo, "right")) - 1, 0)
    while i < len(frames) and begins[i] < hi:
        yield next(unpack(frames[i : i + 1]))[max(lo - begins[i], 0) : hi - begins[i]]
        i += 1


def restore(output: Frames, form: str) -> Iterator[bytes]:
    """The text, rebuilt from an output and its form."""
    parts, begins, _ = parts_of(output, form)
    return _restored(output, form, parts, begins)


def _restored(output: Frames, form: str, parts: dict[str, tuple[int, int]], begins: list[int]) -> Iterator[bytes]:
    if form not in ORDERS:
        yield from unpack(output)
        return
    for part in ("prefix", "middle", "suffix"):
        yield from stream(output, begins, *parts[part])


def _store_rows(frame_bytes: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [pack(raw, frame_bytes) for raw in batch["raw"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "marked": batch["marked"], "frames": [f for f, _ in packed],
                **{name: [c[:, k] for _, c in packed] for k, name in enumerate(("lines", "chars", "bytes"))},
                "n": [int(c[-1, 0]) + (len(raw) > 0 and raw[-1] != 10) for (_, c), raw in zip(packed, batch["raw"], strict=True)]})

    return rows


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """doc_id, marked (the text holds a mark), frames, lines, chars and bytes before each frame and at
    the end, n (units): one row for every row of ``docs``, null texts as empty. Only the two columns are read."""
    if frame_bytes < 1:
        raise ValueError("a frame has at least one byte")
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = F.lit(False)
    for mark in MARKS.values():
        marked = marked | F.contains(whole, F.lit(mark.decode()))
    own = docs.select(F.col(doc_id).alias("doc_id"), marked.alias("marked"), whole.cast("binary").alias("raw"))
    kind = dict(own.dtypes)["doc_id"]
    schema = f"doc_id {kind}, marked boolean, frames array<binary>, lines array<bigint>, chars array<bigint>, bytes array<bigint>, n bigint"
    return own.mapInPandas(_store_rows(frame_bytes), schema)


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")


def choose(stored: DataFrame, seed: int = 7, percent: int = 100, percent_spm: int = 50) -> DataFrame:
    """Adds form and first and second, the units before the middle and through its end. The draws come
    from a digest of seed and id (a null id counts as empty), so they're the same in every run and order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    drawn = stored.withColumn("_digest", digest)
    cuts = [_draw(F.col("_digest"), k) % (F.col("n") + 1) for k in (0, 1)]
    plain = (F.col("n") == 0) | F.col("marked") | (_draw(F.col("_digest"), 2) % 100 >= percent)
    form = F.when(plain, "plain").when(_draw(F.col("_digest"), 3) % 100 < percent_spm, "spm").otherwise("psm")
    return drawn.withColumns({"form": form, "first": F.least(*cuts), "second": F.greatest(*cuts)}).drop("_digest")


def infilled(docs: DataFrame, seed: int = 7, percent: int = 100, percent_spm: int = 50, doc_id: str = "doc_id", text: str = "text",
             frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars (null if plain) and output, the frames of the
    rearranged text, for every row of ``docs``. The frames of the texts are written once and read again.

    Empty and null texts and texts that hold a mark stay plain; repeated rows stay; a very long line
    spans many frames; an empty table gives an empty one.
    """
    stored = stage(store(docs, doc_id, text, frame_bytes), "text-frames")
    chosen = choose(stored, seed, percent, percent_spm)

    @F.pandas_udf("output array<binary>, prefix_chars bigint, middle_chars bigint")
    def moved(frames: pd.Series, lines: pd.Series, chars: pd.Series, sizes: pd.Series, n: pd.Series, form: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
        out = []
        for f, x, y, z, *rest in zip(frames, lines, chars, sizes, n, form, first, second, strict=True):
            out.append(rearrange(list(f), np.stack([x, y, z], axis=1), *rest))
        return pd.DataFrame({"output": [r[0] for r in out], "prefix_chars": pd.array([r[1] for r in out], "Int64"), "middle_chars": pd.array([r[2] for r in out], "Int64")})

    got = chosen.select("doc_id", "n", "form", moved("frames", "lines", "chars", "bytes", "n", "form", "first", "second").alias("m"))
    return got.select("doc_id", "n", "form", "m.prefix_chars", "m.middle_chars", "m.output")


def output_text(frames: Column) -> Column:
    """The text of frames, as a string."""

    @F.pandas_udf("string")
    def joined(rows: pd.Series) -> pd.Series:
        return pd.Series([b"".join(unpack(list(r))).decode("utf-8", "replace") for r in rows], dtype=object)

    return joined(frames)


def digests(output: Column, form: Column) -> Column:
    """Struct of output_sha256 and restored_sha256, the latter of the text rebuilt from output and form."""

    @F.pandas_udf("output_sha256 string, restored_sha256 string")
    def streamed(outputs: pd.Series, forms: pd.Series) -> pd.DataFrame:
        rows = []
        for frames, own in zip(outputs, forms, strict=True):
            frames = list(frames)
            parts, begins, whole = parts_of(frames, own)
            back = hashlib.sha256()
            for data in _restored(frames, own, parts, begins):
                back.update(data)
            rows.append((whole, back.hexdigest()))
        return pd.DataFrame(rows, columns=["output_sha256", "restored_sha256"])

    return streamed(output, form)
