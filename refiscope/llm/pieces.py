"""SentencePiece encoding and decoding that keeps offsets.

The text is normalised by longest-prefix rules of the model's compiled character map, and the
source byte at which every normalised byte begins is recorded. The normalised text is cut before
every space mark that follows another character: no piece of the vocabulary holds a mark there, so
merges never cross a cut and segments can be encoded alone and remembered. Every piece is then
projected through the alignment to the bytes of the original text that it stands for.

Python runs inside Arrow batches, one text at a time; a worker keeps one bounded table of segments.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Segments remembered by a worker; the table is emptied when it is full.
REMEMBERED = 400_000
#: Segments over this many characters are encoded but not remembered.
LONGEST_REMEMBERED = 64


class CharMap:
    """The compiled map of a model: a double-array trie over UTF-8 keys and their replacements.

    Layout: the trie's size in bytes, its 32-bit units, then zero-ended replacement strings.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.strings = blob[4 + size :] if blob else b""

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that starts at ``at`` and its replacement."""
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(data)):
            byte = data[i]
            if byte == 0:
                break
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.strings.index(b"\0", found[1])
        return found[0], self.strings[found[1] : end]


@dataclass(frozen=True)
class Spec:
    charmap: CharMap
    dummy_prefix: bool
    trim_spaces: bool
    escape_spaces: bool


@dataclass
class Normalised:
    """``text`` and, per byte of its UTF-8 form plus one for the end, the source byte it begins at."""

    text: str
    source: np.ndarray


_CHAR_BYTES = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10, np.int64)


def normalise(text: str, spec: Spec) -> Normalised:
    """Longest rule first; without a rule a character stands for itself."""
    raw = text.encode("utf-8", "replace")
    out: list[bytes] = []
    starts: list[int] = []
    at, n = 0, len(raw)
    mark = SPACE.encode() if spec.escape_spaces else b" "
    if not spec.charmap and not spec.trim_spaces:
        return _identity(text, raw, mark, spec)
    pending: list[tuple[bytes, int]] = []
    while at < n:
        rule = spec.charmap.longest(raw, at) if spec.charmap else None
        if rule is None:
            length = int(_CHAR_BYTES[raw[at]])
            pending.append((raw[at : at + length], at))
            at += length
        else:
            pending.append((rule[1], at))
            at += rule[0]
    if spec.trim_spaces:
        pending = _trimmed(pending)
    if spec.dummy_prefix and pending:
        pending.insert(0, (b" ", pending[0][1]))
    for piece, begin in pending:
        piece = piece.replace(b" ", mark)
        out.append(piece)
        starts.extend([begin] * len(piece))
    end = pending[-1][1] if pending else 0
    end = n if not spec.trim_spaces else max(end, len(raw.rstrip(b" ")))
    return Normalised(b"".join(out).decode("utf-8", "replace"), np.array([*starts, end], np.int64))


def _identity(text: str, raw: bytes, mark: bytes, spec: Spec) -> Normalised:
    if not raw:
        return Normalised("", np.zeros(1, np.int64))
    data = np.frombuffer(raw, np.uint8)
    begins = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, np.arange(len(data)), 0))  # of each byte's character
    source = np.repeat(begins, np.where(data == 0x20, len(mark), 1))
    normal = text.replace(" ", mark.decode())
    if spec.dummy_prefix:
        normal = mark.decode() + normal
        source = np.concatenate([np.zeros(len(mark), np.int64), source])
    return Normalised(normal, np.append(source, len(raw)))


def _trimmed(parts: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """Without leading, trailing and repeated spaces."""
    kept: list[tuple[bytes, int]] = []
    blank = True
    for piece, begin in parts:
        if blank:
            piece = piece.lstrip(b" ")
        if piece:
            kept.append((piece, begin))
            blank = piece.endswith(b" ")
    while kept and kept[-1][0].endswith(b" "):
        piece = kept[-1][0].rstrip(b" ")
        kept[-1:] = [(piece, kept[-1][1])] if piece else []
    return kept


@dataclass(frozen=True)
class Piece:
    id: int
    begin: int  # source bytes
    end: int


class Segments:
    """Encodes normalised text segment by segment with the model's own merges."""

    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(model, "rb") as f:
            proto.ParseFromString(f.read())
        n = proto.normalizer_spec
        self.spec = Spec(CharMap(n.precompiled_charsmap), n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces)
        # Segments are normalised already.
        proto.normalizer_spec.name = "identity"
        proto.normalizer_spec.precompiled_charsmap = b""
        proto.normalizer_spec.add_dummy_prefix = False
        proto.normalizer_spec.remove_extra_whitespaces = False
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        pieces = [p.piece for p in proto.pieces]
        self.bytes_of = [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else None for p in proto.pieces]
        self.lengths = [1 if b else len(p.encode()) for p, b in zip(pieces, self.bytes_of, strict=True)]
        self.surface = [p.replace(SPACE, " ") for p in pieces]
        self.unknown = {i for i, p in enumerate(proto.pieces) if p.type == 2}
        self.silent = {i for i, p in enumerate(proto.pieces) if p.type == 3}
        self.unknown_text = proto.trainer_spec.unk_surface
        self.special = self.unknown | self.silent | {i for i, b in enumerate(self.bytes_of) if b is not None}
        self.CUT = _cuts(pieces)
        self.line_id = next((i for i, b in enumerate(self.bytes_of) if b == b"\n"), None)
        if any("\n" in p for p in pieces):
            self.line_id = None
        #: Number of ids, the ids, their text, normalised bytes from the segment's start to each piece's
        #: end (packed as 32-bit numbers) and to the segment's end.
        self.known: dict[str, tuple[int, str, str, bytes, int]] = {}

    def cut(self, normal: str) -> list[str]:
        return self.CUT.findall(normal) if self.CUT else [normal] * bool(normal)

    def lookup(self, segments: list[str]) -> None:
        """Encodes the segments that aren't remembered, together."""
        known = self.known
        new = [s for s in dict.fromkeys(segments) if s not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(dict.fromkeys(segments))
        for s, ids in zip(new, self._ids(new), strict=True):
            ends = self._ends(s, ids)
            known[s] = (len(ids), ",".join(map(str, ids)), self._text(ids), struct.pack(f"<{len(ends)}i", *ends), ends[-1] if ends else 0)

    def _ends(self, segment: str, ids: list[int]) -> list[int]:
        return list(accumulate(self.lengths[i] if i not in self.unknown else len(segment.encode()) for i in ids))

    def project(self, found: list[tuple[int, str, str, bytes, int]], source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source bytes [begin, end) of all pieces of looked-up segments: each segment's remembered
        ends are shifted to its place in the normalised text and go through the alignment."""
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes, _, _, packed, widths = zip(*found, strict=True)
        ends = np.frombuffer(b"".join(packed), "<i4").astype(np.int64)
        widths = np.array(widths, np.int64)
        ends += np.repeat(np.cumsum(widths) - widths, np.array(sizes, np.int64))
        places = source[np.concatenate([[0], ends])]
        return places[:-1], places[1:]

    def _ids(self, parts: list[str]) -> list[list[int]]:
        """Of many segments; those without a line end go through one call, as merges never cross a line end."""
        if self.line_id is None:
            return self.library.encode(parts, num_threads=1)
        plain = [s for s in parts if "\n" not in s]
        ids = np.array(self.library.encode("\n".join(plain)), np.int64)
        ends = np.append(np.flatnonzero(ids == self.line_id), len(ids)).tolist()
        ids, found, at = ids.tolist(), {}, 0
        for s, end in zip(plain, ends, strict=True) if plain else ():
            found[s] = ids[at:end]
            at = end + 1
        return [found[s] if s in found else self.library.encode(s) for s in parts]

    def forget_long(self, segments: list[str]) -> None:
        for s in segments:
            if len(s) > LONGEST_REMEMBERED:
                self.known.pop(s, None)

    def encode(self, text: str) -> list[Piece]:
        """Ids with the source bytes [begin, end) each of them stands for."""
        normal = normalise(text, self.spec)
        segments = self.cut(normal.text)
        self.lookup(segments)
        ids = [int(i) for s in segments for i in self.known[s][1].split(",") if i]
        begins, ends = self.project([self.known[s] for s in segments], normal.source)
        self.forget_long(segments)
        return [Piece(i, b, e) for i, b, e in zip(ids, begins.tolist(), ends.tolist(), strict=True)]

    def decode(self, ids: list[int]) -> str:
        """Byte pieces are joined before they are read as UTF-8; the dummy prefix goes."""
        text = self._text(ids)
        return text[1:] if self.spec.dummy_prefix and ids and self.bytes_of[ids[0]] is None and text.startswith(" ") else text

    def decode_segments(self, found: list[tuple[int, str, str, bytes, int]]) -> str:
        """Of all ids of looked-up segments: no character crosses a cut, so their texts are joined."""
        text = "".join([x[2] for x in found])
        first = int(found[0][1].split(",", 1)[0]) if found else 0
        return text[1:] if self.spec.dummy_prefix and found and self.bytes_of[first] is None and text.startswith(" ") else text

    def _text(self, ids: list[int]) -> str:
        if self.special.isdisjoint(ids):
            return "".join([self.surface[i] for i in ids])
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            byte = self.bytes_of[i]
            if byte is not None:
                raw += byte
                continue
            if raw:
                out.append(_bytes_text(bytes(raw)))
                raw.clear()
            out.append("" if i in self.silent else self.unknown_text if i in self.unknown else self.surface[i])
        if raw:
            out.append(_bytes_text(bytes(raw)))
        return "".join(out)


def _cuts(pieces: list[str]) -> re.Pattern | None:
    """Segments of normalised text that no piece crosses: before a space mark that follows another
    character, around line ends, and between a letter and a sign that never follows a letter in a
    piece. None if the vocabulary allows pieces across spaces or line ends."""
    if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces):
        return None
    signs = {c for p in pieces for c in p if not (c.isalnum() or c in "_" + SPACE)}
    after_letter = {b for p in pieces for a, b in zip(p, p[1:]) if a.isalpha()}
    cut = "".join(map(re.escape, sorted(signs - after_letter)))
    return re.compile(rf"{SPACE}*[^\W\d_{SPACE}]+(?![^{cut}\n{SPACE}])|{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")


def _bytes_text(raw: bytes) -> str:
    """Every byte that begins no character becomes one replacement mark."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            length = int(_CHAR_BYTES[raw[at]])
            try:
                out.append(raw[at : at + length].decode())
                at += length
            except UnicodeDecodeError:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def segments(model: str) -> Segments:
    return Segments(model)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _spread(docs: DataFrame, made: Column, names: list[str]) -> DataFrame:
    """``docs`` with the fields of a struct as columns, through a name that no column has."""
    held = f"made-{uuid.uuid4().hex}"
    return docs.withColumn(held, made).withColumns({c: F.col(f"`{held}`")[c] for c in names}).drop(held)


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """Adds ids, begins and ends (arrays, source bytes). A null text counts as empty (no pieces);
    rows and other columns stay, columns of those three names are replaced."""

    @F.pandas_udf("ids array<int>, begins array<bigint>, ends array<bigint>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tool = segments(model_path(model))
        for batch in batches:
            rows = [tool.encode(t or "") for t in batch]
            yield pd.DataFrame({
                "ids": [[p.id for p in r] for r in rows], "begins": [[p.begin for p in r] for r in rows], "ends": [[p.end for p in r] for r in rows]})

    return _spread(docs, pieces(F.col(text)), ["ids", "begins", "ends"])


def decode(docs: DataFrame, model: str = "piece_bpe_32k.model", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of an array of ids; null ids count as none."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tool = segments(model_path(model))
        for batch in batches:
            yield pd.Series([tool.decode([int(i) for i in x] if x is not None else []) for x in batch], dtype=object)

    return docs.withColumn(out, texts(F.col(ids)))


def digests(docs: DataFrame, model: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256, spans_sha256 and span_bytes without keeping the ids.

    A text is encoded, every piece is projected to its source bytes and the ids are decoded in the
    same step; nothing of it is kept. ``spans_sha256`` is of all pieces' begins and then ends as 64-bit
    numbers, ``span_bytes`` the number of source bytes that the pieces cover.
    """

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string, span_bytes bigint")
    def folded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tool = segments(model_path(model))
        for batch in batches:
            yield pd.DataFrame([_folded(tool, t or "") for t in batch], columns=names)

    names = ["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "span_bytes"]
    return _spread(docs, folded(F.col(text)), names)


def spans_sha256(begins: np.ndarray, ends: np.ndarray) -> str:
    """Of all begins and then all ends, as 64-bit little-endian numbers."""
    return hashlib.sha256(begins.astype("<i8").tobytes() + ends.astype("<i8").tobytes()).hexdigest()


def _folded(tool: Segments, text: str) -> tuple[int, str, str, str, int]:
    normal = normalise(text, tool.spec)
    parts = tool.cut(normal.text)
    tool.lookup(parts)
    found = [tool.known[s] for s in parts]
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
    ids_text = ",".join([x[1] for x in found])
    decoded = tool.decode_segments(found)
    begins, ends = tool.project(found, normal.source)
    tool.forget_long(parts)
    return len(begins), sha(ids_text), sha(decoded), spans_sha256(begins, ends), int((ends - begins).sum())
