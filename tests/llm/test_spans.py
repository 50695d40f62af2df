"""op7's digests hold the span of every piece."""

import hashlib
import struct

from conftest import SF
from pyspark.sql import functions as F

from refiscope.llm import pieces, queries


def plain_spans(lib, text):
    """The library's ids laid over the source one after the other: this model only swaps spaces for
    marks, and the pieces of a character that was split into bytes begin with it."""
    raw, at, out = text.encode(), 0, []
    at_char = lambda n: max((i for i in range(min(n, len(raw)) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80), default=0)
    for k, i in enumerate(lib.encode(text)):
        surface = lib.id_to_piece(i)
        n = 1 if lib.is_byte(i) else len(surface.replace("\u2581", " ").encode()) - (k == 0)  # the first mark is no source
        out.append((at_char(at), at_char(at + n)))
        at += n
    return out


def test_query_digests_the_span_of_every_piece(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    rows = [(1, "two words"), (2, "a 😀 é  b\nc"), (3, ""), (4, None), (5, "x" * 300 + " end")]
    sha = lambda spans: hashlib.sha256(struct.pack(f"<{2 * len(spans)}q", *[b for b, _ in spans], *[e for _, e in spans])).hexdigest()
    got = {r.doc_id: r for r in pieces.digests(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, t in rows:
        spans = plain_spans(lib, t or "")
        assert got[i].spans_sha256 == sha(spans), (t, spans, pieces.segments(pieces.model_path()).encode(t or ""))
        assert got[i].span_bytes == len((t or "").encode())
    assert "spans_sha256" in queries.QUERIES["op7_sentencepiece"](spark, SF).columns


def test_clashing_names_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 7), (1, "a b", 7), (None, None, 8)], "doc_id bigint, text string, _folded int").withColumn("_pieces", F.lit(3))
    got = pieces.digests(docs).orderBy("_folded").collect()
    assert [(r._folded, r._pieces, r.n_tokens) for r in got] == [(7, 3, 2), (7, 3, 2), (8, 3, 0)] and got[0].spans_sha256 == got[1].spans_sha256
    assert pieces.digests(docs.limit(0)).count() == 0 and pieces.encode(docs.limit(0)).count() == 0
    assert {"_pieces", "_folded", "ids"} <= set(pieces.encode(docs).columns)
