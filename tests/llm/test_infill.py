"""Fill-in-the-middle over frames against plain string work."""

import hashlib
import random
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from refiscope.llm import infill

DOCS = "doc_id bigint, text string"


def plain(doc_id, text, percent=100):
    """n, form, prefix and middle characters, output."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 50 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h[3] % 100 < 50 else "psm", len(p), len(m), out


def texts():
    rng = random.Random(5)
    line = lambda: "".join(rng.choice("ab é日😀<PSM>") for _ in range(rng.randrange(25))).replace("<P>", "").replace("<S>", "").replace("<M>", "")
    rows = [(i, "\n".join(line() for _ in range(rng.randrange(40))) + "\n" * rng.randrange(3)) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "\n"), (103, "\n\n\n"), (104, "has <M> in it\n"), (105, "<P" + "\n>" * 9), (106, "x" * 5000), (107, ("é" * 700 + "\n") * 5), (None, "one\ntwo\n"),
                   (108, "a\n<"), (108, "a\n<"), (109, "<S\nP>\nM>\n<")]


@pytest.mark.parametrize("frame_bytes", [1, 7, 64, 1 << 16])
def test_outputs_and_the_way_back(spark, frame_bytes):
    rows = texts()
    docs = spark.createDataFrame(rows, DOCS).withColumn("form", F.lit("x")).withColumn("n", F.lit(3))
    found = infill.infilled(docs, frame_bytes=frame_bytes).withColumn("out", infill.output_text(F.col("output"))).withColumn("d", infill.digests(F.col("output"), F.col("form")))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.out, r.d.output_sha256, r.d.restored_sha256) for r in found.collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = sorted(((i, *plain(i, t), sha(plain(i, t)[4]), sha(t or "")) for i, t in rows), key=str)
    assert got == expected and {r[2] for r in got} == {"plain", "psm", "spm"}


def test_some_texts_stay_plain_and_no_rows(spark):
    docs = spark.createDataFrame(texts(), DOCS)
    got = {(r.doc_id, r.form) for r in infill.infilled(docs, percent=40).collect()}
    assert got == {(i, plain(i, t, 40)[1]) for i, t in texts()}
    assert infill.infilled(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        infill.store(docs, frame_bytes=0)


def test_only_frames_with_a_cut_are_opened(monkeypatch):
    text = "".join(f"line {i}\n" for i in range(5000))
    frames, counts = infill.pack(text.encode(), 512)
    opened = []
    real = infill.unpack
    monkeypatch.setattr(infill, "unpack", lambda f: opened.append(len(f)) or real(f))
    out, prefix, middle = infill.rearrange(frames, counts, 5000, "psm", 1234, 3456)
    assert len(frames) > 80 and sum(opened) == 2 and prefix == len("".join(f"line {i}\n" for i in range(1234)))
    monkeypatch.setattr(infill, "unpack", real)
    assert b"".join(infill.restore(out, "psm")) == text.encode()
    counts_before = [sum(t.count(b"\n") for t in real(frames[:k])) for k in (1, 7)]
    assert [int(counts[k, 0]) for k in (1, 7)] == counts_before


def test_streams_hold_one_frame_at_a_time():
    raw = b"word and more words in a line\n" * 400_000
    frames, counts = infill.pack(raw)
    out, *_ = infill.rearrange(frames, counts, int(counts[-1, 0]), "spm", 1000, 390_000)
    tracemalloc.start()
    parts, begins, _ = infill.parts_of(out, "spm")
    total = sum(len(d) for d in infill.restore(out, "spm"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == len(raw) and peak < 3_000_000 < len(raw)
