"""Word-window dedup against counting all windows, and byte dedup at other lengths."""

import collections
import random

import pytest
from pyspark.sql import functions as F
from test_near import DOCS, plain_removal, texts

from refiscope.llm import base, rolling, suffix_dedup, word_windows


def plain_spans(rows, window, keep_first=True):
    """(doc_id, n_words, kept) by all windows of all texts; equal rows are one document."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone = collections.defaultdict(list), collections.defaultdict(set)
    words = {r: (r[1] or "").encode().split() for r in docs}
    for r in docs:
        for i in range(len(words[r]) - window + 1):
            seen[tuple(words[r][i : i + window])].append((r, i))
    for places in seen.values():
        for r, i in places[1:] if keep_first else places * (len(places) > 1):
            gone[r] |= set(range(i, i + window))
    return collections.Counter((r[0], len(words[r]), b" ".join(w for i, w in enumerate(words[r]) if i not in gone[r]).decode()) for r in rows)


def passages(seed=11):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "bé", "c", "dd", "e", "f f"]) + rng.choice(["", "x", "yy"])
    line = lambda n: " ".join(word() for _ in range(n))
    shared = [line(n) for n in (20, 21, 35, 80)]
    rows = [(i, line(rng.randrange(60))) for i in range(20)]
    rows += [(100 + i, f"{line(rng.randrange(30))} {rng.choice(shared)}\n\t{rng.choice(shared)} {line(rng.randrange(30))}") for i in range(25)]
    rows += [(200 + i, shared[3]) for i in range(12)] + [(300, "w " * 90), (301, "u v " * 40), (302, None), (303, ""), (304, " \n"), (305, line(19)), (None, shared[3]), (305, shared[2])]
    rows += [(400, rows[22][1]), rows[23], rows[23]]  # a copy; one row three times
    return rows


@pytest.mark.parametrize("window", [20, 3, 1])
def test_removal_spans(spark, window):
    rows = passages()
    rows = [r for r in rows if r != (305, rows[-7][1])] if window < 3 else rows
    docs = spark.createDataFrame(rows, DOCS).withColumn("k1", F.lit(1)).withColumn("anchor", F.lit(2)).repartition(5)
    got = word_windows.removal_spans(docs, window).collect()
    by_id = collections.Counter(r[0] for r in set(rows))
    once = [r for r in rows if by_id[r[0]] == 1]  # equal ids with different texts are ordered by a hash
    expected = plain_spans(rows, window)
    assert len(got) == len(rows)
    mine = collections.Counter((r.doc_id, r.n_words, r.kept) for r in got)
    assert {k: n for k, n in mine.items() if by_id[k[0]] == 1} == {k: n for k, n in expected.items() if by_id[k[0]] == 1} and once
    for r in got:
        assert sum(e - b for b, e in zip(r.begins, r.ends)) == r.n_words - len(r.kept.split(" ") if r.kept else [])
        assert all(e < b for e, b in zip(r.ends, r.begins[1:]))  # maximal


def test_removal_spans_of_blocks_and_no_rows(spark, monkeypatch):
    rows = [r for r in passages(12) if r[0] != 305]
    monkeypatch.setattr(word_windows, "_BLOCK", 40)
    named = [(r[0], rolling.word_digests((r[1] or "").encode())) for r in rows]
    whole = {i: word_windows.runs_of(v) for i, v in named}
    assert any(len(p) > 1 for p in whole.values())
    docs = spark.createDataFrame(rows, DOCS)
    got = collections.Counter((r.doc_id, r.n_words, r.kept) for r in word_windows.removal_spans(docs).collect())
    assert got == plain_spans(rows, 20)
    assert word_windows.removal_spans(docs.limit(0)).count() == 0


def test_rolling_fingerprints_agree_with_the_words():
    rng = random.Random(2)
    raw = b" ".join(rng.choice([b"a", b"b", b"cc"]) for _ in range(3000))
    values = rolling.word_digests(raw)
    words = raw.split()
    prints = rolling.Rolling(values).windows(6)
    by_print = collections.defaultdict(set)
    for i, p in enumerate(prints.tolist()):
        by_print[p].add(tuple(words[i : i + 6]))
    assert all(len(s) == 1 for s in by_print.values()) and len(by_print) == len({tuple(words[i : i + 6]) for i in range(len(words) - 5)})
    pieces = list(rolling.pieces(raw, 100))
    assert b"".join(pieces) == raw and len(pieces) > 20 and [w for p in pieces for w in p.split()] == words


@pytest.mark.parametrize("length,bucket", [(50, 8192), (255, 8192), (255, 1), (20, 8192), (3, 8192)])
def test_suffix_dedup_of_other_lengths(spark, monkeypatch, length, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rows = texts()
    got = suffix_dedup.removal_report(spark.createDataFrame(rows, DOCS), length).collect()
    assert collections.Counter(tuple(r) for r in got) == plain_removal(rows, length)


def test_cover_ranks_are_the_order_of_the_strings():
    import numpy as np

    rng = random.Random(3)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(900)), np.uint8)
    blocks = 5
    rank = suffix_dedup._cover_ranks(suffix_dedup.Ordered(data), len(data), blocks)
    at = [p + c for p in range(0, len(data) - len(data) % 21, 21) for c in suffix_dedup.COVER]
    held = [(r, data[p : p + 21 * blocks].tobytes()) for r, p in zip(rank.tolist(), at) if p + 21 * blocks <= len(data)]
    ordered = sorted(held)
    assert [s for _, s in ordered] == sorted(s for _, s in held)
    assert all((a[0] == b[0]) == (a[1] == b[1]) for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("words", [5, 51])
def test_words_that_occur_twice(spark, words):
    rows = [r for r in passages(13) if r[0] not in (305, None)]
    rows = list(dict.fromkeys(rows))
    got = suffix_dedup.removal_report(spark.createDataFrame(rows, DOCS), 10_000, words=words).collect()
    expected = plain_spans(rows, words, keep_first=False)
    lost = {i: n - len(kept.split(" ") if kept else []) for i, n, kept in expected}
    assert {r.doc_id: r.n_word_repeats for r in got} == lost and sum(lost.values())
    cut = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS), 10_000, words=words).collect()
    assert {r.doc_id: len((r.text or "").encode().split()) for r in cut} == {i: n - lost[i] for i, n, _ in expected}


def counted(monkeypatch, module, name):
    made, real = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a: made.append(a) or real(*a))
    return made


def test_repeated_runs_are_one_row_a_place(spark):
    rng = random.Random(3)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared, found = line(120), []
    for copies in (30, 60):
        rows = spark.createDataFrame([(i, None, (line(10) + " " + shared + " " + line(10)).encode()) for i in range(copies)], "k1 bigint, k2 bigint, raw binary")
        runs = word_windows.repeated_windows(rows.withColumn("k2", F.xxhash64("raw")), 51, keep_first=False)
        assert "LeftSemi" in runs._jdf.queryExecution().optimizedPlan().toString()  # no run meets another one
        found.append(runs.count())
        assert runs.count() == runs.distinct().count()
    # Not four times as many: twice, but for what the words around a passage do to the first and last run.
    assert 0 < found[0] < found[1] <= 2.5 * found[0]


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(base, "BATCH_ROWS", 50)
    try:
        docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("all the same "), 9), "id").alias("text"))
        cut = suffix_dedup.remove_repeats(docs, 40)
        sizes = cut.coalesce(1).mapInPandas(lambda batches: (b[["doc_id"]].assign(doc_id=len(b))[:1] for b in batches), "doc_id bigint").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(sizes) >= 8 and max(r.doc_id for r in sizes) <= 50


def test_short_texts_are_digested_together(monkeypatch):
    import numpy as np

    rng = random.Random(6)
    raws = [bytes(rng.choice(b"ab ") for _ in range(rng.randrange(0, 900))) for _ in range(300)]
    alone = [(i, *row) for i, raw in enumerate(raws) for _, *part in suffix_dedup.anchors([raw]) for row in zip(*(p.tolist() for p in part))]
    made = counted(monkeypatch, suffix_dedup, "Digests")
    parts = suffix_dedup.anchors(raws)
    assert sorted(row for part in parts for row in zip(*(p.tolist() for p in part))) == sorted(alone)
    assert 1 <= len(made) <= 5  # one a text before
    words = [rolling.word_digests(raw) for raw in raws]
    alone = [(i, *row) for i, v in enumerate(words) for part in word_windows.runs_of(v) for row in zip(*(np.asarray(p).tolist() for p in part))]
    made = counted(monkeypatch, word_windows, "Rolling")
    parts = word_windows.runs_of_texts(words)
    assert sorted(row for part in parts for row in zip(*(p.tolist() for p in part))) == sorted(alone)
    assert 1 <= len(made) <= 3


@pytest.mark.parametrize("length", [1, 7, 9, 20, 22, 43, 64, 400])
def test_lone_suffixes_are_not_sorted(monkeypatch, length):
    import numpy as np

    rng = random.Random(length)
    for _ in range(40):
        base = bytes(rng.choice(b"ab") for _ in range(length + 60))
        contexts = [bytearray(base[rng.randrange(20) :][: length + rng.randrange(40)]) for _ in range(rng.randrange(1, 8))]
        for c in contexts:
            if rng.random() < 0.6:
                c[rng.randrange(len(c))] ^= 3
        contexts = [bytes(c) for c in contexts]
        group, offsets, copies = ([rng.randrange(a, b) for _ in contexts] for a, b in ((0, 2), (0, 30), (1, 3)))
        total = collections.Counter()
        for g, o, n, c in zip(group, offsets, copies, contexts):
            for s in range(len(c) - length + 1):
                total[g, o - s, c[s : s + length]] += n
        found = suffix_dedup.repeated(np.array(group), contexts, np.array(offsets), np.array(copies), length)
        expected = [[total[g, o - s, c[s : s + length]] >= 2 for s in range(len(c) - length + 1)] for g, o, c in zip(group, offsets, contexts)]
        assert [f.tolist() for f in found] == expected
    apart = [bytes([i]) * (length + 5) for i in range(97, 105)]
    made = counted(monkeypatch, suffix_dedup, "_suffix_keys")
    found = suffix_dedup.repeated(np.zeros(8, int), apart, np.zeros(8, int), np.ones(8, int), length)
    assert not any(f.any() for f in found) and not made  # all were sorted before
