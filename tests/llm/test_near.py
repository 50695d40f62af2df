"""Near-duplicates: components, SimHash, multi-index; suffix dedup."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from conftest import SF
from pyspark.sql import functions as F

from refiscope.llm import multi_index, simhash, suffix_dedup
from refiscope.llm.components import components

DOCS = "doc_id bigint, text string"


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(7, 7), (5, 6), (5, 6)]
    got = {r.node: r.root for r in components(spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint")).collect()}
    expected = roots({n for e in edges for n in e}, edges)
    assert got == {n: r for n, r in expected.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("radius,bits", [(1, 12), (2, 12), (3, 16)])
def test_masks_cover_every_pair_within_the_radius(radius, bits):
    masks = simhash.masks(radius, bits)
    for flips in itertools.combinations(range(bits), radius):
        assert any(not any(m >> i & 1 for i in flips) for m in masks)
    assert all(m for m in masks)


def test_masks_cover_four_of_64():
    masks, rng = simhash.masks(4), random.Random(2)
    assert len(masks) == 31
    for _ in range(3000):
        flips = rng.sample(range(64), 4)
        assert any(not any((m >> i) & 1 for i in flips) for m in masks)


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_groups(spark, rows):
    got = simhash.near_groups(spark.createDataFrame(rows, DOCS).withColumn("print", F.lit("x"))).collect()
    prints = {i: plain_print(t) for i, t in rows}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = roots(prints, near)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.print & (2**64 - 1), r.component_id) for r in got} == {(i, prints[i], expected[i]) for i in prints}
    return len(near)


def test_simhash_groups(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(10_000, None), (10_001, ""), (10_002, " \n"), (10_003, "one"), (10_004, "One"), (10_005, "w " * 70_000), (10_006, "a b c")]
    check_groups(spark, rows)


def test_simhash_large_buckets_are_chunked(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 5)
    rng = random.Random(4)
    base = [str(rng.randrange(10**6)) for _ in range(400)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(400)] = str(rng.random())
        rows.append((i, " ".join(words)))
    assert check_groups(spark, rows) > 30


def test_one_of_each(spark):
    docs = spark.createDataFrame([(3, "a b c d e", 1), (1, "a b c d e", 2), (2, "other words here now", 3), (None, "a b c d e", 4)], DOCS + ", gone int")
    assert {tuple(r) for r in simhash.one_of_each(docs).collect()} == {(1, "a b c d e", 2), (2, "other words here now", 3), (None, "a b c d e", 4)}
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_multi_index_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "CHUNK", 16)  # cells of several chunks
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 24))
    hot = base[0] + 0.1 * rng.standard_normal((80, 24))
    near = base[1:60] + 0.2 * rng.standard_normal((59, 24))
    x = np.concatenate([base, hot, near, base[5:8], 7 * base[9:10]]).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x, strict=True)]
    odd = [(9001, None), (9002, [0.0] * 24), (9003, [1.0] * 23 + [float("inf")]), (9004, [1.0] * 23 + [None]), (9005, []), (9006, [1.0, 2.0]), (None, [3.0] + [0.0] * 23)]
    got = {r.vec_id: r for r in multi_index.near_vectors(spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>")).collect()}
    unit = {i: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for i, v in rows}
    links = [(a, b) for a, b in itertools.combinations(unit, 2) if unit[a] @ unit[b] >= 0.95]
    degree = collections.Counter(n for e in links for n in e)
    expected = roots(unit, links)
    found = sum(got[i].n_links for i in unit)
    assert all(got[i].n_links <= degree[i] for i in unit) and found >= 0.97 * 2 * len(links) > 100
    assert sum(got[i].component_id == expected[i] for i in unit) >= 0.99 * len(unit)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(9001, 9007))
    assert got[None].n_links == 0 and got[None].component_id is None


def test_multi_index_empty_and_recall_on_the_table(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert multi_index.near_vectors(vectors.limit(0)).count() == 0
    rows = vectors.collect()
    x = np.array([r.embedding for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    degree = (x @ x.T >= 0.95).sum(1) - 1
    got = {r.vec_id: r.n_links for r in multi_index.near_vectors(vectors).collect()}
    assert sum(got.values()) >= 0.9 * degree.sum() and all(got[r.vec_id] <= d for r, d in zip(rows, degree, strict=True))


def plain_removal(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        starts = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def texts():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(6))
    passage = "".join(word() for _ in range(120))
    rows = [(i, "".join(word() for _ in range(rng.randrange(150)))) for i in range(30)]
    rows += [(100 + i, rows[i][1] + passage[i : 500 + i] + rows[i + 1][1]) for i in range(12)]
    rows += [(200, "x" * 1300), (201, "yz" * 300 + "x" * 420), (202, passage), (202, passage), (203, None), (204, ""), (None, passage[:401]), (205, "q" * 399)]
    return rows


@pytest.mark.parametrize("bucket", [8192, 1])
def test_suffix_dedup(spark, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)  # sorted in tasks; counted by Spark
    rows = texts()
    docs = spark.createDataFrame(rows, DOCS).withColumn("k1", F.lit(1)).repartition(3)
    got = suffix_dedup.removal_report(docs).collect()
    assert collections.Counter(tuple(r) for r in got) == plain_removal(rows, 400)
    assert sum(r.n_removed for r in got) > 5000


def test_suffix_dedup_long_texts_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_STARTS_AT_ONCE", 97)
    rows = texts()[-16:]
    got = suffix_dedup.removal_report(spark.createDataFrame(rows, DOCS)).collect()
    assert collections.Counter(tuple(r) for r in got) == plain_removal(rows, 400)


def test_remove_repeats_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a" * 900, 1), (2, "short", 2), (3, None, 3)], DOCS + ", raw int")
    got = suffix_dedup.remove_repeats(docs)
    assert got.columns == docs.columns and {tuple(r) for r in got.collect()} == {(1, "", 1), (2, "short", 2), (3, None, 3)}
    assert suffix_dedup.removal_report(docs.limit(0)).count() == 0


def test_stage_cuts_passages_of_over_50_words_below_400_bytes(spark):
    import corpus_pipeline

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgü") for _ in range(rng.randrange(1, 9)))
    rows, left = [], {}
    for n in range(50, 71):
        passage = " ".join("".join(rng.choice("klmnop") for _ in range(1 + i % 8)) for i in range(n))
        assert n < 51 or len(passage.encode()) < 400
        for k in range(2):
            own = [" ".join(word() for _ in range(40)) for _ in range(2)]
            rows.append((2 * n + k, f"{own[0]} {passage if k else passage.replace(' ', '  ')} {own[1]}", 0))
            left[2 * n + k] = " ".join(own).split() if n > 50 else rows[-1][1].split()
    docs = spark.createDataFrame(rows, DOCS + ", n_chars bigint")
    got = corpus_pipeline.cut_repeats(spark, docs, "").collect()
    assert {r.doc_id: r.text.split() for r in got} == left and all(r.n_chars == len(r.text) for r in got)


def test_cover_differences_are_complete():
    pairs = {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER}
    assert pairs == set(range(suffix_dedup.PERIOD))
