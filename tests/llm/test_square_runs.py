"""Periodic runs against a search over all periods."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refiscope.llm import queries, square_runs

DOCS = "doc_id bigint, text string"


def plain_runs(words, least=24, times=3):
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                run = words[i : i + length]
                if not any(all(run[k] == run[k + r] for k in range(length - r)) for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbers(values):
    return (np.array(values, np.uint64) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_runs_of_words_appended_in_any_pieces(data):
    n = data.draw(st.integers(0, 120))
    values = data.draw(st.lists(st.integers(0, data.draw(st.integers(0, 3))), min_size=n, max_size=n))
    if n > 10 and data.draw(st.booleans()):
        a, p = data.draw(st.integers(0, n - 1)), data.draw(st.integers(1, max(1, n // 4)))
        values[a:] = [values[a + (i % p)] if a + (i % p) < n else 0 for i in range(n - a)]
    least = data.draw(st.sampled_from([3, 6, 24]))
    expected = plain_runs(values, least)
    assert square_runs.runs_of(numbers(values), least) == expected if n else True
    catchers, at = square_runs.SquareCatchers(), 0
    while at < n:
        step = data.draw(st.sampled_from([1, 1, 2, 5, 40]))
        catchers.append(numbers(values[at : at + step]))
        at += step
        if step == 40:
            assert catchers.runs(least) == plain_runs(values[:at], least)  # at any time
    assert catchers.runs(least) == expected


def test_a_run_grows_while_words_come():
    catchers = square_runs.SquareCatchers()
    for i in range(200):
        catchers.append(numbers([i % 5]))
        assert catchers.runs() == ([(0, i + 1, 5)] if i + 1 >= 24 else [])
    catchers.append(numbers([9, 9]))
    assert catchers.runs() == [(0, 200, 5)] and catchers.runs(2) == [(0, 200, 5)]
    with pytest.raises(ValueError):
        catchers.runs(24, 2)


def test_table(spark):
    rng = random.Random(6)
    line = lambda n: " ".join(rng.choice(["a", "b", "é", "d"]) for _ in range(n))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "w " * 30), (4, "w " * 30), (None, "x y z " * 20 + line(20)), (5, line(300)), (6, ("p q\n" * 40 + line(10)) * 3), (7, "one two"), (8, line(3000) + " end " + "k l m " * 3000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("runs", F.lit(0)).withColumn("n_words", F.lit(1))
    got = square_runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t in rows:
        words, r = (t or "").split(), by_id[i]
        if len(words) > 500:
            assert {(x.start, x.length, x.period) for x in r.runs} >= {(3001, 9000, 3)} and r.strongest.period in (1, 2, 3)
            continue
        runs = plain_runs(words)
        assert [(x.start, x.length, x.period) for x in r.runs] == runs and r.n_words == len(words)
        gone = {k for a, n, q in runs for k in range(a + q, a + n)}
        assert r.collapsed == " ".join(w for k, w in enumerate(words) if k not in gone)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (None if r.strongest is None else tuple(r.strongest)) == best
    assert square_runs.periodic_runs(docs.limit(0)).count() == 0


def test_ties_of_the_strongest_run():
    assert square_runs.top([(50, 30, 3), (10, 60, 6), (10, 40, 4)]) == (10, 40, 4)
    assert square_runs.top([(0, 10**15 + 1, 10**14), (5, 10**15, 10**14)]) == (0, 10**15 + 1, 10**14) and square_runs.top([]) is None


def test_query_repeats_words_of_a_tenth(spark, tmp_path):
    import zlib

    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 90))) for i in range(200)] + [(None, None)], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op13_square_runs"](spark, str(tmp_path)).collect()}
    for i in range(200):
        h, n = zlib.crc32(str(i).encode()), i % 90
        words = [f"w{k}" for k in range(n)]
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(words)
        assert got[i].n_runs == len(runs) and (got[i].start is None) == (not runs)
    assert sum(r.n_runs for r in got.values()) > 2
