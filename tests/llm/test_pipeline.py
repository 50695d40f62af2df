"""Stages of the corpus pipeline, each against plain Python on its own input."""

import collections

from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from refiscope.llm import decontaminate, quality, simhash, suffix_dedup
from refiscope.session import stage


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    given = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality classifier", "simhash near-dedup", "suffix-array dedup", "benchmark decontamination", "sentencepiece"]

    good = stage(steps["quality classifier"](spark, docs, SF), "t1")
    scores = {r.doc_id: r.predicted for r in quality.score(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == {i for i, p in scores.items() if p}

    single = stage(steps["simhash near-dedup"](spark, good, SF), "t2")
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in good.collect()}
    kept = {r.doc_id for r in single.collect()}
    assert single.columns == columns and len({prints[i] for i in kept}) == len(kept)
    assert all(any((prints[i] ^ prints[k]) & (2**64 - 1) == 0 or ((prints[i] ^ prints[k]) & (2**64 - 1)).bit_count() <= 8 for k in kept) for i in prints)

    cut = stage(steps["suffix-array dedup"](spark, single, SF), "t3")
    removed = {r.doc_id: r.n_removed for r in suffix_dedup.removal_report(single).collect()}
    windows = collections.defaultdict(list)  # all stretches of 51 words
    for i in kept:
        words = given[i].encode().split()
        for at in range(len(words) - 50):
            windows[tuple(words[at : at + 51])].append(i)
    repeats = {i for places in windows.values() if len(places) > 1 for i in places}
    assert cut.columns == columns and repeats
    for r in cut.collect():
        assert len(r.text.encode()) <= len(given[r.doc_id].encode()) - removed[r.doc_id] and r.n_chars == len(r.text)
        assert (r.text != given[r.doc_id]) == (removed[r.doc_id] > 0 or r.doc_id in repeats)

    clean = stage(steps["benchmark decontamination"](spark, cut, SF), "t4")
    dirty = decontaminate.contaminated(cut, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count()
    assert clean.columns == columns and clean.count() == cut.count() - dirty

    last = steps["sentencepiece"](spark, clean, SF)
    assert last.where(F.col("n_tokens") > 0).count() == clean.where("text <> ''").count()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
