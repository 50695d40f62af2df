"""Corpus cleaning in stages; each works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refiscope.llm import decontaminate, pieces, quality, simhash, suffix_dedup
from refiscope.llm.base import table
from refiscope.session import stage


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects.

    A null text is judged as empty; equal rows are judged alike and all stay or go; without labels of
    both kinds every document stays. All columns stay as they are.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash group.

    Null, empty and blank texts have fingerprint zero and are one group; of rows with the same id and
    text one stays; rows without an id stay. All columns stay as they are.
    """
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts what occurs twice out of the texts: passages of over 50 words and strings of 400 bytes; n_chars follows.

    Every copy goes, the first as well, and every row stays, with an empty text if nothing is left. Null
    texts stay null with n_chars 0; equal rows are places of their own, so all of them lose what they share.
    """
    cut = suffix_dedup.remove_repeats(docs, words=51)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.lit(0))).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item.

    Null and empty texts hold none; equal rows stay or go together. All columns stay as they are.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds what SentencePiece makes of every text: number of ids and digests of ids, decoded text and spans.

    A null text counts as empty (no ids); equal rows stay and get equal digests.
    """
    return pieces.digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", accept_quality),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_benchmark),
    ("sentencepiece", encode),
]

#: SQL can't express the stages; the tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between two stages the rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
