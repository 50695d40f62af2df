"""SimHash near-duplicates by covering locality-sensitive hashing.

For radius r every bit position gets a vector of r + 1 binary digits. Each non-zero vector v of that
length makes one table: its mask keeps the positions whose vector has odd overlap with v. Two
fingerprints that differ in at most r positions involve at most r vectors, to which some v is
orthogonal, and in the table of that v both keep the same bits: every pair within the radius meets
in some table, none is left to chance.

Only different fingerprints are hashed, so copies cost nothing. A bucket of two is decided by its
two ends. A larger one is dealt into chunks, and every pair of chunks is compared in a task of its
own, which returns a spanning forest and no pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .components import components

BITS = 64
SEED = 42
CHUNK = 128
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, width: int = 4) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included; zero without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    ends = ends[min(width, len(words)) - 1 :].tolist()
    starts = starts[:n].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _AT_ONCE):
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + _AT_ONCE], ends[at : at + _AT_ONCE])]
        raw = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(text: Column) -> Column:
    @F.pandas_udf("bigint")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return prints(text)


def masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask a table, signed; position i has vector 1 + i mod (2^(r+1) - 1)."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + i % size for i in range(bits)]
    out = []
    for v in range(1, size + 1):
        mask = sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
        out.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return out


def _near(x: Column, y: Column, radius: int) -> Column:
    return F.bit_count(x.bitwiseXOR(y)) <= radius


def _forest(radius: int):
    @F.pandas_udf("array<struct<a:bigint,b:bigint>>")
    def forest(all_prints: pd.Series, all_nodes: pd.Series) -> pd.Series:
        out = []
        for prints, nodes in zip(all_prints, all_nodes, strict=True):
            prints, nodes = prints.view(np.uint64), nodes.tolist()
            near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
            labels = np.arange(len(nodes))
            while True:
                least = np.where(near, labels[None, :], len(nodes)).min(1)
                if (least == labels).all():
                    break
                labels = least
            out.append([{"a": nodes[i], "b": nodes[k]} for i, k in enumerate(labels.tolist()) if i != k])
        return pd.Series(out)

    return forest


def links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Edges a, b between the nodes of ``prints`` (print, node; each print once) that connect exactly
    what chains of pairs within the radius connect."""
    tables = prints.select("print", "node", F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(m)) for m in masks(radius)])).alias("table", "key"))
    ends = F.struct("print", "node")
    buckets = tables.groupBy("table", "key").agg(F.count("*").alias("n"), F.min(ends).alias("lo"), F.max(ends).alias("hi")).where("n > 1")
    buckets = stage(buckets, "simhash-buckets")
    pairs = buckets.where("n = 2").where(_near(F.col("lo.print"), F.col("hi.print"), radius)).select(F.col("lo.node").alias("a"), F.col("hi.node").alias("b"))

    large = buckets.where("n > 2").select("table", "key", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    members = tables.join(large, ["table", "key"])
    chunk = F.pmod(F.xxhash64("print"), F.col("chunks"))
    dealt = members.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    groups = dealt.groupBy("table", "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")).agg(
        F.sort_array(F.collect_list(F.struct("node", "print"))).alias("group"))
    trees = groups.where(F.size("group") > 1).select(F.explode(_forest(radius)(F.col("group.print"), F.col("group.node"))).alias("e")).select("e.a", "e.b")
    return pairs.unionByName(trees).distinct()


def near_groups(docs: DataFrame, radius: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, print (signed 64 bits) and component_id for every row of ``docs``.

    Null and empty texts have print zero and are linked like any other. Repeated rows stay. A null
    doc_id keeps a null component unless another document has its print, and lends its id to nobody.
    """
    own = stage(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), fingerprints(F.col(text)).alias("print")), "simhash-prints")
    prints = stage(own.groupBy("print").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    roots = components(links(prints.where("node is not null"), radius))
    known = prints.join(roots, "node", "left").select("print", F.coalesce("root", "node").alias("component_id"))
    return own.join(stage(known, "simhash-roots"), "print")


def one_of_each(docs: DataFrame, radius: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id names their group, all columns as they were. Rows that share
    a doc_id are one document; rows without one stay."""
    groups = near_groups(docs, radius, doc_id, text).where("doc_id <> component_id").select("doc_id").distinct()
    gone = stage(groups, "simhash-gone").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs[doc_id].cast("bigint") == gone["_gone"], "left_anti")


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
