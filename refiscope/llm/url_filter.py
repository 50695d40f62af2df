"""URL filters: longest-match rules before an exact Bloom-filter cascade.

A cascade answers "is this key listed?" exactly for every key of a known universe and holds far
fewer bits than the keys. Level 0 encodes the listed keys, level 1 the unlisted keys of the
universe that level 0 lets through, level 2 the listed keys that level 1 lets through, and so on
until a level lets nothing through. The first level that misses decides.

A page is tested inside its own row against the levels, which travel as literals: no join and no
shuffle of the pages. One cascade holds at most ``max_bits``; a longer list is split by key hash
into several cascades, which are applied one after the other over a staged table, so that what is
sent to the executors stays bounded at every length of the list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .base import ascii_lower, fresh


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    seed: int
    words: tuple[int, ...]


@dataclass(frozen=True)
class Cascade:
    """Levels for the keys of one shard of ``shards``."""

    shard: int
    shards: int
    levels: tuple[Level, ...]

    @property
    def bits(self) -> int:
        return sum(level.bits for level in self.levels)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = _rest(url)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def domains(host: Column) -> Column:
    """The host and its parent domains, at every length; none for an empty host."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    parents = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(parents)


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards))


def _position(key: Column, level_bits: int, seed: int, i: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(i), key), F.lit(level_bits))


def _hit(key: Column, level: Level) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")  # folded to one literal
    test = F.lit(True)
    for i in range(level.hashes):
        at = _position(key, level.bits, level.seed, i)
        word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
        test = test & (F.getbit(word, (at % 64).cast("int")) == 1)
    return test


def _build_level(positives: DataFrame, n: int, per_key: float, hashes: int, seed: int) -> Level:
    bits = max(64, math.ceil(n * per_key / 64) * 64)
    at = F.explode(F.array(*[_position(F.col("key"), bits, seed, i) for i in range(hashes)]))
    rows = (
        positives.select(at.alias("at"))
        .groupBy(F.floor(F.col("at") / 64).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits"))
        .collect()  # at most bits / 64 rows, and bits is bounded by the shard
    )
    words = [0] * (bits // 64)
    for r in rows:
        words[r["word"]] = r["bits"]
    return Level(bits, hashes, seed, tuple(words))


def build_cascades(keys: DataFrame, max_bits: int = 1 << 24) -> list[Cascade]:
    """``keys``: key string, listed boolean, one row per key of the universe (null keys are left out;
    of repeated keys one listed row suffices).

    The first level takes about log2(unlisted / listed) bits a key, the later ones 1.44 bits each.
    """
    keys = stage(keys.where("key is not null").groupBy("key").agg(F.max("listed").alias("listed")), "url-keys")
    n, listed = keys.agg(F.count("*"), F.coalesce(F.sum(F.col("listed").cast("bigint")), F.lit(0))).first()
    ratio = max(2.0, (n - listed) / max(1, listed))
    per_key = max(2.0, 1.44 * math.log2(ratio))
    shards = max(1, math.ceil(listed * per_key * 2 / max_bits))
    out = []
    for shard in range(shards):
        alive = keys.where(_shard(F.col("key"), shards) == shard).select("key", F.col("listed").alias("side"))
        levels: list[Level] = []
        while (count := alive.where("side").count()) > 0:
            first = not levels
            level = _build_level(
                alive.where("side"), count, per_key if first else 2.0,
                max(1, round(per_key * math.log(2))) if first else 1, len(levels),
            )
            levels.append(level)
            alive = stage(alive.where(_hit(F.col("key"), level)).select("key", (~F.col("side")).alias("side")), "url-level")
        out.append(Cascade(shard, shards, tuple(levels)))
    return out


def listed_in(key: Column, cascade: Cascade) -> Column:
    """Whether a key of the universe is listed; false outside the cascade's shard."""
    answer = F.lit(len(cascade.levels) % 2 == 1)
    for i, level in reversed(list(enumerate(cascade.levels))):
        answer = F.when(_hit(key, level), answer).otherwise(F.lit(i % 2 == 1))
    return (_shard(key, cascade.shards) == cascade.shard) & answer


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Longest rule (block before allow at equal length) as struct(text, verdict); null if none fits."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, cascades: Sequence[Cascade], rules: Sequence[Rule] = (), url: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict; every row and every other column stays (columns of those
    four names are replaced).

    A page is blocked by the method if its host or one of its parent domains is listed. Null urls
    and urls without ``://`` have an empty host and path and are allowed. With several cascades it is
    the distinct hosts that are staged from one to the next, never the pages.
    """
    blocked, rule = fresh(pages, "blocked"), fresh(pages, "fitting_rule")
    df = pages.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    filled = [c for c in cascades if c.levels]
    if len(filled) < 2:
        df = df.withColumn(blocked, _listed(filled[0]) if filled else F.lit(False))
    else:
        hosts = df.select("host").distinct().withColumn("blocked", F.lit(False))
        for cascade in filled:
            hosts = stage(hosts.withColumn("blocked", F.col("blocked") | _listed(cascade)), "hosts-judged")
        listed = hosts.where("blocked").select("host", F.lit(True).alias(blocked))
        columns = df.columns
        df = df.join(listed, "host", "left").select(*[F.col(f"`{c}`") for c in columns], blocked)
    return (
        df.withColumn(rule, matching_rule(F.col("host"), F.col("path"), rules))
        .withColumn("rule", F.col(rule)["text"])
        .withColumn("verdict", F.coalesce(F.col(rule)["verdict"], F.when(F.col(blocked), "block").otherwise("allow")))
        .drop(rule, blocked)
    )


def _listed(cascade: Cascade) -> Column:
    """Whether the host or one of its parent domains is listed."""
    return F.exists(domains(F.col("host")), lambda d: listed_in(d, cascade))


def universe(pages: DataFrame, url: str = "url") -> DataFrame:
    """Every domain that a page of the corpus can ask for, once."""
    hosts = pages.select(url_host(F.col(url)).alias("host")).distinct()
    return hosts.select(F.explode(domains(F.col("host"))).alias("key")).distinct()
