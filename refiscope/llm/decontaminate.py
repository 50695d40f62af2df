"""Benchmark decontamination by canonical templates.

Numbers, number words, units and names become typed placeholders, so a question with other values
has the same template. Windows of template tokens of all documents meet the benchmark's windows in
a hash join. Along one alignment of a document with an item every value of a placeholder must
stand for one value of the item: this slot check keeps re-parameterised questions and drops texts
that only share the shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .base import keyed

#: A number or a word; the first one of a sentence keeps the end of the sentence before it. No part can
#: give back what the next one needs, so none keeps places to return to.
TOKEN = r"(?:[.!?:\n][^\p{L}\p{N}]*+)?+(?:[0-9]++(?:[.,][0-9]++)*+|\p{L}[\p{L}\p{M}]*+)"
# Words read as numbers and as units.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
                "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half third quarter dozen").split()
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres g kg mg gram grams kilogram kilograms ounce ounces pound pounds "
         "ton tons l ml liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
         "cent cents dollar dollars euro euros usd eur percent degree degrees celsius fahrenheit mph kmh watt watts volt volts").split()
NUMBER, UNIT, NAME = "#number", "#unit", "#name"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit("."), text), F.lit(TOKEN), F.lit(0))


def _opens(token: Column) -> Column:
    return F.ascii(token).isin(*map(ord, ".!?:\n"))


def word(token: Column) -> Column:
    """The token in lower case, without the end of an earlier sentence."""
    return F.lower(F.when(_opens(token), F.regexp_replace(token, r"^[^\p{L}\p{N}]+", "")).otherwise(token))


def placeholder(token: Column, low: Column) -> Column:
    """Placeholder of a token, or ``low``, the token as ``word`` makes it. A name is a capitalised word
    within a sentence; words all in capitals are no names, so a text in capitals matches as well."""
    name = (low != token) & ~_opens(token) & (F.upper(token) != token)
    return (
        F.when(F.ascii(low).between(ord("0"), ord("9")), NUMBER)
        .when(name, NAME).when(low.isin(NUMBER_WORDS), NUMBER).when(low.isin(UNITS), UNIT).otherwise(low)
    )


def canonical(raw: Column) -> Column:
    """Template of an array of tokens; every token is put in lower case once."""
    return F.zip_with(raw, F.transform(raw, word), placeholder)


def _windows(hashes: Column, width: int) -> Column:
    n = F.size(hashes)
    at = F.sequence(F.lit(1), n - width + 1)
    return F.when(n >= width, F.transform(at, lambda i: F.xxhash64(F.slice(hashes, i, width)))).otherwise(F.array().cast("array<bigint>"))


def benchmark_items(benchmark: DataFrame, width: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, part (names the item's text), raw, low, kinds, width, all: every different item with the number of its windows.

    An item of under ``width`` tokens is one window of its own length. Null texts give none; equal
    items of several ids each count.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("raw")).where("size(raw) > 0").distinct()
    items = items.withColumn("low", F.transform("raw", word)).withColumn("kinds", F.zip_with("raw", "low", placeholder))
    items = items.withColumn("part", F.xxhash64("raw")).withColumn("width", F.least(F.lit(width), F.size("raw")))
    return stage(items.withColumn("all", F.size("raw") - F.col("width") + 1), "benchmark-items")


def benchmark_windows(items: DataFrame) -> DataFrame:
    """item_id, part, ipos, width, window: by what the items' windows are looked up.

    Every window stands with its literal tokens in lower case; one of which at least a third are
    words also with its template. The first word of a sentence may be read as a name where the text
    before it is another, so it stands in templates both ways.
    """
    every = items.select("item_id", "part", "raw", "low", "kinds", "width", F.explode(F.sequence(F.lit(1), F.col("all"))).alias("ipos"))
    cut = every.select("item_id", "part", "ipos", "width", *[F.slice(c, F.col("ipos"), F.col("width")).alias(c) for c in ("raw", "low", "kinds")])
    plain = F.size(F.filter("kinds", lambda k: ~F.startswith(k, F.lit("#"))))
    first = F.zip_with("raw", "low", lambda t, low: _opens(t) & ~F.endswith(t, low))  # capitalised
    ways = F.aggregate(
        F.arrays_zip("kinds", first.alias("first")), F.array(F.array().cast("array<bigint>")),
        lambda found, s: F.concat(
            F.transform(found, lambda f: F.concat(f, F.array(F.xxhash64(s["kinds"])))),
            F.when(s["first"], F.transform(found, lambda f: F.concat(f, F.array(F.xxhash64(F.lit(NAME)))))).otherwise(F.array().cast("array<array<bigint>>"))))
    literal = F.array(F.transform("low", lambda k: F.xxhash64(k)))
    ways = F.concat(literal, F.when(plain * 3 >= F.col("width"), ways).otherwise(F.array().cast("array<array<bigint>>")))
    windows = cut.select("item_id", "part", "ipos", "width", F.explode(F.transform(ways, lambda w: F.xxhash64(w))).alias("window"))
    return stage(windows.distinct(), "benchmark-windows")


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 8, share: float = 0.8, enough: int = 6) -> DataFrame:
    """``docs`` as ``base.keyed`` makes it. k1, k2, item_id, n_windows of every document and item that
    have ``share`` of all of the item's windows in common, or ``enough`` of them, with consistent slots.

    A window that is found gives an alignment; along it all tokens are compared, literally in lower
    case or by their placeholders.
    """
    items = benchmark_items(benchmark, width)
    index = benchmark_windows(items)
    widths = sorted(r["width"] for r in index.select("width").distinct().collect())  # at most ``width`` rows
    known = stage(index.select("width", "window").distinct(), "benchmark-hashes")
    own = docs.select("k1", "k2", tokens(F.col("text")).alias("raw"))
    own = own.select("k1", "k2", "raw", F.transform("raw", word).alias("low"))
    own = own.select("k1", "k2", F.zip_with("raw", "low", lambda t, low: F.xxhash64(placeholder(t, low))).alias("hashes"), F.transform("low", lambda t: F.xxhash64(t)).alias("literal"))
    found = None
    for w in widths:
        # Both kinds of windows in one array: a place is found modulo their number.
        both = F.posexplode(F.concat(_windows(F.col("hashes"), w), _windows(F.col("literal"), w)))
        one = own.select("k1", "k2", (F.size("hashes") - w + 1).alias("n"), both.alias("dpos", "window")).withColumn("dpos", F.col("dpos") % F.col("n"))
        one = one.join(known.where(F.col("width") == w).select("window"), "window", "left_semi")
        one = one.select("k1", "k2", "window", F.lit(w).alias("width"), (F.col("dpos") + 1).alias("dpos"))
        found = one if found is None else found.unionByName(one)
    schema = "k1 bigint, k2 bigint, item_id bigint, n_windows bigint"
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    found = stage(found.distinct(), "benchmark-found")
    shift = (F.col("dpos") - F.col("ipos")).alias("shift")
    aligned = stage(found.join(index, ["width", "window"]).select("k1", "k2", "item_id", "part", shift).distinct(), "benchmark-aligned")

    touched = docs.join(aligned.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    touched = stage(touched.select("k1", "k2", tokens(F.col("text")).alias("draw")), "benchmark-texts")
    pairs = aligned.join(touched, ["k1", "k2"])
    item = items.select(F.col("item_id").alias("own_id"), F.col("part").alias("own_part"), "low", "kinds", "width", "all")
    pairs = pairs.join(item, F.col("item_id").eqNullSafe(F.col("own_id")) & (F.col("part") == F.col("own_part")))
    facing = F.transform(F.sequence(F.lit(0), F.size("low") - 1), lambda i: F.get("draw", i + F.col("shift")))
    # Written between the steps: filters that are pushed below would compute the arrays over and over.
    pairs = stage(pairs.select("k1", "k2", "item_id", "part", "low", "kinds", "width", "all", facing.alias("draw")), "benchmark-facing")
    pairs = pairs.withColumn("dlow", F.transform("draw", word)).withColumn("dkinds", F.zip_with("draw", "dlow", placeholder))
    alike = F.transform(F.arrays_zip("low", "kinds", "dlow", "dkinds"), lambda s: F.coalesce((s["low"] == s["dlow"]) | (s["kinds"] == s["dkinds"]), F.lit(False)))
    pairs = pairs.select("k1", "k2", "item_id", "part", "low", "kinds", "dlow", "width", "all", alike.alias("alike"))
    pairs = stage(pairs, "benchmark-alike")
    whole = F.filter(F.sequence(F.lit(1), F.col("all")), lambda i: F.forall(F.slice("alike", i, F.col("width")), lambda x: x))
    pairs = stage(pairs.withColumn("ipos", whole).drop("alike"), "benchmark-compared").where("size(ipos) > 0")
    slots = F.filter(
        F.transform(F.arrays_zip("low", "kinds", "dlow"), lambda s, i: F.struct(s["kinds"].alias("kind"), s["low"].alias("value"), s["dlow"].alias("given"), i.alias("i"))),
        lambda s: F.startswith(s["kind"], F.lit("#")) & F.exists("ipos", lambda p: (s["i"] >= p - 1) & (s["i"] < p - 1 + F.col("width"))))
    pairs = stage(pairs.select("k1", "k2", "item_id", "part", "all", "ipos", slots.alias("slots")), "benchmark-slots")
    values = F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["value"]))))
    given = F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["value"], s["given"]))))
    counted = (
        pairs.where(values == given)
        .select("k1", "k2", "item_id", "part", "all", F.explode("ipos").alias("ipos")).distinct()
        .groupBy("k1", "k2", "item_id", "part", "all").agg(F.count("*").alias("n_windows"))
    )
    needed = F.least(F.ceil(F.col("all") * share - 1e-9), F.lit(enough))
    return counted.where(F.col("n_windows") >= needed).groupBy("k1", "k2", "item_id").agg(F.max("n_windows").alias("n_windows"))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 8, share: float = 0.8, enough: int = 6,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, contaminated, item_ids (sorted), n_windows (most of one item) of every row.

    Null and empty texts are clean; repeated rows stay; only the two columns are read.
    """
    named = keyed(docs, doc_id, text)
    found = matches(named, benchmark, width, share, enough)
    found = stage(found.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("n_windows").alias("n_windows")), "benchmark-docs")
    joined = named.select("doc_id", "k1", "k2").join(found, ["k1", "k2"], "left")
    return joined.select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("n_windows", F.lit(0).cast("bigint")).alias("n_windows"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 8, share: float = 0.8, enough: int = 6,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark item in them, all columns as they were."""
    found = stage(matches(keyed(docs, doc_id, text), benchmark, width, share, enough).select("k1", "k2").distinct(), "benchmark-dirty")
    k1 = F.coalesce(docs[doc_id].cast("bigint"), F.lit(-(1 << 63)))
    k2 = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    return docs.join(found, (k1 == found["k1"]) & (k2 == found["k2"]), "left_anti")
