"""URL filters, license scans and decontamination."""

import random
import textwrap

from pyspark.sql import functions as F

from refiscope.llm import decontaminate, licences, url_filter
from refiscope.llm.base import keyed

DOCS = "doc_id bigint, text string"


def test_cascades_are_exact_for_every_key(spark):
    rng = random.Random(3)
    keys = [(f"{rng.randrange(10**9)}.example.org", rng.random() < 0.2) for _ in range(700)] + [(None, True), ("", False)]
    df = spark.createDataFrame(keys, "key string, listed boolean")
    for bits in (1 << 24, 500):  # one cascade; several
        cascades = url_filter.build_cascades(df, bits)
        assert (len(cascades) > 1) == (bits == 500)
        found = F.lit(False)
        for c in cascades:
            if c.levels:
                found = found | url_filter.listed_in(F.col("key"), c)
        wrong = df.where("key is not null").where(found != F.col("listed"))
        assert wrong.count() == 0
        assert sum(c.bits for c in cascades) < 700 * 64  # far fewer than the keys


def test_urls(spark):
    rows = [(1, "HTTP://A.Example.NET/en/x?y#z"), (2, "http://example.net"), (3, None), (4, "no scheme"), (5, "x://b.org/fr/"), (6, "x://example.com/de/1"),
            (7, "x://notexample.com/de/1"), (8, "a://b://c.net/"), (9, "x://spam.good.example.com/"), (9, "x://spam.good.example.com/"), (10, "")]
    pages = spark.createDataFrame([(i, u, "old") for i, u in rows], "page_id int, url string, host string")
    keys = url_filter.universe(pages).withColumn("listed", F.col("key") == "good.example.com")
    rules = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"), url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]
    got = url_filter.judge(pages, url_filter.build_cascades(keys), rules).orderBy("page_id").select("page_id", "host", "path", "rule", "verdict").collect()
    assert [tuple(r) for r in got] == [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "example.net", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"),
        (5, "b.org", "/fr/", "org/fr/", "allow"), (6, "example.com", "/de/1", "example.com/de/", "block"), (7, "notexample.com", "/de/1", None, "allow"),
        (8, "b:", "//c.net/", None, "allow"), (9, "spam.good.example.com", "/", None, "block"), (9, "spam.good.example.com", "/", None, "block"), (10, "", "", None, "allow")]
    for part in (8, 4):  # cascades over parts of the keys give the same; names that the work needs inside may be taken
        several = url_filter.build_cascades(keys, part)
        assert sum(bool(c.levels) for c in url_filter.build_cascades(keys.withColumn("listed", F.col("key").endswith("com")), part)) > 1
        taken = pages.withColumn("blocked", F.lit("b")).withColumn("Fitting_Rule", F.lit("r"))
        again = url_filter.judge(taken, several, rules).orderBy("page_id")
        assert {(r.blocked, r.Fitting_Rule) for r in again.collect()} == {("b", "r")}
        assert again.select("page_id", "host", "path", "rule", "verdict").collect() == got
    com = keys.withColumn("listed", F.col("key").endswith("com"))
    one, many = ({(r.url, r.verdict) for r in url_filter.judge(pages, url_filter.build_cascades(com, bits), rules).collect()} for bits in (1 << 24, 4))
    assert one == many and {v for _, v in one} == {"allow", "block"}
    empty = url_filter.judge(pages.limit(0), url_filter.build_cascades(keys.limit(0)), rules)
    assert empty.count() == 0


def test_license_edges(spark):
    rows = [(1, None), (2, ""), (3, "MIT\n License mit-license"), (4, "licensed under CC by nc\n4.0"), (5, "licensed under the CC BY NC 4.0!"), (None, "General Public LicenseX"), (5, "mit license"),
            (6, "général public license"), (7, "word " * 30_000 + "apache license")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("labels", F.lit("x"))
    got = {(r.doc_id, r.n_words): r for r in licences.scan(docs).collect()}
    assert len(got) == len(rows)
    assert got[(1, 0)].n_base == 0 and got[(2, 0)].labels == "" and got[(2, 0)].first_word is None and got[(2, 0)].score == 0
    three = got[(3, 4)]
    assert (three.n_base, three.first_word, three.last_word, three.base_labels, three.score) == (2, 0, 2, "mit", 1.0)
    assert got[(4, 7)].labels == "cc-by-nc" and got[(5, 8)].labels == "cc-by-nc" and got[(5, 8)].base_labels == ""
    assert got[(None, 3)].n_base == 0 and got[(6, 3)].n_base == 0
    assert got[(7, 30_002)].first_word == 30_000
    assert licences.scan(docs.limit(0)).count() == 0


def test_licenses_wrapped_over_lines(spark):
    texts = [t for label, t in licences.TEMPLATES if len(t) > 90]
    other = "Words of another kind that stand before and after it, "
    rows, want = [], []
    for label, whole in licences.TEMPLATES:
        for width in (24, 40, 72):
            for lead, comment in (("", ""), (other * 3, "# "), (other + "\n", " * ")):
                rows.append((len(rows), "\n".join(comment + x for x in textwrap.wrap(lead + whole + ". " + other, width))))
                want.append(label)
    blank = [(1000 + i, "\n \n".join(textwrap.wrap(t, len(t) // 2 + 8))) for i, t in enumerate(texts)]  # paragraphs of their own
    far = [(2000, "Released\n" + "word " * 40 + "\nunder the MIT " + "word " * 40 + "\nLicense")]
    many = [(3000, "a\n" * 20_000 + texts[0].replace(" ", "\n") + "\n" + "b\n" * 20_000)]  # a word a line
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows + blank + far + many, DOCS)).collect()}
    for (i, t), label in zip(rows, want, strict=True):
        assert label in got[i].labels.split(","), (label, t)
    assert all(got[i].labels == got[i].base_labels for i, _ in blank + far)  # phrases may stand in one part
    assert got[3000].labels == "mit" and got[3000].n_words == 40_000 + len(texts[0].split())


ITEM = "When Anna drives 30 km in two hours and Anna rests for 10 minutes, how far does the car go before the evening comes?"


CASES = [
    (ITEM, True), (ITEM.upper(), True), ("Before. " + ITEM + " After.", True),
    (ITEM.replace("Anna", "Peter").replace("30 km", "45 miles").replace("10", "25"), True),  # other values, one for one
    (ITEM.replace("30", "7").replace("Anna rests", "Peter rests"), False),  # one name became two
    ("A clean text about nothing in particular, with several words and numbers such as 30 km and two hours.", False), ("", False), (None, False)]


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "12 34 56 78 90 12 34 56 78"), (4, "12 34 56 78 90 12 34 56 78")], "item_id bigint, text string")
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] + [(0, ITEM), (None, ITEM), (None, "x")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("item_ids", F.lit(1))
    got = [(r.doc_id, r.contaminated, list(r.item_ids)) for r in decontaminate.contaminated(docs, bench).collect()]
    expected = [(i, d, [1] * d) for i, (_, d) in enumerate(CASES)] + [(0, True, [1]), (None, True, [1]), (None, False, [])]
    assert sorted(got, key=str) == sorted(expected, key=str)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not d for _, d, _ in expected)


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contaminated(none, bench).count() == 0
    docs = spark.createDataFrame([(1, "some words")], DOCS)
    assert decontaminate.matches(keyed(docs), bench).count() == 0 and decontaminate.clean(docs, bench).count() == 1


def test_decontamination_finds_what_shared_words_show(spark):
    """Against the share of five-word shingles, counted pair by pair."""
    import re

    from conftest import SF

    def shingles(text):
        words = re.findall(r"\w+", text.lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [shingles(r.text) for r in bench.collect()]
    of_docs = {r.doc_id: shingles(r.text) for r in docs.collect()}
    expected = {i for i, own in of_docs.items() if any(len(s & own) >= 0.8 * len(s) for s in items)}
    got = {r.doc_id for r in decontaminate.contaminated(docs, bench).where("contaminated").collect()}
    assert expected and got == expected
