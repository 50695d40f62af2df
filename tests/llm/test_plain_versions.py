"""op5 and op6 against plain versions of their definitions."""

import random
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from conftest import SF

from refiscope.llm import html_text, quality, queries


def test_discriminant_equals_plain_densities(spark):
    """Class covariances, shrinkage and log-densities written out row by row, without factors or sums of products."""
    shrink, ridge = 0.1, 0.02
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").collect()]
    marks = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet").collect()]
    x = {i: np.array(quality.statistics(t)) for i, t in docs}
    taught = [(x[i], q) for i, q in marks if zlib.crc32(str(i).encode()) % 3 != 1 and q is not None and i in x]
    groups = [np.array([v for v, q in taught if q == c]) for c in (0, 1)]
    d = len(quality.STATISTICS)
    pooled = sum((len(g) - 1) * np.cov(g.T) for g in groups) / (len(taught) - 2)
    base = np.diag(np.diag(pooled)) + np.eye(d) * (1e-6 + 1e-3 * np.trace(pooled) / d)
    covariances = [(1 - shrink - ridge) * np.cov(g.T) + shrink * pooled + ridge * base + 1e-9 * np.eye(d) for g in groups]

    def margin(v):
        log = [-0.5 * ((v - g.mean(0)) @ np.linalg.solve(s, v - g.mean(0)) + np.linalg.slogdet(s)[1]) for g, s in zip(groups, covariances, strict=True)]
        return log[1] - log[0] + np.log(len(groups[1]) / len(groups[0]))

    got = {r.doc_id: r for r in queries.QUERIES["op5_quality_classifier"](spark, SF.replace("0.001", "0.01")).collect()}
    assert len(got) == len(docs)
    for i, v in x.items():
        want = 1 / (1 + np.exp(-np.clip(margin(v), -500, 500)))
        assert got[i].score == pytest.approx(want, abs=1e-6), i
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        if abs(want - 0.5) > 1e-6:
            assert got[i].predicted == int(want >= 0.5)


class Article(HTMLParser):
    """Blocks of the only article of a page, by the standard library's parser."""

    AWAY = {"script", "style", "nav", "aside", "footer", "form", "button"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside = self.away = 0
        self.blocks, self.texts = [], []

    def close_block(self):
        text = " ".join("".join(self.texts).split())
        self.texts = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside += 1
        if tag in self.AWAY or self.away and tag == "div" or any(v in ("ad", "comment", "comments", "share", "notice") for k, v in attrs if k == "class"):
            self.away += 1
        if tag == "br":
            self.texts.append(" ")
        elif tag not in ("b", "i", "a", "em", "span", "strong", "code"):
            self.close_block()

    def handle_endtag(self, tag):
        if tag == "article" and self.inside:
            self.close_block()
            self.inside -= 1
        if self.away and (tag in self.AWAY or tag == "div"):
            self.texts = []
            self.away -= 1
        if tag not in ("b", "i", "a", "em", "span", "strong", "code"):
            self.close_block()

    def handle_data(self, data):
        if self.inside and not self.away:
            self.texts.append(data)


def test_every_page_of_the_table_gives_its_article(spark):
    folder = SF.replace("0.001", "0.01")
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.QUERIES["op6_html_extraction"](spark, folder).collect()}
    assert set(got) == set(pages)
    for i, html in pages.items():
        plain = Article()
        plain.feed(html or "")
        plain.close()
        plain.close_block()
        assert got[i].text == "\n".join(plain.blocks), i
        assert got[i].n_chars == len(got[i].text)


#: Where the headline stands: in a page header, beside the content, in the article's own header, in the content.
LAYOUTS = (
    "<body><header class=top><h1>{head}</h1></header>{nav}<div class=content>{body}</div>{aside}{foot}",
    "<body>{nav}<div class=lead><h1>{head}</h1></div><div class=content>{body}</div>{aside}{foot}",
    "<body>{nav}<article><header><h1>{head}</h1></header><div class=text>{body}</div></article>{aside}{foot}",
    "<body>{nav}<div class=post><h1>{head}</h1>{body}</div>{aside}{foot}",
    "<body><header><h1>Site of news</h1></header>{nav}<div class=content><h2>{head}</h2>{body}</div>{aside}{foot}",
)


def made_pages(seed=5):
    rng = random.Random(seed)
    words = "alpha beta gamma delta of and to stone river house walk long green light".split()
    some = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b)))
    for host, layout in enumerate(LAYOUTS):
        for k in range(7):
            head = f"{some(2, 6)} {k}"
            blocks = [some(20, 60) + "." for _ in range(rng.randint(3, 6))] + ["So x=2 holds &amp; stays"]
            body = "".join(f"<p>{t}</p>" for t in blocks).replace("x=2", "<math><mi>x</mi>=2<annotation>x=2</annotation></math>")
            nav = "<nav>" + "".join(f"<a href=/{j}>{some(1, 2)}</a> " for j in range(6)) + "</nav>"
            aside = f"<aside class=sidebar><p>{some(5, 30)}</p></aside><section class=comments><p>{some(30, 90)}</p></section>"
            html = layout.format(head=head, body=body, nav=nav, aside=aside, foot=f"<footer>{some(3, 9)}</footer>")
            yield host * 100 + k, f"http://h{host}.org/{k}", html, "\n".join([head, *blocks]).replace("&amp;", "&")


def test_headlines_and_formulas_of_made_pages(spark):
    made = list(made_pages())
    pages = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h, _ in made], "page_id int, url string, html string, winner string, own_host string")
    found = html_text.main_text(pages)
    assert found.columns == [*pages.columns, "text"]
    got = {r.page_id: r for r in found.collect()}
    for i, _, _, want in made:
        assert (got[i].text, got[i].winner, got[i].own_host) == (want, "x", "y"), i
