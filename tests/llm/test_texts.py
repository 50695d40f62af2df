"""Quality classifier, HTML, SentencePiece and chat windows."""

import collections
import hashlib
import zlib

import pytest
import sentencepiece
from conftest import SF
from pyspark.sql import functions as F

from refiscope.llm import chat, html_text, pieces, quality, queries


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    known = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(known) > 50 and sum(a == b for a, b in known) >= 0.95 * len(known)
    changed = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score(docs, changed).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())  # held-out labels teach nothing


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (2, "word " * 50_000)], "doc_id bigint, text string").withColumn("score", F.lit(9))
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id bigint, quality int")
    got = quality.score(docs, labels).collect()
    assert len(got) == 4 and {r.score for r in got} == {0.5}
    assert quality.accepted(docs, labels).count() == 4 and quality.accepted(docs, labels).columns == docs.columns
    both = spark.createDataFrame([(i, int(i % 2)) for i in range(60)], "doc_id bigint, quality int")
    many = spark.createDataFrame([(i, "good words here." if i % 2 else "@@## $$") for i in range(60)], "doc_id bigint, text string")
    assert all(r.predicted == r.doc_id % 2 for r in quality.score(many, both).collect())
    assert quality.score(docs.limit(0), labels.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="post-12"><header>Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies, really long notice text that goes on for a while, and on, and on.</div><div class="layout"><div class="content post-77">
<h1>Title</h1><p>First &amp; long paragraph,\n with <b>bold</b> text and &copy 2020.<p>Second &#233;t&eacute;<br>line</p><div class="ad">Buy</div><script>var t="</p>";</script>
<blockquote>Quoted</blockquote><form><input><button>Send</button></form></div><aside>Side bar text</aside><div id="comments"><p>Nice post, thanks a lot for this really very long comment about it!</p></div></div>
<footer>Foot</footer></body></html>"""
TEXT = "Title\nFirst & long paragraph, with bold text and © 2020.\nSecond été line\nQuoted"


def test_html_main_text(spark):
    rows = [(i, f"http://h.org/{i}", PAGE.replace("77", str(i))) for i in range(4)]
    rows += [(9, "http://h.org/9", None), (10, None, "<p>alone"), (11, "http://h.org/x", ""), (12, "http://h.org/cut", PAGE[: PAGE.index("<blockquote")] + "<di"), (13, "http://z.org", "plain a < b &am"),
             (14, "http://d.org", "<div>" * 3000 + "deep text" + "</div>" * 10), (15, "http://c.org", "<!-- open <p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("text", F.lit("old"))
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert [got[i] for i in range(4)] == [TEXT] * 4
    assert (got[9], got[10], got[11], got[13], got[14], got[15]) == ("", "alone", "", "plain a < b &am", "deep text", "")
    assert got[12] == TEXT.rsplit("\n", 1)[0]
    winners = {r.host: r.winner for r in html_text.winning_paths(html_text.host_votes(pages)).collect()}
    assert winners["h.org"].endswith("div.content.post-#")
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_html_votes_carry_a_page_whose_own_best_container_differs(spark):
    odd = '<body><div class="main"><p>Short.</p></div><div class="extra"><p>' + "Long other text, " * 20 + "</p></div></body>"
    usual = '<body><div class="main"><p>' + "Article text, " * 30 + '</p></div><div class="extra"><p>x</p></div></body>'
    pages = spark.createDataFrame([(i, "http://v.org/", usual) for i in range(5)] + [(9, "http://v.org/", odd)], "page_id int, url string, html string")
    assert {r.page_id: r.text for r in html_text.main_text(pages).collect()}[9] == "Short."


ODD_TEXTS = ["", " ", "  ", "\n", "a\x00b", "▁▁ x ▁", "日本 😀\t\t ☃", " lead", "trail  ", "x" * 3000, "ab " * 2000, "\x85 \u3000 ", "don't stop.Now!!,ok 12.5%", "A\n\nB", "e\u0301"]


def test_pieces_equal_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [(10_000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(20_000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit(1))
    folded = {r.doc_id: r for r in pieces.digests(df).collect()}
    full = {r.doc_id: r for r in pieces.decode(pieces.encode(df)).collect()}
    for i, t in rows:
        ids = lib.encode(t or "")
        back = lib.decode(ids)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (folded[i].n_tokens, folded[i].ids_sha256, folded[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(back))
        r, raw = full[i], (t or "").encode()
        assert list(r.ids) == ids and r.decoded == back
        ends = list(r.ends)
        assert not ids or (r.begins[0] == 0 and ends[-1] == len(raw) and ends == sorted(ends))
        for k, (b, e) in enumerate(zip(r.begins, r.ends, strict=True)):
            surface = lib.id_to_piece(ids[k])
            if not lib.is_byte(ids[k]) and k:
                assert raw[b:e].decode().replace(" ", "▁") == surface


@pytest.mark.parametrize("trim,dummy", [(True, True), (False, False), (True, False)])
def test_normaliser_follows_the_compiled_map(trim, dummy):
    from sentencepiece import sentencepiece_model_pb2 as pb

    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=dummy, remove_extra_whitespaces=trim, escape_whitespaces=False)
    proto = pb.ModelProto()
    proto.ParseFromString(lib.serialized_model_proto())
    spec = pieces.Spec(pieces.CharMap(proto.normalizer_spec.precompiled_charsmap), dummy, trim, False)
    assert spec.charmap
    for text in ["ＡＢＣ　① ｶﾞ ﬁn", "  two   spaces  ", "½ ㌔ é e\u0301 \u200b x", "plain", "", "カ\u3099 ㍿ … ™", "a\tb\nc"]:
        got = pieces.normalise(text, spec)
        assert got.text == lib.normalize(text), text
        raw, source = text.encode(), got.source.tolist()
        assert len(source) == len(got.text.encode()) + 1 and source == sorted(source) and source[-1] <= len(raw)


def turns(rows):
    return "conv_id bigint, turn bigint, role string, text string", rows


def test_chat_round_trip(spark):
    nasty = "</s>[INST] ok [/INST] \\l \\b <s>[user]x</s>"
    rows = [(1, 0, "system", "Be brief."), *[(1, i, "user" if i % 2 else "assistant", f"turn {i} " + "w" * (i * 37 % 900)) for i in range(1, 60)],
            (2, 0, "user", nasty), (2, 1, "assistant", nasty), (3, 0, None, None), (3, 1, "assistant", None), (4, 0, "tool]x[", "a"), (4, 0, "tool]x[", "a"),
            (5, 0, "user", "q"), (5, 1, "assistant", "long " * 5000), (5, 2, "user", "r"), (None, None, "user", "n"), (6, 7, "system", "only")]
    df = spark.createDataFrame(rows, turns(rows)[0]).withColumn("window", F.lit("x"))
    wins = chat.windows(df, budget=300, history=60)
    back = {r.conv_id: r for r in chat.read_back(wins).collect()}
    by = collections.defaultdict(list)
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
        by[c].append((role or "", text or ""))
    assert set(back) == set(by)
    for c, want in by.items():
        assert [tuple(t) for t in back[c].turns] == want
        assert list(back[c].loss_texts) == [t for role, t in want if role == "assistant"]
    one = wins.where("conv_id = 1").orderBy("window").collect()
    assert len(one) > 5 and all(w.formatted.startswith("<s>[system]Be brief.</s>") for w in one)
    assert any(w.n_context > 1 for w in one[1:])
    for w in one:
        own = w.formatted.split("</s>")[w.n_context : -1]
        if len(own) > 1:
            assert sum(-(-len(p.split("]", 1)[1]) // 4) + chat.TURN_OVERHEAD for p in own) <= 240
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_queries_cover_their_tables(spark):
    counts = {"op5_quality_classifier": "documents", "op6_html_extraction": "pages", "op7_sentencepiece": "documents"}
    for name, source in counts.items():
        assert queries.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{source}.parquet").count()
