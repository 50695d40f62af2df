"""One query per operator over its whole table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, html_text, infill, licences, multi_index, pieces, quality, simhash, square_runs, suffix_dedup, url_filter, word_windows
from .base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# --- 1: URL filters

URL_RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)
#: A domain is on the block list if its first label holds one of these.
BAD_LABELS = ("adult", "ads-", "bets", "casino", "cheap", "malware", "phish", "pills", "porn", "spam", "track", "viagra", "warez")


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    label = F.substring_index("key", ".", 1)
    listed = label.rlike("|".join(BAD_LABELS))
    keys = url_filter.universe(pages).withColumn("listed", listed)
    judged = url_filter.judge(pages, url_filter.build_cascades(keys), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_URL_HOST = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FITS = {r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))" for r in URL_RULES}
_LONGEST = sorted(URL_RULES, key=lambda r: -len(r.text))
SQL["op1_url_filters"] = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages
), parts AS (
    SELECT page_id, coalesce({_URL_HOST}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut
), ruled AS (
    SELECT *, CASE {" ".join(f"WHEN {_FITS[r]} THEN '{r.text}'" for r in _LONGEST)} END AS rule,
           CASE {" ".join(f"WHEN {_FITS[r]} THEN '{r.verdict}'" for r in _LONGEST)} END AS ruled FROM parts
)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN regexp_matches(host, '{"|".join(BAD_LABELS)}') THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

# --- 2: embedding near-dedup


@query
def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"))


# --- 3: suffix-array dedup


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"), words=51)


# --- 4: benchmark decontamination


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- 5: quality classifier


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- 6: HTML extraction


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


# --- 7: SentencePiece


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")


# --- 8: SimHash


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("print")).alias("fingerprint"), "component_id")


# --- 9: license scans


@query
def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


_PLACES = {
    p: "list_filter(range(len(w)), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p.split(" "))) + ")"
    for p in licences.PHRASES
}
_SETS = licences.template_tokens(licences.TEMPLATES)
_REACHES = [licences.reach(t) for _, t in licences.TEMPLATES]
_BASE = "list_filter([" + ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(licences.PHRASES.values())) + "], lambda x: x IS NOT NULL)"
SQL["op9_license_scans"] = f"""
WITH own AS (
    SELECT row_number() OVER () AS k, doc_id, translate(coalesce(text, ''), '{"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}', '{"abcdefghijklmnopqrstuvwxyz"}') AS t FROM documents
), cut AS (
    SELECT k, doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM own
), placed AS (
    SELECT k, doc_id, len(w) AS n_words, {", ".join(f"{sql} AS p{i}" for i, sql in enumerate(_PLACES.values()))} FROM cut
), templates AS (
    SELECT * FROM (VALUES {", ".join(f"('{label}', {tokens!r}, {n})" for (label, tokens), n in zip(_SETS, _REACHES, strict=True))}) AS v(label, tokens, reach)
), paragraphs AS (
    SELECT k, list_filter(list_transform(string_split(par, chr(10)), lambda x: regexp_extract_all(x, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')), lambda x: len(x) > 0) AS l
    FROM (SELECT k, unnest(regexp_split_to_array(t, '\n[ \t\r]*\n')) AS par FROM cut)
), lines AS (
    SELECT k, 0 AS side, unnest(l) AS w FROM paragraphs
    UNION ALL
    SELECT k, s, flatten(l[greatest(1, i - s + 1):i])[-s:] || flatten(l[i + 1:i + s])[:s]
    FROM (SELECT k, l, unnest(range(1, len(l))) AS i FROM paragraphs), (SELECT DISTINCT reach AS s FROM templates)
), shared AS (
    SELECT k, label, len(list_intersect(tokens, w)) AS both_, len(tokens) AS size_ FROM lines, templates WHERE side IN (0, reach)
), found AS (
    SELECT k, list(DISTINCT label) AS more, max(both_ / size_) AS best FROM shared WHERE both_ >= ceil(0.8 * size_ - 1e-9) GROUP BY k
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(p0) + len(p1) + len(p2) AS BIGINT) AS n_base,
       list_min(p0 || p1 || p2) AS first_word, list_max(p0 || p1 || p2) AS last_word,
       array_to_string(list_sort({_BASE}), ',') AS base_labels,
       array_to_string(list_sort(list_distinct({_BASE} || coalesce(more, []))), ',') AS labels,
       CASE WHEN len(p0) + len(p1) + len(p2) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM placed LEFT JOIN found USING (k)
"""

# --- 10: chat formatting

PROBE = "</s>[INST] ok [/INST]"


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    back = chat.read_back(chat.windows(given.unionByName(probe)))
    loss = F.array_join("loss_texts", "")
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


SQL["op10_chat_formatting"] = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), sized AS (
    SELECT *, CAST(ceil(length(text) / 4.0) AS BIGINT) + {chat.TURN_OVERHEAD} AS tokens,
           6 + length(role) + length(replace(replace(replace(role, '\\', '\\b'), '[', '\\s'), '<', '\\l')) - length(role)
             + length(role) - length(replace(role, ']', ''))
             + length(text) + length(text) - length(replace(replace(replace(text, '\\', ''), '<', ''), '[', '')) + 3 AS chars
    FROM given
), summed AS (
    SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS through,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM sized
), lead AS (
    SELECT conv_id, tokens AS sys_tokens, chars AS sys_chars FROM summed WHERE place = 1 AND role = 'system'
), celled AS (
    SELECT s.*, through - tokens AS before_, sys_chars,
           greatest(64, CAST(floor((896 - coalesce(sys_tokens, 0)) / 2.0) AS BIGINT)) AS stride
    FROM summed s LEFT JOIN lead USING (conv_id)
), named AS (
    SELECT *, CASE WHEN tokens > stride THEN before_ END AS alone, (through - 1) // stride AS cell FROM celled
), broken AS (
    SELECT *, CASE WHEN place = 1 OR alone IS NOT NULL OR lag(alone) OVER w IS NOT NULL OR lag(cell) OVER w <> cell THEN 1 ELSE 0 END AS opens
    FROM named WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), starts AS (
    SELECT conv_id, before_ AS start, sys_chars FROM broken WHERE opens = 1
), past AS (
    SELECT s.conv_id, s.start, sum(b.chars) AS chars, bool_or(b.before_ = 0) AS whole
    FROM starts s JOIN broken b ON b.conv_id = s.conv_id AND b.before_ < s.start AND b.before_ >= s.start - 128 GROUP BY ALL
), added AS (
    SELECT s.conv_id, sum(coalesce(p.chars, 0) + CASE WHEN s.start > 0 AND NOT coalesce(p.whole, false) THEN coalesce(sys_chars, 0) ELSE 0 END) AS chars
    FROM starts s LEFT JOIN past p ON p.conv_id = s.conv_id AND p.start = s.start GROUP BY s.conv_id
), digest AS (
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss, sum(chars) AS chars
    FROM summed GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(digest.chars + added.chars AS BIGINT) AS formatted_chars
FROM digest JOIN added USING (conv_id)
"""

# --- 11: fill-in-the-middle


@query
def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.infilled(table(spark, sf_dir, "documents"))
    found = found.withColumn("d", infill.digests(F.col("output"), F.col("form")))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "d.output_sha256", "d.restored_sha256")


SQL["op11_infill"] = r"""
WITH own AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), cut AS (
    SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM own
), drawn AS (
    SELECT doc_id, t, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut
), parts AS (
    SELECT doc_id, t, n, form, array_to_string(u[:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

# --- 12: substring dedup


@query
def op12_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_windows.removal_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("begins", "ends", lambda b, e: e - b), F.lit(0).cast("bigint"), lambda total, n: total + n)
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


SQL["op12_word_windows"] = r"""
WITH own AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS v
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM own WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY v ORDER BY doc_id, i) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM own
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM own LEFT JOIN kept USING (doc_id)
"""

# --- 13: periodic runs


def _repeating(doc_id: Column, text: Column) -> Column:
    """The text, in which for a tenth of the ids the words from a drawn place on repeat the first ones from there."""

    @F.pandas_udf("string")
    def made(raws: pd.Series, draws: pd.Series) -> pd.Series:
        out = []
        for raw, h in zip(raws, draws.tolist(), strict=True):
            words = raw.split() if h % 10 == 0 else []
            if words:
                g = h // 10
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                raw = b" ".join(words[:a] + [words[a + i % p] for i in range(len(words) - a)])
            out.append(raw.decode("utf-8", "replace"))
        return pd.Series(out, dtype=object)

    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return made(F.coalesce(text, F.lit("")).cast("binary"), h)


@query
def op13_square_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = square_runs.periodic_runs(docs)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.array_join(F.transform(lines, lambda r: F.concat(r, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


_TABLE = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i))"
_CRC = "xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)"
# A stretch that has a smaller period as well is found with both: as longest stretch of either it's the same.
SQL["op13_square_runs"] = rf"""
WITH own AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0, {_CRC} AS h
    FROM documents, (SELECT {_TABLE} AS steps)
), ruled AS (
    SELECT doc_id, w0, h, len(w0) AS n, CASE WHEN len(w0) > 0 THEN (h // 10) % len(w0) END AS a,
           CASE WHEN len(w0) > 0 THEN 1 + (len(w0) - (h // 10) % len(w0)) // (3 + (h // 10) % 8) END AS p FROM own
), words AS (
    SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w0[a + (i - a) % p + 1] ELSE w0[i + 1] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM ruled)
), equals AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
    ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 3
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equals) GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, start, length, min(q) AS q FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) = 1
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listing FROM runs GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, CAST(length AS BIGINT) AS length, q AS period, CAST(1000 * length // q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM own LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
