"""The queries of the reference's operators over the tables of a folder, and their equivalents in SQL."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import surface
from corpusmill.functions import boilerplate, domains, http, text
from corpusmill.functions.charset import detect_charset, html_of
from corpusmill.functions.language import Identifier, train
from corpusmill.functions.simhash import bands, simhash
from corpusmill.operators import dedup, evaluation
from corpusmill.operators import statistics as stats
from corpusmill.plans import pipeline
from corpusmill.plans.shared import materialize, shared_dir, table
from corpusmill.sources import texts, warc
from corpusmill.streaming import streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


_LINES = r"unnest(list_filter(regexp_split_to_array({0}, '\r\n|\n|\r'), lambda x: x <> ''))"
_HASHES = """
u AS (SELECT doc_id, list_transform(list_filter(string_split(text, ''), lambda c: c <> ''), lambda c: unicode(c)::UBIGINT) AS c FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, CASE WHEN len(c) < 7 THEN [] ELSE list_distinct(list_transform(range(1, len(c) - 5), lambda i:
  (c[i]*887503681 + c[i+1]*28629151 + c[i+2]*923521 + c[i+3]*29791 + c[i+4]*961 + c[i+5]*31 + c[i+6]) & 4294967295)) END AS hs FROM u),
v AS (SELECT doc_id, unnest(hs) AS x FROM h),
w AS (SELECT doc_id, b, 2 * count_if((x >> b) & 1 = 1) > count(*) AS up FROM v, (SELECT unnest(range(32)) AS b) GROUP BY doc_id, b),
l AS (SELECT doc_id, sum(CASE WHEN up THEN (1::UBIGINT << b) ELSE 0 END)::HUGEINT AS lo FROM w GROUP BY doc_id),
f AS (SELECT d.doc_id, d.lang, length(d.text) AS doc_len, octet_length(encode(d.text)) AS bytes, coalesce(l.lo, 0) AS lo,
  CASE WHEN coalesce(l.lo, 0) >= 2147483648 THEN coalesce(l.lo, 0) * 4294967297 - 18446744073709551616 ELSE coalesce(l.lo, 0) * 4294967297 END::BIGINT AS simhash
  FROM documents d LEFT JOIN l USING (doc_id) WHERE d.text IS NOT NULL)"""


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, doc_len, simhash, lang, text) of documents."""
    docs = table(spark, sf, "documents").where("text is not null")
    return docs.select("doc_id", F.length("text").alias("doc_len"), simhash(F.col("text")).alias("simhash"), "lang")


# --- fingerprints and duplicates -------------------------------------------------------------------------------------


@query(f"WITH {_HASHES}, e AS (SELECT DISTINCT ON (bytes, simhash) doc_id, lang FROM f ORDER BY bytes, simhash, doc_id) SELECT lang, count(*) AS n FROM e GROUP BY lang")
def languages_without_copies(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("text is not null").select("doc_id", "lang", F.octet_length("text").alias("bytes"), simhash(F.col("text")).alias("simhash"))
    kept = dedup.exact_duplicates(docs, F.col("bytes"), F.col("simhash"), id="doc_id")
    return kept.groupBy("lang").agg(F.count("*").alias("n"))


@query(f"WITH {_HASHES} SELECT doc_id, doc_len, simhash FROM f")
def fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", "doc_len", "simhash")


@query(f"WITH {_HASHES}, b AS (SELECT unnest([struct_pack(band := 0, bits := simhash & 131071), struct_pack(band := 1, bits := ((lo * 4294967297) // 131072 % 131072)::BIGINT), struct_pack(band := 2, bits := ((lo * 4294967297) // 17179869184 % 131072)::BIGINT)]) AS s FROM f) SELECT s.band::INT AS band, count(*) AS n, count(DISTINCT s.bits) AS keys FROM b GROUP BY 1")
def band_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = _docs(spark, sf).select(F.posexplode(bands(F.col("simhash"))).alias("band", "bits"))
    return keys.groupBy("band", "bits").agg(F.count("*").alias("k")).groupBy("band").agg(F.sum("k").alias("n"), F.count("*").alias("keys"))


@query(f"WITH {_HASHES} SELECT a.doc_id, a.simhash, count(b.doc_id) AS n_near FROM f a LEFT JOIN f b ON a.doc_id <> b.doc_id AND bit_count(xor(a.simhash, b.simhash)) <= 3 GROUP BY 1, 2")
def near_links(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.link_counts(materialize(_docs(spark, sf), "prints"))


@query(f"WITH {_HASHES}, p AS (SELECT DISTINCT simhash FROM f) SELECT a.simhash AS a, b.simhash AS b, bit_count(xor(a.simhash, b.simhash))::INT AS distance FROM p a JOIN p b ON a.simhash < b.simhash AND bit_count(xor(a.simhash, b.simhash)) <= 3")
def near_classes(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.near_fingerprints(_docs(spark, sf).select("simhash").distinct())


@query(SQL["near_classes"])
def near_classes_by_bands(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.band_candidates(materialize(_docs(spark, sf).select("simhash").distinct(), "prints"))


@query(f"WITH {_HASHES} SELECT DISTINCT CASE WHEN (a.doc_len, a.doc_id) < (b.doc_len, b.doc_id) THEN a.doc_id ELSE b.doc_id END AS doc_id FROM f a JOIN f b ON a.doc_id < b.doc_id AND bit_count(xor(a.simhash, b.simhash)) <= 3")
def ids_to_delete(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.ids_to_delete(materialize(_docs(spark, sf), "prints"))


@query(f"WITH RECURSIVE {_HASHES}, p AS (SELECT DISTINCT simhash FROM f), e AS (SELECT a.simhash AS x, b.simhash AS y FROM p a JOIN p b ON a.simhash <> b.simhash AND bit_count(xor(a.simhash, b.simhash)) <= 3), r AS (SELECT simhash AS x, simhash AS y FROM p UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x) SELECT x AS simhash, min(y) AS component FROM r GROUP BY x")
def near_components(spark: SparkSession, sf: str) -> DataFrame:
    prints = materialize(_docs(spark, sf).select("simhash").distinct(), "prints")
    return dedup.connected(prints, dedup.near_fingerprints(prints))


@query("WITH d AS (SELECT record_id, octet_length(encode(text)) AS bytes, simhash FROM corpus WHERE record_id IS NOT NULL) SELECT bytes, simhash, min(record_id) AS record_id FROM d GROUP BY 1, 2")
def exact_survivors(spark: SparkSession, sf: str) -> DataFrame:
    corpus = table(spark, sf, "corpus").where("record_id is not null").select("record_id", F.octet_length("text").cast("bigint").alias("bytes"), "simhash")
    return dedup.exact_duplicates(corpus, F.col("bytes"), F.col("simhash"))


@query("""WITH one AS (SELECT record_id FROM corpus GROUP BY record_id HAVING count(*) = 1), listed AS (SELECT DISTINCT record_id FROM warc_raw WHERE record_id IS NOT NULL)
SELECT c.record_id, c.language, c.license FROM corpus c JOIN one USING (record_id) WHERE c.language IS NOT NULL AND c.record_id NOT IN (SELECT record_id FROM listed)""")
def corpus_without_listed_ids(spark: SparkSession, sf: str) -> DataFrame:
    corpus = table(spark, sf, "corpus").select("record_id", "language", "license")
    return dedup.remove_ids(corpus, table(spark, sf, "warc_raw").where("record_id is not null").select("record_id").distinct())


# --- HTTP, licences, addresses ---------------------------------------------------------------------------------------

_HEAD = r"CASE WHEN starts_with(c, 'HTTP') AND instr(c, '\x0D\x0A\x0D\x0A') > 1 THEN replace(replace(substr(c, 1, instr(c, '\x0D\x0A\x0D\x0A') - 1), '\x0D', chr(13)), '\x0A', chr(10)) END"
_RAW = rf"WITH r AS (SELECT *, CAST(content AS VARCHAR) AS c FROM warc_raw), h AS (SELECT *, {_HEAD} AS head FROM r), t AS (SELECT *, nullif(lower(regexp_extract(head, 'Content-Type:\s*([^\s;]+)', 1)), '') AS kind, nullif(lower(regexp_extract(head, 'Content-Type:.*charset=\s*([^\s;]+)', 1)), '') AS chars FROM h)"


@query(_RAW + " SELECT source_path, record_no, kind, chars, coalesce(content_type = 'application/http; msgtype=response', false) AS response, coalesce(content_type = 'application/http; msgtype=response' AND content_length < 10000000 AND kind IN ('text/html', 'application/xhtml+xml'), false) AS page FROM t")
def http_fields(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "warc_raw")
    h = http.header(F.col("content"))
    return raw.select(
        "source_path", "record_no", http.page_type(h).alias("kind"), http.page_charset(h).alias("chars"),
        F.coalesce(http.is_response(F.col("content_type")), F.lit(False)).alias("response"), http.is_page(F.col("content_type"), F.col("content_length"), F.col("content")).alias("page"),
    )


@query(_RAW + " SELECT 'content' AS kind, kind AS value, sum(content_length)::BIGINT AS bytes FROM t WHERE content_type = 'application/http; msgtype=response' AND kind IS NOT NULL GROUP BY kind UNION ALL SELECT 'charset', chars, sum(content_length)::BIGINT FROM t WHERE content_type = 'application/http; msgtype=response' AND chars IS NOT NULL GROUP BY chars")
def types_and_charsets(spark: SparkSession, sf: str) -> DataFrame:
    return stats.types_and_charsets(table(spark, sf, "warc_raw"))


@query(r"""WITH l AS (SELECT source_path, record_no, list_distinct(regexp_extract_all(CAST(content AS VARCHAR), 'https?://creativecommons\.org/licenses/(by|by-sa|by-nd|by-nc|by-nc-sa|by-nc-nd|publicdomain)["/ >]', 1)) AS k FROM warc_raw)
SELECT source_path, record_no, CASE WHEN k IS NULL THEN NULL WHEN len(k) = 0 THEN 'none' WHEN len(k) = 1 THEN k[1] ELSE 'cc-unspecified' END AS license FROM l""")
def page_licenses(spark: SparkSession, sf: str) -> DataFrame:
    page = F.decode("content", "ISO-8859-1")
    return table(spark, sf, "warc_raw").select("source_path", "record_no", text.cc_license(page).alias("license"))


@query(r"""WITH t AS (SELECT source_path, record_no, content, list_transform(regexp_extract_all(CAST(content AS VARCHAR), '<(?:[aA]|meta)\s[^<>]*'), lambda t: regexp_extract_all(t, '(?:href|HREF|content)\s*=\s*(?:["'']|&quot;)?\s*https?://creativecommons\.org/licenses/(by|by-sa|by-nd|by-nc|by-nc-sa|by-nc-nd|publicdomain)/', 1)) AS k FROM warc_raw),
l AS (SELECT source_path, record_no, list_distinct(list_transform(list_filter(k, lambda x: len(x) > 0), lambda x: x[-1])) AS k FROM t)
SELECT source_path, record_no, CASE WHEN k IS NULL THEN NULL WHEN len(k) = 0 THEN 'none' WHEN len(k) = 1 THEN k[1] ELSE 'cc-unspecified' END AS license FROM l""")
def tag_licenses(spark: SparkSession, sf: str) -> DataFrame:
    page = F.decode("content", "ISO-8859-1")
    return table(spark, sf, "warc_raw").select("source_path", "record_no", text.cc_license_in_tags(page).alias("license"))


@query("SELECT count_if(gold NOT IN ('none', 'cc-unspecified') AND gold = predicted) AS tp, count_if(gold = 'none' AND predicted = 'none') AS tn, count_if(gold = 'none' AND predicted NOT IN ('none', 'cc-unspecified')) AS fp, count_if(gold NOT IN ('none', 'cc-unspecified') AND predicted = 'none') AS fn FROM (SELECT c.license AS gold, p.license AS predicted FROM (SELECT DISTINCT record_id, license FROM corpus) c JOIN (SELECT record_id, CASE WHEN len(k) = 0 THEN 'none' WHEN len(k) = 1 THEN k[1] ELSE 'cc-unspecified' END AS license FROM (SELECT DISTINCT record_id, list_distinct(regexp_extract_all(CAST(content AS VARCHAR), 'https?://creativecommons\\.org/licenses/(by|by-sa|by-nd|by-nc|by-nc-sa|by-nc-nd|publicdomain)[\"/ >]', 1)) AS k FROM warc_raw WHERE warc_type = 'response')) p USING (record_id))")
def license_confusion(spark: SparkSession, sf: str) -> DataFrame:
    gold = table(spark, sf, "corpus").select("record_id", F.col("license").alias("gold")).distinct()
    found = table(spark, sf, "warc_raw").where("warc_type = 'response'").select("record_id", text.cc_license(F.decode("content", "ISO-8859-1")).alias("predicted")).distinct()
    return evaluation.license_scores(gold.join(found, "record_id")).select("tp", "tn", "fp", "fn")


@query("SELECT DISTINCT target_uri AS uri FROM corpus WHERE target_uri IS NOT NULL")
def distinct_uris(spark: SparkSession, sf: str) -> DataFrame:
    return stats.uris(table(spark, sf, "corpus"))


_HOST_OF = r"""lower(regexp_extract(target_uri, '^https?://([A-Za-z0-9.-]+)(?:[:/?#].*)?$', 1))"""
_GOOD_URI = r"""regexp_matches(target_uri, '^https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:[/?#][A-Za-z0-9._~:/?#@!$&''()*+,;=%-]*)?$')"""


@query(rf"""WITH h AS (SELECT regexp_replace({_HOST_OF}, '\.$', '') AS host FROM corpus WHERE {_GOOD_URI}), n AS (SELECT string_split(host, '.') AS l FROM h WHERE regexp_matches(host, '^([a-z0-9]([a-z0-9_-]*[a-z0-9])?\.)*[a-z]([a-z0-9-]*[a-z0-9])?$')),
d AS (SELECT array_to_string(CASE WHEN len(l) > 1 AND l[-2] || '.' || l[-1] IN ({', '.join(f"'{x}'" for x in domains.TWO_LABEL_SUFFIXES)}) THEN l[-3:] ELSE l[-2:] END, '.') AS domain FROM n) SELECT domain, count(*) AS n FROM d GROUP BY domain""")
def domain_count(spark: SparkSession, sf: str) -> DataFrame:
    return stats.domain_count(table(spark, sf, "corpus"))


@query(r"""WITH h AS (SELECT lower(regexp_extract(target_uri, '^https?://([A-Za-z0-9.-]+)(?:[:/?#].*)?$', 1)) AS host FROM corpus WHERE regexp_matches(target_uri, '^https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:[/?#][A-Za-z0-9._~:/?#@!$&''()*+,;=%-]*)?$'))
SELECT host, count(*) AS n FROM h WHERE host <> '' GROUP BY host""")
def host_count(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "corpus").select(F.lower(domains.host(F.col("target_uri"))).alias("host")).where("host is not null")
    return found.groupBy("host").agg(F.count("*").alias("n"))


@query("SELECT source_path, record_no FROM warc_raw WHERE target_uri IN (SELECT target_uri FROM corpus WHERE license = 'by')")
def listed_pages(spark: SparkSession, sf: str) -> DataFrame:
    urls = table(spark, sf, "corpus").where("license = 'by' and target_uri is not null").select("target_uri")
    return stats.listed_pages(table(spark, sf, "warc_raw").select("source_path", "record_no", "target_uri"), urls).select("source_path", "record_no")


@query("SELECT 'WARC records' AS key, count(*) AS n FROM warc_raw")
def record_count(spark: SparkSession, sf: str) -> DataFrame:
    return stats.record_count(table(spark, sf, "warc_raw"))


@query("SELECT content_type AS key, ((content_length // 100000) + 1) * 100 AS bin, count(*) AS n FROM warc_raw WHERE content_length IS NOT NULL GROUP BY 1, 2")
def size_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return stats.size_histogram(table(spark, sf, "warc_raw"))


# --- words and texts -------------------------------------------------------------------------------------------------


@query(rf"WITH l AS (SELECT regexp_replace(regexp_replace(line, '^<[A-Za-z0-9_]+>', ''), '</[A-Za-z0-9_]+>$', '') AS line FROM (SELECT {_LINES.format('text')} AS line FROM documents)), t AS (SELECT unnest(list_filter(regexp_split_to_array(line, '[^A-Za-z0-9_]+'), lambda x: x <> '')) AS token FROM l) SELECT token, count(*) AS n FROM t GROUP BY token")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return stats.word_count(table(spark, sf, "documents"))


_VOCABULARY = rf"WITH l AS (SELECT {_LINES.format('text')} AS line FROM documents), t AS (SELECT unnest(list_filter(regexp_split_to_array(regexp_replace(lower(line), '[_|$#<>^=\[\]*/\\,;.\-:()?!\"`''{{}}]', ' ', 'g'), '[ \t\n\v\f\r]+'), lambda x: x <> '')) AS token FROM l), c AS (SELECT token, count(*) AS n FROM t GROUP BY token)"


@query(_VOCABULARY + " SELECT token, n FROM c")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return stats.vocabulary(table(spark, sf, "documents"))


@query(_VOCABULARY + " SELECT token, n FROM c ORDER BY n DESC, token LIMIT 100")
def most_frequent_words(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top(stats.vocabulary(table(spark, sf, "documents")), 100)


_TAGGED = _VOCABULARY.replace("lower(line)", r"lower(regexp_replace(line, '/[^ \t\n\v\f\r]+[ \t\n\v\f\r]', ' ', 'g'))").replace("{0}", "{0}")
_TAG_TEXT = r"(SELECT regexp_replace(text, '(\p{L}+)([ \t\n\v\f\r])', '\1/nn\2', 'g') AS text FROM documents)"


def _tag_text(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a tag after each word, as a tagged corpus has them."""
    return table(spark, sf, "documents").select(F.regexp_replace("text", r"(\p{L}+)(\s)", "$1/nn$2").alias("text"))


@query(_TAGGED.replace("FROM documents", "FROM " + _TAG_TEXT) + " SELECT token, n FROM c")
def tagged_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return stats.vocabulary(_tag_text(spark, sf), form="tagged")


@query(_TAGGED.replace("FROM documents", "FROM " + _TAG_TEXT).replace("FROM l)", "FROM l WHERE NOT starts_with(line, '<'))") + " SELECT token, n FROM c")
def wiki_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return stats.vocabulary(_tag_text(spark, sf), form="wiki")


@query("SELECT doc_id, replace(replace(text, chr(10), '<br>' || chr(10)), '<br>', '') AS text FROM documents")
def texts_without_breaks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("<br>\n")).alias("text"))
    return docs.select("doc_id", text.remove_breaks(F.col("text")).alias("text"))


@query(rf"WITH l AS (SELECT {_LINES.format('text')} AS line FROM documents), t AS (SELECT unnest(regexp_extract_all(line, '.{{5}}[0-9]{{2,}} [a-z]+')) AS hit FROM l) SELECT hit, count(*) AS n FROM t GROUP BY hit")
def match_count(spark: SparkSession, sf: str) -> DataFrame:
    return stats.match_count(table(spark, sf, "documents"), ".{5}[0-9]{2,} [a-z]+")


@query(rf"WITH l AS (SELECT {_LINES.format('text')} AS line FROM documents), p AS (SELECT unnest(string_split(regexp_replace(line, '</?[A-Za-z0-9_]+>', '', 'g'), '. ')) AS sentence FROM l) SELECT sentence, count(*) AS n FROM p WHERE sentence <> '' GROUP BY sentence")
def sentence_count(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").select(F.explode(text.lines_of(F.col("text"))).alias("line")).where("line <> ''")
    parts = lines.select(F.explode(text.sentences(F.concat(F.lit("<p>"), "line", F.lit("</p>")))).alias("sentence")).where("sentence <> ''")
    return parts.groupBy("sentence").agg(F.count("*").alias("n"))


_WS = r"[ \t\n\v\f\r]+"


@query(rf"SELECT language, license, count(*) AS documents, sum(len(regexp_extract_all(text, '{_WS}')) + 1)::BIGINT AS tokens FROM corpus GROUP BY 1, 2")
def languages_by_license(spark: SparkSession, sf: str) -> DataFrame:
    return stats.languages_by_license(table(spark, sf, "corpus"))


_PAIR = "coalesce(sum(documents) FILTER (license = '{0}'), 0)::BIGINT AS \"docs {0}\", coalesce(sum(tokens) FILTER (license = '{0}'), 0)::BIGINT AS \"tokens {0}\""


@query("WITH c AS (" + SQL["languages_by_license"] + ") SELECT language, " + ", ".join(_PAIR.format(x) for x in [*text.LICENSES, text.NO_LICENSE, text.SEVERAL]) + " FROM c GROUP BY language")
def license_table(spark: SparkSession, sf: str) -> DataFrame:
    return stats.license_table(stats.languages_by_license(table(spark, sf, "corpus")), [*text.LICENSES, text.NO_LICENSE, text.SEVERAL])


@query("WITH w AS (" + SQL["license_table"] + ") SELECT NULL AS at, ';" + "".join(f"docs {x};" for x in sorted([*text.LICENSES, text.NO_LICENSE, text.SEVERAL])) + "".join(f"tokens {x};" for x in sorted([*text.LICENSES, text.NO_LICENSE, text.SEVERAL])) + "' AS value UNION ALL SELECT language, language || ';' || " + " || ".join(f'"{kind} {x}" || \';\'' for kind in ("docs", "tokens") for x in sorted([*text.LICENSES, text.NO_LICENSE, text.SEVERAL])) + " FROM w WHERE language IS NOT NULL")
def license_table_lines(spark: SparkSession, sf: str) -> DataFrame:
    wide = license_table(spark, sf).where("language is not null")
    return texts.semicolon_table(wide, "language", [c for c in wide.columns if c != "language"])


@query(r"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(text, '\n+', chr(10), 'g'), '[\x00-\x09\x0b\x0c\x0e-\x1f\x7f]', '', 'g') AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(t, '[\x20\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\n +', chr(10), 'g'), ' +\n', chr(10), 'g') AS t FROM b),
d AS (SELECT doc_id, replace(regexp_replace(t, '[\x{2012}-\x{2015}\x{2053}]+', '-', 'g'), '…', '...') AS t FROM c),
e AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[“”«»„‟]', '"', 'g'), '[‘’‚‛‹›`]', '''', 'g') AS t FROM d)
SELECT doc_id, regexp_replace(t, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS text FROM e""")
def normalized_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("text"))


@query("SELECT 'Lic_' || license || '_Lang_' || language || '_NoBoilerplate_' || no_boilerplate::VARCHAR || '_MinHtml_' || minimal_html::VARCHAR AS prefix, count(*) AS n FROM corpus WHERE license <> '' AND language <> '' AND no_boilerplate IS NOT NULL AND minimal_html IS NOT NULL GROUP BY 1")
def output_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    whole = table(spark, sf, "corpus").where("license <> '' and language <> '' and no_boilerplate is not null and minimal_html is not null")
    return pipeline.with_prefix(whole).groupBy("prefix").agg(F.count("*").alias("n"))


@query("SELECT doc_id, n_chars AS doc_len, lang FROM documents WHERE n_chars IS NOT NULL")
def document_lines_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("n_chars is not null").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("n_chars").cast("int").alias("doc_len"), F.col("doc_id").alias("simhash"), "lang")
    line = docs.select(texts.format_documents(F.array(F.struct("doc_id", "doc_len", "simhash", "lang"))).alias("line"))
    back = line.select(F.explode(texts.parse_documents(F.col("line"))).alias("d"))
    return back.select(F.col("d.doc_id").cast("bigint").alias("doc_id"), F.col("d.doc_len").cast("bigint").alias("doc_len"), F.col("d.lang").alias("lang"))


_COUNTED = rf"(SELECT '{{name}}' AS v, token, count(*) AS n FROM (SELECT unnest(list_filter(regexp_split_to_array(regexp_replace(lower(line), '[_|$#<>^=\[\]*/\\,;.\-:()?!\"`''{{{{}}}}]', ' ', 'g'), '[ \t\n\v\f\r]+'), lambda x: x <> '')) AS token FROM (SELECT {_LINES.format('text')} AS line FROM {{source}})) GROUP BY token)"


@query(
    "WITH c AS (" + " UNION ALL ".join(_COUNTED.format(name=n, source=s) for n, s in (("documents", "documents"), ("corpus", "corpus"), ("english", "(SELECT text FROM documents WHERE lang = 'en')"))) + """),
g AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY n DESC, token) AS x FROM c),
s AS (SELECT unnest([100, 1000, 10000]) AS top),
p AS (SELECT a.v AS gold, o.v AS other, s.top, a.token, a.x, m.n AS m FROM g a JOIN (SELECT DISTINCT v FROM c) o ON a.v <> o.v JOIN s ON a.x <= s.top LEFT JOIN c m ON m.v = o.v AND m.token = a.token),
r AS (SELECT *, rank() OVER (PARTITION BY gold, other, top ORDER BY coalesce(m, -1) DESC, CASE WHEN m IS NOT NULL THEN token END) AS low FROM p),
y AS (SELECT *, low + (count(*) OVER (PARTITION BY gold, other, top, low) - 1) / 2.0 AS y FROM r)
SELECT gold, other, top, count(*) AS words, CASE WHEN count(*) < top THEN NULL ELSE round(corr(x, y), 9) END AS rho FROM y GROUP BY 1, 2, 3"""
)
def vocabulary_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """All ordered pairs of three corpora, for the 100, 1,000 and 10,000 most frequent words."""
    return _correlations(spark, sf).select("gold", "other", "top", "words", F.round("rho", 9).alias("rho"))


@query()
def vocabulary_correlation_p(spark: SparkSession, sf: str) -> DataFrame:
    """The same with p-values; SQL has no incomplete beta function."""
    return _correlations(spark, sf)


def _correlations(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("text", "lang")
    counted = {"documents": docs, "corpus": table(spark, sf, "corpus").select("text"), "english": docs.where("lang = 'en'")}
    return stats.vocabulary_correlations({k: materialize(stats.vocabulary(v), "vocabulary") for k, v in counted.items()})


# --- paragraphs, pages, languages, the whole pipeline ----------------------------------------------------------------


@query("""WITH p AS (SELECT record_id, idx, length(text) AS n, link_chars::FLOAT / nullif(length(text), 0)::FLOAT AS density, link_chars, text FROM paragraphs)
SELECT record_id, idx, CASE WHEN coalesce(density, 0)::DOUBLE > 0.2::DOUBLE OR instr(text, '\\xa9') > 0 OR instr(text, '&copy') > 0 THEN 'bad' WHEN n < 70 THEN CASE WHEN link_chars > 0 OR n = 0 THEN 'bad' ELSE 'short' END WHEN n > 200 THEN 'good' ELSE 'neargood' END AS cf_class FROM (SELECT DISTINCT * FROM p)""".replace("\\\\", "\\"))
def context_free_classes(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.classify_blocks(table(spark, sf, "paragraphs")).select("record_id", "idx", "cf_class")


def _html(spark: SparkSession, sf: str) -> DataFrame:
    found = pipeline.pages(table(spark, sf, "warc_raw"))
    return found.select("record_id", "record_no", html_of(F.col("content"), http.page_charset(http.header(F.col("content")))).alias("html"))


@query()
def page_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.paragraphs_of(_html(spark, sf))


@query()
def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    pages = _html(spark, sf)
    return pages.select("record_id", boilerplate.boilerplate_text(F.col("html")).alias("text"), boilerplate.boilerplate_html(F.col("html")).alias("html"))


@query()
def page_charsets(spark: SparkSession, sf: str) -> DataFrame:
    found = pipeline.pages(table(spark, sf, "warc_raw"))
    return found.groupBy(detect_charset(F.col("content"), http.page_charset(http.header(F.col("content")))).alias("charset")).agg(F.count("*").alias("n"))


def _identifier(spark: SparkSession, sf: str) -> Identifier:
    return Identifier.of(train(table(spark, sf, "lang_samples")))


@query()
def document_languages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.col("lang").alias("label"), _identifier(spark, sf).column(F.col("text")).alias("language"))


@query()
def cleaning_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned pages against the texts of the corpus."""
    found = page_texts(spark, sf).select("record_id", "text").dropDuplicates(["record_id"])
    gold = table(spark, sf, "corpus").select("record_id", F.col("text").alias("gold")).dropDuplicates(["record_id"])
    return evaluation.cleaning_scores(evaluation.cleaning_counts(gold.join(found, "record_id"), id="record_id"))


@query()
def clean_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.clean(table(spark, sf, "warc_raw"), _identifier(spark, sf))


@query()
def whole_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.run_all(table(spark, sf, "warc_raw"), _identifier(spark, sf))


@query()
def stripped_records(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.strip_warc(table(spark, sf, "warc_raw"))


@query("SELECT record_id, warc_type, warc_date, content_type, target_uri, octet_length(content) AS content_length, md5(content) AS digest FROM warc_raw")
def warc_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Records written as segments into the shared folder and read again."""
    warc.register(spark)
    path = _folder(spark, "warc")
    table(spark, sf, "warc_raw").drop("content_length").write.format("warc").mode("append").options(path=path, segmentSize="1000000").save()
    back = spark.read.format("warc").load(path)
    return back.select("record_id", "warc_type", "warc_date", "content_type", "target_uri", F.col("content_length").cast("bigint"), F.md5("content").alias("digest"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, without a scheme, as the WARC format opens files by path."""
    return os.path.join(shared_dir(spark).removeprefix("file://").removeprefix("file:"), f"{name}-{uuid.uuid4().hex}")


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = table(spark, sf, name).schema
    if os.path.isdir(f"{sf}/{name}.parquet"):
        return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parquet")
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def _corpus_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, "corpus")


_FOUND = "language IS NOT NULL AND license IS NOT NULL AND language <> '' AND license <> '' AND no_boilerplate IS NOT NULL AND minimal_html IS NOT NULL AND record_id IS NOT NULL"


@query(f"SELECT record_id, target_uri, source_path, license, language, no_boilerplate, minimal_html, simhash, octet_length(encode(text)) AS content_length, md5(text) AS digest FROM corpus WHERE {_FOUND} AND text IS NOT NULL AND coalesce(NOT regexp_matches(language, '[\r\n]'), true)")
def warc_corpus_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus written as WARC by output prefix, as phase 1 leaves it, and read again with all that was found out."""
    warc.register(spark)
    whole = table(spark, sf, "corpus").where(f"{_FOUND} and text is not null and not regexp_like(language, '[\\\\r\\\\n]')")
    path = _folder(spark, "warc-corpus")
    pipeline.write_warc(whole.select("record_id", "target_uri", "source_path", "license", "language", "no_boilerplate", "minimal_html", "simhash", "text"), path)
    back = pipeline.corpus_of(spark.read.format("warc").load(path))
    return back.select("record_id", "target_uri", "source_path", "license", "language", "no_boilerplate", "minimal_html", "simhash", F.col("content_length").cast("bigint"), F.md5(F.encode("text", "UTF-8")).alias("digest"))


@query(f"SELECT license, language, no_boilerplate, minimal_html, count(*) AS n, count(DISTINCT record_id) AS records FROM corpus WHERE {_FOUND} GROUP BY 1, 2, 3, 4")
def parquet_by_output(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus written in a folder for each output, and read again from those."""
    path = _folder(spark, "outputs")
    pipeline.write_parquet(table(spark, sf, "corpus").where(_FOUND), path)
    back = spark.read.schema("record_id string, license string, language string, no_boilerplate boolean, minimal_html boolean").parquet(path)
    return back.groupBy("license", "language", "no_boilerplate", "minimal_html").agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("records"))


@query("SELECT source_path, record_no FROM warc_raw WHERE target_uri IN (SELECT target_uri FROM corpus WHERE license = 'by-sa')")
def pages_of_a_list_file(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses written as tab-separated lines, read again as a list, and the records that it names."""
    path = _folder(spark, "urls")
    texts.write_tsv(table(spark, sf, "corpus").where("license = 'by-sa' and target_uri is not null").select("record_id", "target_uri"), path, "gzip")
    raw = table(spark, sf, "warc_raw").select("source_path", "record_no", "target_uri")
    return stats.listed_pages(raw, texts.url_list(spark, path)).select("source_path", "record_no")


@query("SELECT target_uri AS key, sum(content_length)::BIGINT AS total FROM warc_raw GROUP BY target_uri")
def bytes_by_address(spark: SparkSession, sf: str) -> DataFrame:
    return stats.sum_by(table(spark, sf, "warc_raw"), F.col("target_uri").alias("key"), F.col("content_length"))


@query(f"WITH {_HASHES}, lic AS (SELECT source_path, record_no, list_distinct(regexp_extract_all(CAST(content AS VARCHAR), 'https?://creativecommons\\.org/licenses/(by|by-sa|by-nd|by-nc|by-nc-sa|by-nc-nd|publicdomain)[\"/ >]', 1)) AS k FROM warc_raw WHERE content IS NOT NULL) SELECT 'simhash' AS what, CAST(doc_id AS VARCHAR) AS id, CAST(simhash AS VARCHAR) AS value FROM f UNION ALL SELECT 'license', source_path || ' ' || record_no, CASE WHEN len(k) = 0 THEN 'none' WHEN len(k) = 1 THEN k[1] ELSE 'cc-unspecified' END FROM lic")
def functions_in_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints and licences by the functions registered for SQL."""
    surface.register(spark)
    table(spark, sf, "documents").createOrReplaceTempView("corpusmill_documents")
    table(spark, sf, "warc_raw").createOrReplaceTempView("corpusmill_raw")
    return spark.sql("""SELECT 'simhash' AS what, cast(doc_id AS string) AS id, cast(simhash64(text) AS string) AS value FROM corpusmill_documents WHERE text IS NOT NULL
        UNION ALL SELECT 'license', concat_ws(' ', source_path, record_no), cc_license(decode(content, 'ISO-8859-1')) FROM corpusmill_raw WHERE content IS NOT NULL""")


@query()
def paragraphs_in_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The table function on all pages."""
    surface.register(spark)
    _html(spark, sf).createOrReplaceTempView("corpusmill_pages")
    return spark.sql("SELECT record_id, p.idx, p.text, p.cf_class, p.class FROM corpusmill_pages, LATERAL paragraphs(html) p")


@query("SELECT strftime(ingested_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, language, license, count(*) AS documents, sum(len(regexp_extract_all(text, '[ \\t\\n\\v\\f\\r]+')) + 1)::BIGINT AS tokens FROM corpus WHERE ingested_at IS NOT NULL GROUP BY 1, 2, 3")
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts of the corpus read as a stream, until all that is there has been read; no row is late then."""
    shared = os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex}")
    source = _corpus_stream(spark, sf)
    counts = streams.counts_by_window(source, late="3650 days")
    path = f"{shared}/counts"
    # every batch replaces the table of counts in the shared folder; nothing is held in the driver
    job = counts.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).option("checkpointLocation", f"{shared}/state").trigger(availableNow=True).start()
    job.awaitTermination()
    back = spark.read.schema(counts.schema).parquet(path)
    return back.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "language", "license", "documents", "tokens")


@query("SELECT octet_length(encode(text)) AS bytes, simhash, 1 AS n FROM corpus WHERE text IS NOT NULL AND ingested_at IS NOT NULL GROUP BY 1, 2")
def stream_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """How many records of each (length, fingerprint) the stream of the corpus lets through: one."""
    shared = os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex}")
    source = _corpus_stream(spark, sf).where("text is not null and ingested_at is not null").select("record_id", "text", "simhash", "ingested_at")
    kept = streams.drop_exact_stream(source, late="3650 days")
    job = kept.select(F.octet_length("text").cast("bigint").alias("bytes"), "simhash").writeStream.format("parquet").option("path", f"{shared}/kept").option("checkpointLocation", f"{shared}/state").trigger(availableNow=True).start()
    job.awaitTermination()
    return spark.read.schema("bytes bigint, simhash bigint").parquet(f"{shared}/kept").groupBy("bytes", "simhash").agg(F.count("*").cast("int").alias("n"))


@query()
def stream_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Phase 1 on the raw records read as a stream, with the same result as ``clean_corpus``."""
    shared = os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex}")
    cleaned = streams.clean_stream(_stream(spark, sf, "warc_raw"), _identifier(spark, sf))
    job = cleaned.writeStream.format("parquet").option("path", f"{shared}/cleaned").option("checkpointLocation", f"{shared}/state").trigger(availableNow=True).start()
    job.awaitTermination()
    return spark.read.schema(cleaned.schema).parquet(f"{shared}/cleaned")
