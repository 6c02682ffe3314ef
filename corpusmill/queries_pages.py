"""Queries of the boilerplate remover on pages that are given block by block, and their equivalents in SQL.

The SQL states the rules with windows: what a short paragraph's neighbours are, how far headings reach, and how a run of
nearly good paragraphs is settled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import boilerplate
from corpusmill.plans.shared import materialize, table
from corpusmill.queries import SQL, query

#: The blocks of each page once, with their class by themselves in cf_class, their place and the characters up to their end.
_BLOCKS = """p AS (SELECT DISTINCT record_id, idx, text, {free} AS cf_class, coalesce(is_heading, false) AS h, length(text) AS len FROM paragraphs WHERE record_id IS NOT NULL AND idx IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY idx) AS i, count(*) OVER (PARTITION BY record_id) AS n, sum(len) OVER (PARTITION BY record_id ORDER BY idx) AS upto FROM p)"""

_RULES = """
a AS (SELECT *, min(CASE WHEN cf_class = 'good' THEN upto - len END) OVER later AS good_at FROM o WINDOW later AS (PARTITION BY record_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
b AS (SELECT *, CASE WHEN h AND cf_class = 'short' AND good_at - upto <= 200 THEN 'neargood' ELSE cf_class END AS k FROM a),
c AS (SELECT *, lag(k) OVER page AS k_before, lead(k) OVER page AS k_after,
  arg_max(k, i) FILTER (WHERE k IN ('good', 'bad')) OVER prior AS before_kind, arg_min(k, i) FILTER (WHERE k IN ('good', 'bad')) OVER later AS after_kind,
  min(i) FILTER (WHERE k IN ('good', 'bad')) OVER later AS after_at, max(i) FILTER (WHERE k <> 'short') OVER prior AS said_before, min(i) FILTER (WHERE k <> 'short') OVER later AS said_after
  FROM b WINDOW page AS (PARTITION BY record_id ORDER BY i), prior AS (PARTITION BY record_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), later AS (PARTITION BY record_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
d AS (SELECT *, coalesce(after_at - i <= 10, false) AS found, coalesce(before_kind, 'bad') AS l, CASE WHEN after_at - i <= 10 THEN after_kind ELSE 'bad' END AS r FROM c),
e AS (SELECT *, coalesce(bool_or(k = 'short' AND found) OVER (PARTITION BY record_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS older FROM d),
f AS (SELECT *, coalesce(k_before = 'neargood' OR (before_kind IS NULL AND said_before IS NOT NULL), false) AS near_l,
  coalesce(CASE WHEN found THEN k_after = 'neargood' WHEN n - i > 10 THEN said_after - i <= 10 WHEN older THEN said_after IS NOT NULL ELSE k_after = 'neargood' END, false) AS near_r FROM e),
g AS (SELECT *, CASE WHEN k <> 'short' THEN k WHEN l = r THEN l WHEN (l = 'bad' AND near_l) OR (r = 'bad' AND near_r) THEN 'good' ELSE 'bad' END AS k2 FROM f),
j AS (SELECT *, arg_max(k2, i) FILTER (WHERE k2 <> 'neargood') OVER prior AS b2, arg_min(k2, i) FILTER (WHERE k2 <> 'neargood') OVER later AS a2, min(i) FILTER (WHERE k2 <> 'neargood') OVER later AS a2_at
  FROM g WINDOW prior AS (PARTITION BY record_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), later AS (PARTITION BY record_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
m AS (SELECT *, CASE WHEN k2 <> 'neargood' THEN k2 WHEN b2 = 'good' OR (a2 = 'good' AND a2_at - i <= 10) THEN 'good' ELSE 'bad' END AS k3 FROM j),
q AS (SELECT *, min(CASE WHEN k3 = 'good' THEN upto - len END) OVER (PARTITION BY record_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS good_after FROM m),
classes AS (SELECT record_id, idx, text, CASE WHEN h AND k3 = 'bad' AND cf_class <> 'bad' AND good_after - upto <= 200 THEN 'good' ELSE k3 END AS class FROM q)"""

_DENSE = "coalesce(link_chars::FLOAT / nullif(length(text), 0)::FLOAT, 0)::DOUBLE > 0.2::DOUBLE OR instr(text, '\\xa9') > 0 OR instr(text, '&copy') > 0"
_FREE = f"CASE WHEN {_DENSE} THEN 'bad' WHEN length(text) < 70 THEN CASE WHEN link_chars > 0 OR length(text) = 0 THEN 'bad' ELSE 'short' END WHEN length(text) > 200 THEN 'good' ELSE 'neargood' END"
_SPLIT = r"list_filter(regexp_split_to_array(text, '[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda w: w <> '')"
_SHARE = f"(len(list_filter({_SPLIT}, lambda w: list_contains(stop, lower(w))))::FLOAT / len({_SPLIT})::FLOAT)::DOUBLE"
_STOPPED = f"CASE WHEN {_DENSE} THEN 'bad' WHEN length(text) < 70 THEN CASE WHEN link_chars > 0 OR length(text) = 0 THEN 'bad' ELSE 'short' END WHEN {_SHARE} >= 0.32 THEN CASE WHEN length(text) > 200 THEN 'good' ELSE 'neargood' END WHEN {_SHARE} >= 0.30 THEN 'neargood' ELSE 'bad' END"


def _classes(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.classify_blocks(table(spark, sf, "paragraphs"))


@query("WITH " + _BLOCKS.format(free=_FREE) + "," + _RULES + " SELECT record_id, idx, class FROM classes")
def paragraph_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The classes of all blocks in their context, without stop words."""
    return _classes(spark, sf).select("record_id", "idx", "class")


_STOP_BLOCKS = _BLOCKS.format(free=_STOPPED).replace("FROM paragraphs WHERE", "FROM (SELECT *, (SELECT list(lower(word)) FROM common_words WHERE lang = 'en') AS stop FROM paragraphs) WHERE")


@query("WITH " + _STOP_BLOCKS + "," + _RULES + " SELECT record_id, idx, o.cf_class, class FROM classes JOIN o USING (record_id, idx)")
def paragraph_classes_with_stop_words(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the share of English stop words in a block."""
    words = table(spark, sf, "common_words").where("lang = 'en'").select("word").limit(10_001).collect()
    if len(words) > 10_000:
        raise ValueError("a list of stop words is short")
    found = boilerplate.classify_blocks(table(spark, sf, "paragraphs"), frozenset(r["word"].lower() for r in words))
    return found.select("record_id", "idx", "cf_class", "class")


_NORMAL = SQL["normalized_documents"]
_NORMAL = _NORMAL[: _NORMAL.index("SELECT doc_id, regexp_replace(t, '^[")].replace("WITH a AS", "na AS").replace("FROM documents", "FROM classes WHERE class = 'good'").replace("doc_id", "record_id, idx")
for _x, _y in (("b AS", "nb AS"), ("c AS", "nc AS"), ("d AS", "nd AS"), ("e AS", "ne AS")):
    _NORMAL = _NORMAL.replace(f"\n{_x}", f"\n{_y}")
for _x in "abcd":
    _NORMAL = _NORMAL.replace(f"FROM {_x})", f"FROM n{_x})")


@query("WITH " + _BLOCKS.format(free=_FREE) + "," + _RULES + ",\n" + _NORMAL + r" SELECT record_id, regexp_replace(string_agg(regexp_replace(t, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'), chr(10) ORDER BY idx), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS text FROM ne GROUP BY record_id")
def paragraph_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The text of each page: its good blocks, normalised, one a line."""
    return boilerplate.text_of_blocks(materialize(_classes(spark, sf), "classes"))


@query("WITH " + _BLOCKS.format(free=_FREE) + "," + _RULES + " SELECT class, count(*) AS blocks, sum(length(text))::BIGINT AS chars FROM classes GROUP BY class")
def class_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return _classes(spark, sf).groupBy("class").agg(F.count("*").alias("blocks"), F.sum(F.length("text")).alias("chars"))
