"""The functions as SQL: ``register(spark)`` makes them known to a session.

``cc_license`` and ``registrable_domain`` are SQL functions, which the optimiser takes apart like any expression; the others
work on Arrow batches. ``paragraphs(html)`` is a table function:

    SELECT p.idx, p.text, p.class FROM pages, LATERAL paragraphs(html) p

Null arguments give null, or no paragraphs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusmill.functions import boilerplate, domains, text
from corpusmill.functions.charset import detect_charset, html_of
from corpusmill.functions.language import Identifier
from corpusmill.functions.simhash import simhash

PARAGRAPHS = "idx int, text string, link_chars int, tag_path string, is_heading boolean, cf_class string, class string"


class Paragraphs:
    """The paragraphs of a page, in order."""

    def eval(self, html: str):
        for i, p in enumerate(boilerplate.classify(boilerplate.segment(html))):
            yield i, p.text, p.link_chars, p.tag_path, p.is_heading, p.cf_class, p.kind


def register(spark: SparkSession, languages: Identifier | None = None) -> None:
    """Registers the functions in a session; ``detect_language`` only where a model is given."""
    for name, function in (("boilerplate_text", boilerplate.boilerplate_text), ("boilerplate_html", boilerplate.boilerplate_html), ("detect_charset", detect_charset), ("html_of", html_of), ("simhash64", simhash)):
        spark.udf.register(name, function)
    spark.udtf.register("paragraphs", F.udtf(Paragraphs, returnType=PARAGRAPHS))
    kinds = "|".join(text.LICENSES)
    found = f"array_distinct(regexp_extract_all(html, 'https?://creativecommons[.]org/licenses/({kinds})[\"/ >]', 1))"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION cc_license(html STRING) RETURNS STRING "
        f"RETURN CASE WHEN html IS NULL THEN NULL WHEN size({found}) = 0 THEN '{text.NO_LICENSE}' WHEN size({found}) = 1 THEN {found}[0] ELSE '{text.SEVERAL}' END"
    )
    labels, suffixes = "split(lower(host), '[.]')", ", ".join(f"'{x}'" for x in domains.TWO_LABEL_SUFFIXES)
    last = f"substring_index(lower(host), '.', -2) IN ({suffixes})"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION registrable_domain(host STRING) RETURNS STRING "
        f"RETURN CASE WHEN size({labels}) < 3 THEN lower(host) WHEN {last} THEN substring_index(lower(host), '.', -3) ELSE substring_index(lower(host), '.', -2) END"
    )
    if languages is not None:
        identify = languages.identify

        @F.pandas_udf(StringType())
        def detect_language(texts: pd.Series) -> pd.Series:
            return texts.map(identify)

        spark.udf.register("detect_language", detect_language)
