"""The operators on streams: cleaning is stateless and runs unchanged; duplicates are dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text
from corpusmill.functions.language import Identifier
from corpusmill.plans import pipeline


def clean_stream(records: DataFrame, languages: Identifier | None = None, options: pipeline.Options = pipeline.Options()) -> DataFrame:
    """Phase 1 on a stream of raw records."""
    return pipeline.clean(records, languages, options)


def drop_exact_stream(corpus: DataFrame, time: str = "ingested_at", late: str = "7 days") -> DataFrame:
    """The first record of each (length in bytes, fingerprint) within ``late``; the state is bounded by that time."""
    keyed = corpus.withColumn("_bytes", F.octet_length("text")).withWatermark(time, late)
    return keyed.dropDuplicatesWithinWatermark(["_bytes", "simhash"]).drop("_bytes")


def counts_by_window(corpus: DataFrame, time: str = "ingested_at", window: str = "1 day", late: str = "7 days") -> DataFrame:
    """(start, language, license, documents, tokens) of tumbling windows; rows later than ``late`` are not counted."""
    w = F.window(time, window)
    return (
        corpus.withWatermark(time, late)
        .groupBy(w.alias("w"), "language", "license")
        .agg(F.count("*").alias("documents"), F.sum(text.word_count(F.col("text"))).alias("tokens"))
        .select(F.col("w.start").alias("start"), "language", "license", "documents", "tokens")
    )
