"""The five phases from raw records to a clean, deduplicated corpus, each DataFrame -> DataFrame.

Phase 1 needs no shuffle. Phases 2 to 4 shuffle ids and fingerprints; texts move once, in phase 2.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import boilerplate, http, text
from corpusmill.functions.charset import page_html
from corpusmill.functions.language import Identifier
from corpusmill.functions.simhash import simhash_of
from corpusmill.operators import dedup


@dataclass(frozen=True)
class Options:
    minimal_html: bool = False
    near: int = dedup.NEAR
    salt: int = 8


def pages(records: DataFrame) -> DataFrame:
    """HTML responses: cheap tests on fields first, then on the HTTP header."""
    return records.where(http.is_page(F.col("content_type"), F.col("content_length"), F.col("content")))


def clean(records: DataFrame, languages: Identifier | None = None, options: Options = Options(), unreadable: Accumulator | None = None) -> DataFrame:
    """Phase 1: pages with licence, text, language and fingerprint; pages without text are left out, and those that can't
    be read are counted in ``unreadable``.

    The licence is looked for in the JVM on the whole page before boilerplate goes; all that needs Python is one
    Arrow pass, so a page is handed over once.
    """
    schema = pa.schema([("record_id", pa.string()), ("target_uri", pa.string()), ("source_path", pa.string()), ("warc_date", pa.string()), ("content_type", pa.string()), ("text", pa.string()), ("html", pa.string()), ("language", pa.string()), ("simhash", pa.int64())])
    minimal = options.minimal_html

    def run(source):
        for batch in source:
            out = []
            for r in batch.to_pylist():
                try:
                    page = page_html(r["content"], r["charset"])
                    body = boilerplate.clean(page, minimal)
                except (ValueError, RecursionError):
                    if unreadable is not None:
                        unreadable.add(1)
                    continue  # a page that can't be read has no text
                if body:
                    plain = boilerplate.clean(page) if minimal else body
                    out.append({k: r[k] for k in ("record_id", "target_uri", "source_path", "warc_date", "content_type")} | {"text": body, "html": page, "language": languages.identify(plain) if languages else None, "simhash": simhash_of(plain)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    found = pages(records).select(
        "record_id", "target_uri", "source_path", "warc_date", http.page_type(http.header(F.col("content"))).alias("content_type"), http.page_charset(http.header(F.col("content"))).alias("charset"), "content"
    )
    ready = found.mapInArrow(run, "record_id string, target_uri string, source_path string, warc_date string, content_type string, text string, html string, language string, simhash bigint")
    return ready.select(
        "record_id", "target_uri", "source_path", "warc_date", "content_type", "text", F.octet_length("text").alias("content_length"), text.cc_license(F.col("html")).alias("license"),
        "language", F.lit(True).alias("no_boilerplate"), F.lit(minimal).alias("minimal_html"), "simhash",
    )


def corpus_of(records: DataFrame) -> DataFrame:
    """The corpus behind written WARC records: what phase 1 found out stands in their headers, the text in their content.
    Phases 2 to 5 start from it. Records without such headers have nulls."""

    def found(name: str):
        return F.try_element_at("headers", F.lit(name))

    flags = {c: F.lower(found(h)) == "true" for c, h in (("no_boilerplate", "c4_noBoilerplate"), ("minimal_html", "c4_minimalHtml"))}
    return records.select(
        "record_id", "target_uri", F.coalesce(found("c4_originalLocation"), "source_path").alias("source_path"), "warc_date", "content_type", F.decode("content", "UTF-8").alias("text"), F.octet_length("content").alias("content_length"),
        found("c4_license").alias("license"), found("c4_language").alias("language"), flags["no_boilerplate"].alias("no_boilerplate"), flags["minimal_html"].alias("minimal_html"), F.expr("try_cast(headers['c4_simhash'] as bigint)").alias("simhash"),
    )


def repair_fields(corpus: DataFrame) -> DataFrame:
    """Where a record has its origin in the field ``register``, as older files do, it is moved to source_path."""
    if "register" not in corpus.columns:
        return corpus
    moved = F.col("source_path").isNull() & F.col("register").isNotNull()
    return corpus.withColumns({"source_path": F.coalesce("source_path", "register"), "register": F.when(~moved, F.col("register"))})


def require(corpus: DataFrame, *columns: str) -> DataFrame:
    """The corpus, failing at the first record that lacks one of the columns."""
    for c in columns:
        corpus = corpus.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is missing")).cast(corpus.schema[c].dataType)).otherwise(F.col(c)))
    return corpus


def drop_exact(corpus: DataFrame) -> DataFrame:
    """Phase 2: one record of each (length in bytes, fingerprint)."""
    return dedup.exact_duplicates(corpus, F.octet_length("text"), F.col("simhash"))


def document_info(corpus: DataFrame) -> DataFrame:
    """Phase 3, step 1: (doc_id, doc_len, simhash, lang), the length in UTF-16 units."""
    beyond = F.length(F.regexp_replace(F.col("text"), r"[^\x{10000}-\x{10FFFF}]", ""))
    return corpus.select(F.col("record_id").alias("doc_id"), (F.length("text") + beyond).cast("int").alias("doc_len"), "simhash", F.col("language").alias("lang"))


def drop_near(corpus: DataFrame, options: Options = Options()) -> DataFrame:
    """Phases 3 and 4: records without those that a near duplicate beats."""
    return dedup.remove_ids(corpus, dedup.ids_to_delete(document_info(corpus), options.near))


def with_prefix(corpus: DataFrame) -> DataFrame:
    """Phase 5: the output of each record by licence, language and kind of text; a record without one of them is an error."""
    return require(corpus, "license", "language", "no_boilerplate", "minimal_html").withColumn("prefix", text.output_prefix(F.col("license"), F.col("language"), F.col("no_boilerplate"), F.col("minimal_html")))


def spread(corpus: DataFrame, options: Options = Options()) -> DataFrame:
    """Records gathered by their output, each output in ``salt`` parts, as one language may have most of them."""
    return corpus.repartition(F.col("license"), F.col("language"), F.pmod(F.xxhash64("record_id"), F.lit(options.salt)))


def write_parquet(corpus: DataFrame, path: str, options: Options = Options()) -> None:
    spread(repair_fields(corpus), options).write.mode("overwrite").partitionBy("license", "language", "no_boilerplate", "minimal_html").parquet(path)


def write_warc(corpus: DataFrame, path: str, options: Options = Options(), **writer: str) -> None:
    spread(with_prefix(repair_fields(corpus)), options).sortWithinPartitions("prefix").write.format("warc").mode("append").options(path=path, **writer).save()


def strip_warc(records: DataFrame, minimal_html: bool = False) -> DataFrame:
    """Records with their contents cleaned and all else as it was; lengths are set anew when they are written."""
    schema = pa.schema([("record_id", pa.string()), ("record_no", pa.int64()), ("text", pa.string())])

    def run(source):
        for batch in source:
            rows = [{"record_id": r["record_id"], "record_no": r["record_no"], "text": boilerplate.clean(page_html(r["content"], r["charset"]), minimal_html)} for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    found = records.where(http.is_response(F.col("content_type"))).select("record_id", "record_no", http.page_charset(http.header(F.col("content"))).alias("charset"), "content")
    return found.mapInArrow(run, "record_id string, record_no bigint, text string")


def run_all(records: DataFrame, languages: Identifier | None = None, options: Options = Options(), unreadable: Accumulator | None = None) -> DataFrame:
    """All phases. Phase 1 is written once, as its Python pass feeds three later reads."""
    from corpusmill.plans.shared import materialize

    first = materialize(clean(records, languages, options, unreadable), "phase1")
    return drop_near(materialize(drop_exact(first), "phase2"), options)
