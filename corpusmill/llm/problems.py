"""The queries of the ten problems, over whole tables with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import charset, langlabel, lines, mainbody, mixing, packing, pages, pii, quality, residue, spam, tokens
from corpusmill.plans.shared import materialize, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _corpus(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return table(spark, sf, "corpus").select(*columns)


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    """One profile a record, written once, as all that follows reads it more than once."""
    return _profiles_of(_corpus(spark, sf, "record_id", "text"), table(spark, sf, "common_words"))


def _profiles_of(corpus: DataFrame, words: DataFrame) -> DataFrame:
    return materialize(materialize(pages.page_profiles(corpus, words), "page-profiles").dropDuplicates(["record_id"]), "profiles")


@query
def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return lines.repeated_lines(_corpus(spark, sf, "source_path", "record_id", "text", "ingested_at"), part=lines.period())


@query
def p1_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    docs = _corpus(spark, sf, "source_path", "record_id", "text", "ingested_at")
    return lines.rebuild(docs, lines.repeated_lines(docs, part=lines.period()))


@query
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return spam.spam(_profiles(spark, sf)).where("is_spam").select("record_id")


@query
def p2_curves(spark: SparkSession, sf: str) -> DataFrame:
    return spam.spam(_profiles(spark, sf)).select("record_id", "lang", "n_words", "slope", "residual", "curve", *(f"z_{k}" for k in spam.FIGURES), "is_spam")


@query
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return charset.find_damaged(_corpus(spark, sf, "record_id", "source_path", "text"), charset.bigram_counts(table(spark, sf, "lang_samples"))).select("record_id")


@query
def p3_restored(spark: SparkSession, sf: str) -> DataFrame:
    return charset.repair(_corpus(spark, sf, "record_id", "source_path", "text"), table(spark, sf, "lang_samples"), table(spark, sf, "warc_raw"))


def _not_prose(profiles: DataFrame, of: DataFrame | None = None) -> DataFrame:
    unnatural = quality.quality(profiles, of=of).where(~F.col("natural")).select("record_id")
    return unnatural.unionByName(spam.spam(profiles, of=of).where("is_spam").select("record_id")).distinct()


@query
def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """The other problems' cases are left out: their operators judge the pages that have something to correct, no others,
    by the references of the whole corpus, as p2_found and p5_found do."""
    corpus = _corpus(spark, sf, "record_id", "target_uri", "source_path", "text", "language")
    keep = ("target_uri", "source_path", "text")
    seen = materialize(langlabel.wrong_labels(corpus, table(spark, sf, "lang_samples"), keep, table(spark, sf, "common_words")), "labels")
    theirs = materialize(seen.where("found is not null").select("record_id", *keep, "found").dropDuplicates(["record_id"]), "wrong-labels")
    profiles = materialize(seen.drop(*keep, "found").dropDuplicates(["record_id"]), "profiles")
    every = materialize(spam.curves(profiles), "curves")
    profiles = every.join(theirs.select("record_id"), "record_id", "left_semi")
    other = _not_prose(profiles, every)
    other = other.unionByName(residue.residue_among(corpus, table(spark, sf, "common_words"), theirs))
    other = other.unionByName(charset.find_damaged(theirs, charset.bigram_counts(table(spark, sf, "lang_samples"))).select("record_id"))
    found = theirs.select("record_id", F.explode("found").alias("f")).select("record_id", "f.line_no", "f.lang")
    return found.join(other, "record_id", "left_anti").distinct()


@query
def p4_languages(spark: SparkSession, sf: str) -> DataFrame:
    corpus = _corpus(spark, sf, "record_id", "text")
    return langlabel.languages(corpus, table(spark, sf, "lang_samples")).dropDuplicates(["record_id", "line_no"])


@query
def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return _not_prose(_profiles(spark, sf))


@query
def p5_statistics(spark: SparkSession, sf: str) -> DataFrame:
    scored = quality.quality(_profiles(spark, sf))
    parts = [f"part_{k}" for k in quality.STATS]
    return scored.select("record_id", "lang", "n_words", *quality.STATS[1:], "distance2", *parts, "natural")


@query
def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    corpus = _corpus(spark, sf, "record_id", "target_uri", "source_path", "text")
    return residue.residue(corpus, table(spark, sf, "common_words")).select("record_id")


@query
def p6_kept(spark: SparkSession, sf: str) -> DataFrame:
    corpus = _corpus(spark, sf, "record_id", "target_uri", "source_path", "text")
    gone = residue.residue(corpus, table(spark, sf, "common_words")).select("record_id")
    return corpus.where("record_id is not null").select("record_id").distinct().join(gone, "record_id", "left_anti")


@query
def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return mainbody.main_body(table(spark, sf, "paragraphs")).where("not main").select("record_id", "idx")


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_table(table(spark, sf, "documents").select("doc_id", "source", "text"))


@query
def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packing(_tokens(spark, sf), table(spark, sf, "containers"))


@query
def p8_unused(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill_report(p8_packed(spark, sf))


@query
def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    tokens_of = materialize(_tokens(spark, sf), "tokens")
    return packing.mixture_report(packing.packing(tokens_of, table(spark, sf, "containers")), tokens_of)


@query
def p9_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_tokens(spark, sf), table(spark, sf, "mix_targets"))[0]


@query
def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_tokens(spark, sf), table(spark, sf, "mix_targets"))[1]


@query
def p9_tempered(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a mix with the natural shares of the targets' sources, tempered half-way to equal ones in entropy."""
    return mixing.mix(_tokens(spark, sf), table(spark, sf, "mix_targets"), tempered=True)[1]


#: Keys made for applications that set none.
_keys: dict[str, bytes] = {}


def _redacted(spark: SparkSession, sf: str) -> DataFrame:
    """With the secret key of the setting spark.corpusmill.key, or else one made at random for this application."""
    key = spark.conf.get("spark.corpusmill.key", None) or _keys.setdefault(spark.sparkContext.applicationId, os.urandom(32))
    return pii.redacted(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "common_words"), key)


@query
def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return pii.entities(_redacted(spark, sf)).select("doc_id", "start_char", "kind").distinct()


@query
def p10_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return _redacted(spark, sf).select("doc_id", "text", F.size("pieces").alias("pieces"))


@query
def p10_coreference(spark: SparkSession, sf: str) -> DataFrame:
    return pii.coreference(pii.entities(_redacted(spark, sf)))
