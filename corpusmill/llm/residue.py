"""Problem 6: template residue and error-page text.

Method: normalised lines are counted by host, each record once. The lines that recur on a host are its boilerplate
(notices, bylines, share prompts and whatever else the site repeats; no list of wordings decides that) and are
subtracted from its pages. A record is found if an unfilled slot stands in it or if most of what is left after the
subtraction is an error or access message, filler, or a demand for browser features. A recurrent line that is itself
such evidence is what the page shows, so it stays.

A host with few records repeats little: lines that recur on ``sites`` hosts or more count as boilerplate everywhere.

Defined results: without text nothing is found; a record without a host counts with its source; repeated rows of an
id count once; rows without an id are left out.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.lines import delta, keyed, opening, opening_of_key, over, totals
from corpusmill.llm.pages import PROSE, Seen, unsuspicious
from corpusmill.llm.textkit import Lexicon, batches, clean, common_words
from corpusmill.plans.shared import materialize


def host_of(uri: str = "target_uri", source: str = "source_path") -> Column:
    return F.coalesce(F.lower(F.try_parse_url(F.col(uri), F.lit("HOST"))), F.col(source), F.lit(""))


_SCHEMA = pa.schema([("record_id", pa.string()), ("host", pa.string()), ("line_no", pa.int32()), ("line", pa.string()), ("told", pa.int32()), ("slots", pa.int32())])


def suspects(corpus: DataFrame, words_table: DataFrame) -> DataFrame:
    """(record_id, host, line_no, line, told, slots): the lines of the records with any evidence, and how much of each is
    evidence. One Arrow pass, no shuffle."""
    words = Lexicon(common_words(words_table))

    def run(batch: list[dict]) -> list[dict]:
        out = []
        for r in batch:
            if unsuspicious(r["text"], words):
                continue
            seen = Seen(r["text"], words)
            if seen.said or seen.filler or seen.slots or any(here for _, _, _, here, _ in seen.lines):
                raw = clean(r["text"]).split("\n")
                for no, n, kind, here, holes in seen.lines:
                    told = max(here, n if seen.faked and kind == PROSE else 0)
                    out.append({"record_id": r["record_id"], "host": r["host"], "line_no": no, "line": raw[no - 1], "told": told, "slots": holes})
        return out

    rows = corpus.where("record_id is not null and text is not null").select("record_id", host_of().alias("host"), "text")
    return rows.mapInArrow(batches(run, _SCHEMA), "record_id string, host string, line_no int, line string, told int, slots int")


def recurrent(lines: DataFrame, least: int, share: float, sites: int, records: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """((source, key), (key)): the lines that recur on a host, and those that do on ``sites`` hosts; lines come as
    (source, rec, key), hashes that are combined before each shuffle. ``records`` has all (source, rec), where the lines
    are not those of every record."""
    seen, counts = delta(lines)
    seen = seen if records is None else records
    counts = materialize(counts, "host-counts")
    counted = over(counts, totals(seen), least, share)
    wide = counts.groupBy("key").agg(F.count("*").alias("hosts"), F.sum("n").alias("n")).where((F.col("hosts") >= sites) & (F.col("n") >= least))
    return counted, wide.select("key")


def _judged(found: DataFrame, here: DataFrame, wide: DataFrame) -> DataFrame:
    """(record_id, slots, told, residual) of the records found among those of the lines ``found``."""
    left = found.join(here.withColumn("on_host", F.lit(True)), ["source", "key"], "left").join(wide.withColumn("on_hosts", F.lit(True)), "key", "left")
    taken = F.coalesce("on_host", F.lit(False)) | F.coalesce("on_hosts", F.lit(False))
    sums = left.groupBy("record_id").agg(
        F.sum("slots").alias("slots"), F.sum("told").alias("told"), F.sum(F.when(taken, F.col("told")).otherwise(F.greatest("chars", "told"))).alias("residual")
    )
    return sums.where((F.col("slots") > 0) | (F.col("told") > 0.5 * F.col("residual")))


def residue(corpus: DataFrame, words_table: DataFrame, among: DataFrame | None = None, least: int = 3, share: float = 0.05, sites: int = 3) -> DataFrame:
    """(record_id, slots, told, residual) of the records found; ``told`` is the evidence in the residual.

    ``among``: the rows of the corpus to be judged, where they are not all; the lines of every record are counted.
    """
    found = suspects(corpus if among is None else among, words_table)
    found = keyed(found).withColumn("key", F.xxhash64("key")).withColumn("chars", F.length(F.trim("line"))).withColumn("source", F.xxhash64("host")).drop("line", "host")
    found = materialize(found, "residue").dropDuplicates(["record_id", "line_no"])
    every = corpus.where("record_id is not null").select(F.xxhash64(host_of()).alias("source"), F.xxhash64("record_id").alias("rec"), F.explode(F.split("text", "\n")).alias("line"))
    return _judged(found, *recurrent(keyed(every).select("source", "rec", F.xxhash64("key").alias("key")), least, share, sites))


def residue_among(corpus: DataFrame, words_table: DataFrame, among: DataFrame, least: int = 3, share: float = 0.05, sites: int = 3) -> DataFrame:
    """(record_id) of the rows of the corpus ``among`` that ``residue`` finds.

    A line that recurs takes its characters from the residual and nothing else does. So a record with a slot, or with
    enough evidence if no line recurred, is found however often its lines occur, and one without evidence never is. For
    the others it is counted on all hosts and records how often their lines occur, but no other lines: lines of the corpus
    that open otherwise than all of those (``opening``) have other keys and need none made.
    """
    found = keyed(suspects(among, words_table)).withColumn("chars", F.length(F.trim("line"))).withColumn("source", F.xxhash64("host"))
    found = found.select("record_id", "line_no", "source", F.xxhash64("key").alias("key"), opening_of_key().alias("opening"), "told", "slots", "chars")
    found = materialize(found, "residue").dropDuplicates(["record_id", "line_no"])
    sums = found.groupBy("record_id").agg(F.sum("slots").alias("slots"), F.sum("told").alias("told"), F.sum(F.greatest("chars", "told")).alias("most"))
    sure = (F.col("slots") > 0) | (F.col("told") > 0.5 * F.col("most"))
    open_ids = sums.where(~sure & (F.col("told") > 0)).select("record_id")
    disputed = materialize(found.join(open_ids, "record_id", "left_semi"), "disputed")
    settled = sums.where(sure).select("record_id")
    if disputed.isEmpty():
        return settled
    # the mark stands for the openings that are not sure, which are all looked at
    openings = disputed.select("opening").union(disputed.sparkSession.createDataFrame([("#",)], "opening string")).distinct()
    rows = corpus.where("record_id is not null and text is not null").select(F.xxhash64(host_of()).alias("source"), F.xxhash64("record_id").alias("rec"), "text")
    lines = rows.select("source", "rec", F.explode(F.split("text", "\n")).alias("line")).withColumn("opening", F.coalesce(opening(), F.lit("#")))
    lines = keyed(lines.join(materialize(openings, "openings"), "opening", "left_semi")).select("source", "rec", F.xxhash64("key").alias("key"))
    lines = lines.join(disputed.select("key").distinct(), "key", "left_semi")
    here, wide = recurrent(lines, least, share, sites, records=rows.select("source", "rec").distinct())
    return settled.unionByName(_judged(disputed, here, wide).select("record_id"))
