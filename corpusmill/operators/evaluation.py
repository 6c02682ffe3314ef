"""Scores of predictions against gold data."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import LICENSES, NO_LICENSE

ARTICLE_MARKS = re.compile(r"^\s*<(p|h|l)>\s*", re.I)


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    return [p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1")]


def license_scores(rows: DataFrame, gold: str = "gold", predicted: str = "predicted") -> DataFrame:
    """One row: tp, tn, fp, fn, precision, recall, f1. A named licence is positive, ``none`` negative; one licence taken
    for another and cc-unspecified count for nothing."""
    named = lambda c: F.col(c).isin(*LICENSES)
    none = lambda c: F.col(c) == NO_LICENSE
    counts = rows.agg(
        F.count_if(named(gold) & (F.col(gold) == F.col(predicted))).alias("tp"),
        F.count_if(none(gold) & none(predicted)).alias("tn"),
        F.count_if(none(gold) & named(predicted)).alias("fp"),
        F.count_if(named(gold) & none(predicted)).alias("fn"),
    )
    return counts.select("tp", "tn", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")))


def gold_parts(text: str) -> list[str]:
    """The segments of a gold or cleaned text: its marks off, the address line off, empty lines left out."""
    out = []
    for line in (text or "").split("\n"):
        if line.startswith("URL:"):
            continue
        line = " ".join(ARTICLE_MARKS.sub("", line).split())
        if line:
            out.append(line)
    return out


def overlap(gold: list[str], found: list[str]) -> int:
    """The elements that two sequences have in common, in order."""
    return sum(m.size for m in SequenceMatcher(None, gold, found, autojunk=False).get_matching_blocks())


def cleaning_counts(pairs: DataFrame, id: str = "file", gold: str = "gold", found: str = "text") -> DataFrame:
    """By document and unit (words, segments): tp, fp, fn. Compares whole texts in Arrow batches."""

    def run(frames):
        for frame in frames:
            rows = []
            for key, g, f in zip(frame["id"], frame["gold"], frame["found"]):
                a, b = gold_parts(g), gold_parts(f)
                words = [" ".join(x).split() for x in (a, b)]
                for unit, x, y in (("words", *words), ("segments", a, b)):
                    tp = overlap(x, y)
                    rows.append((key, unit, tp, len(y) - tp, len(x) - tp))
            yield pd.DataFrame(rows, columns=["id", "unit", "tp", "fp", "fn"])

    kind = dict(pairs.dtypes)[id]
    rows = pairs.select(F.col(id).alias("id"), F.col(gold).alias("gold"), F.col(found).alias("found"))
    return rows.mapInPandas(run, f"id {kind}, unit string, tp bigint, fp bigint, fn bigint").withColumnRenamed("id", id)


def cleaning_scores(counts: DataFrame) -> DataFrame:
    """By unit: means and deviations over documents, and the scores of the summed counts."""
    each = counts.select("unit", "tp", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")))
    names = ("precision", "recall", "f1")
    sums = each.groupBy("unit").agg(
        F.count("*").alias("documents"), *(F.avg(n).alias(f"macro_{n}") for n in names), *(F.stddev_samp(n).alias(f"sd_{n}") for n in names), *(F.sum(c).alias(c) for c in ("tp", "fp", "fn"))
    )
    micro = [c.alias(f"micro_{n}") for n, c in zip(names, prf(F.col("tp"), F.col("fp"), F.col("fn")))]
    return sums.select("unit", "documents", *(f"macro_{n}" for n in names), *(f"sd_{n}" for n in names), *micro)
