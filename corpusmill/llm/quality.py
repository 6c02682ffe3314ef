"""Problem 5: per-document text statistics and how far a document lies from prose.

Method: mean and covariance of all statistics over the prose of each language, fitted after trimming what lies far
from the median of any statistic; the squared Mahalanobis distance of a document from its language's prose is split
into each statistic's share of it. The verdict follows the distance: a page is no natural prose if it lies farther
from its language's prose than ``off2``, and if the part that the form of its lines has in that distance is more than
the model gives a page that is prose but for half of its characters in lists, tables or junk. The covariance decides
how much of the form the other statistics account for; a distance that other statistics make (messages, verse,
garbled letters, links) is no lack of prose.

Defined results: texts without words have the statistics 0 and are natural (there is nothing that is not prose);
languages with little prose use the prose of all.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATS = ["log_words", "word_len", "symbols", "closed", "common", "digits", "upper", "shaped", "linked"]
ALL = "*"


def statistics(profiles: DataFrame) -> DataFrame:
    chars = F.greatest(F.col("chars"), F.lit(1))
    return profiles.withColumns(
        {
            "lang": F.coalesce("lang", F.lit("?")),
            "log_words": F.log1p(F.col("n_words").cast("double")),
            "shaped": (F.col("list") + F.col("table") + F.col("junk")) / chars,
            "linked": (F.col("link") + F.col("tags")) / chars,
        }
    )


def fit(stats: DataFrame, least: int = 60, ridge: float = 1e-4) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean and inverse covariance of prose by language. Two aggregations over all rows; the driver gets a row a
    language of common_words, whatever the corpus."""
    prose = stats.where((F.col("n_words") >= 8) & (F.col("prose") >= 0.8 * F.col("chars")) & (F.col("filler") + F.col("said") <= 0.5 * F.col("chars")))
    half = [F.percentile_approx(k, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q_{k}") for k in STATS]
    middle = prose.groupBy("lang").agg(*half)
    near = prose.join(F.broadcast(middle), "lang")
    for k in STATS:
        q = F.col(f"q_{k}")
        near = near.where(F.abs(F.col(k) - q[1]) <= 4 * F.greatest((q[2] - q[0]) / 1.349, F.lit(0.01)))
    sums = [F.count("*").alias("n"), *(F.sum(k).alias(f"s_{k}") for k in STATS)]
    sums += [F.sum(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for i, a in enumerate(STATS) for j, b in enumerate(STATS) if i <= j]
    rows = {r["lang"]: r for r in near.groupBy("lang").agg(*sums).collect()}
    out = {}
    d = len(STATS)

    def model(of: list) -> tuple[np.ndarray, np.ndarray]:
        n = sum(r["n"] for r in of)
        mean = np.array([sum(r[f"s_{k}"] for r in of) / n for k in STATS])
        cov = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                cov[i, j] = cov[j, i] = sum(r[f"p_{i}_{j}"] for r in of) / n - mean[i] * mean[j]
        return mean, np.linalg.inv(cov + np.eye(d) * ridge)

    if rows:
        out[ALL] = model(list(rows.values()))
    for lang, r in rows.items():
        if r["n"] >= least:
            out[lang] = model([r])
    return out


def distances(stats: DataFrame, models: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Adds distance2 and a part_<statistic> for each statistic; the parts add up to distance2. Stays in the JVM:
    the models are a few small constants by language."""
    spark = stats.sparkSession
    if not models:
        return stats.withColumns({"distance2": F.lit(0.0), "half_shaped": F.lit(0.0)} | {f"part_{k}": F.lit(0.0) for k in STATS})
    rows = [(lang, [float(x) for x in mean], [[float(x) for x in row] for row in inv]) for lang, (mean, inv) in models.items()]
    table = spark.createDataFrame(rows, "m_lang string, mean array<double>, inv array<array<double>>")
    known = F.col("lang").isin(*[k for k in models if k != ALL]) if len(models) > 1 else F.lit(False)
    df = stats.withColumn("m_lang", F.when(known, F.col("lang")).otherwise(ALL)).join(F.broadcast(table), "m_lang")
    off = [F.col(k) - F.col("mean")[i] for i, k in enumerate(STATS)]
    df = df.withColumn("_d", F.array(*off))
    parts = {}
    for i, k in enumerate(STATS):
        row = sum((F.col("inv")[i][j] * F.col("_d")[j] for j in range(len(STATS))), F.lit(0.0))
        parts[f"part_{k}"] = F.col("_d")[i] * row
    df = df.withColumns(parts)
    total = sum((F.col(f"part_{k}") for k in STATS), F.lit(0.0))
    i = STATS.index("shaped")
    half = F.col("inv")[i][i] * F.pow(F.lit(0.5) - F.col("mean")[i], 2)
    return df.withColumn("distance2", total).withColumn("half_shaped", half).drop("_d", "mean", "inv", "m_lang")


def quality(profiles: DataFrame, off2: float = 30.0, of: DataFrame | None = None) -> DataFrame:
    """One row a record: the statistics, the distance with its parts, and natural. The prose compared with is
    that of the profiles ``of``, where they are others than those judged."""
    stats = statistics(profiles)
    scored = distances(stats, fit(stats if of is None else statistics(of)))
    unlike = (F.col("distance2") > off2) & (F.col("part_shaped") > F.col("half_shaped"))
    return scored.withColumn("natural", ~unlike)
