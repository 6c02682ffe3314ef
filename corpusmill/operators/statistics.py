"""Counts over corpora: words, matches, domains, content types, languages by licence, vocabularies.

All are groupings with partial sums in the map tasks; counts are 64 bits.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.functions import domains, http, text


def sum_by(rows: DataFrame, key: Column, value: Column, name: str = "total") -> DataFrame:
    return rows.groupBy(key).agg(F.sum(value).cast("bigint").alias(name))


def _tokens(docs: DataFrame, column: str, tokens) -> DataFrame:
    lines = docs.select(F.explode(text.lines_of(F.col(column))).alias("line"))
    return lines.select(F.explode(tokens(F.col("line"))).alias("token"))


def word_count(docs: DataFrame, column: str = "text") -> DataFrame:
    """(token, n) of ASCII words, tags at the ends of lines taken off."""
    return _tokens(docs, column, lambda line: text.ascii_tokens(text.strip_line_tags(line))).groupBy("token").agg(F.count("*").alias("n"))


def vocabulary(docs: DataFrame, column: str = "text", form: str = "plain") -> DataFrame:
    """(token, n) of lower-case words; ``form``: plain, tagged (word/tag) or wiki."""
    tokens = {"plain": text.vocabulary_tokens, "tagged": text.tagged_tokens, "wiki": text.wiki_tokens}[form]
    return _tokens(docs, column, tokens).groupBy("token").agg(F.count("*").alias("n"))


def match_count(docs: DataFrame, pattern: str, column: str = "text") -> DataFrame:
    """(hit, n): what the pattern finds, line by line."""
    lines = docs.select(F.explode(text.lines_of(F.col(column))).alias("line"))
    return lines.select(F.explode(text.matches(F.col("line"), pattern)).alias("hit")).groupBy("hit").agg(F.count("*").alias("n"))


def top(counts: DataFrame, k: int, n: str = "n") -> DataFrame:
    """The ``k`` largest counts; ties by the other columns."""
    return counts.orderBy(F.desc(n), *(c for c in counts.columns if c != n)).limit(k)


def record_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("n")).select(F.lit("WARC records").alias("key"), "n")


def uris(records: DataFrame, column: str = "target_uri") -> DataFrame:
    """(uri): the different addresses."""
    return records.where(F.col(column).isNotNull()).select(F.col(column).alias("uri")).distinct()


def domain_count(records: DataFrame, column: str = "target_uri") -> DataFrame:
    """(domain, n); broken addresses and IP addresses are left out."""
    found = records.select(domains.registrable(domains.host(F.col(column))).alias("domain")).where("domain is not null")
    return found.groupBy("domain").agg(F.count("*").alias("n"))


def types_and_charsets(records: DataFrame) -> DataFrame:
    """(kind, value, bytes): content lengths of HTTP responses summed by content type and by charset. One pass: each record gives a row for either."""
    # the header is decoded from the start of the content only; the empty line that ends it stands there
    replies = records.where(http.is_response(F.col("content_type"))).select("content_length", http.header(F.col("content")).alias("h"))
    pairs = F.array(F.struct(F.lit("content").alias("kind"), http.page_type(F.col("h")).alias("value")), F.struct(F.lit("charset").alias("kind"), http.page_charset(F.col("h")).alias("value")))
    each = replies.select("content_length", F.explode(pairs).alias("p")).where("p.value is not null")
    return each.groupBy("p.kind", "p.value").agg(F.sum("content_length").cast("bigint").alias("bytes"))


def size_histogram(records: DataFrame, key: str = "content_type", length: str = "content_length") -> DataFrame:
    """(key, bin, n): how many lengths lie in each bin of 100,000."""
    return records.where(F.col(length).isNotNull()).groupBy(F.col(key).alias("key"), text.size_bin(F.col(length)).alias("bin")).agg(F.count("*").alias("n"))


def languages_by_license(corpus: DataFrame, language: str = "language", license: str = "license", column: str = "text") -> DataFrame:
    """(language, license, documents, tokens)."""
    return corpus.groupBy(F.col(language).alias("language"), F.col(license).alias("license")).agg(
        F.count("*").alias("documents"), F.sum(text.word_count(F.col(column))).alias("tokens")
    )


def license_table(counts: DataFrame, licenses: list[str] | None = None) -> DataFrame:
    """The counts with a row a language and two columns a licence, ``docs <license>`` and ``tokens <license>``; 0 where there is none."""
    pivot = counts.groupBy("language").pivot("license", licenses) if licenses else counts.groupBy("language").pivot("license")
    wide = pivot.agg(F.sum("documents").alias("docs"), F.sum("tokens").alias("tokens"))
    renamed = {c: f"{c.rpartition('_')[2]} {c.rpartition('_')[0]}" for c in wide.columns if c != "language"}
    return wide.select("language", *(F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(n) for c, n in sorted(renamed.items(), key=lambda x: x[1])))


def listed_pages(records: DataFrame, urls: DataFrame, column: str = "target_uri") -> DataFrame:
    """Records whose address is listed. The plan broadcasts the list if it is small enough, else both sides are shuffled."""
    return records.join(urls.select(F.col(urls.columns[0]).alias(column)).distinct(), column, "left_semi")


def ranks(counts: DataFrame, n: int) -> DataFrame:
    """(token, rank) of the ``n`` most frequent words, from 0; ties in order of the word. Only those are ordered."""
    best = counts.orderBy(F.desc("n"), "token").limit(n)
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("n"), "token")) - 1)


def student_p(r: float, n: int) -> float:
    """Two-sided p-value of a correlation of n pairs, from Student's t with n - 2 degrees of freedom."""
    if n < 3:
        return float("nan")
    if abs(r) >= 1:
        return 0.0
    df = n - 2
    x = df / (df + r * r * df / (1 - r * r))
    return _beta(x, df / 2, 0.5)


def _beta(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d, total = 1.0, 0.0, 1.0
    for i in range(400):
        m = i // 2
        step = 1.0 if i == 0 else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + step * d or 1e-300)
        c = 1 + step / c or 1e-300
        total *= c * d
        if i and abs(c * d - 1) < 1e-14:
            break
    return front * (total - 1)


def _p_value(rho: Column, n: Column) -> Column:
    """``student_p`` for a few rows: it needs the incomplete beta function, which the JVM functions lack."""

    @F.pandas_udf("double")
    def run(r: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) else student_p(float(x), int(m)) for x, m in zip(r, k)], dtype="float64")

    return run(rho, n)


def vocabulary_correlation(gold: DataFrame, other: DataFrame, n: int, strict: bool = True) -> DataFrame:
    """(words, rho, p): Spearman's correlation of the ranks of the ``n`` most frequent words of ``gold`` with their ranks in
    ``other``, and its two-sided p-value.

    Words that ``other`` lacks share the last rank. Ranks in ``other`` are by its counts over the whole vocabulary; equal ranks
    are averaged. A vocabulary of fewer than ``n`` words is an error, or gives nulls where not ``strict``.
    """
    best = ranks(gold, n)
    # the rank of a word in the other vocabulary orders just as its count does, so counts are ranked among these words only
    both = best.join(other.select("token", F.col("n").alias("m")), "token", "left")
    by = W.orderBy(F.desc(F.coalesce("m", F.lit(-1))), F.when(F.col("m").isNotNull(), F.col("token")))  # n rows
    x = both.withColumn("x", F.col("rank") + 1.0).withColumn("low", F.rank().over(by))
    y = x.withColumn("y", F.col("low") + (F.count("*").over(W.partitionBy("low")) - 1) / 2.0)
    out = y.agg(F.count("*").alias("words"), F.corr("x", "y").alias("rho"))
    few = F.col("words") < n
    short = F.raise_error(F.format_string("the gold vocabulary has only %d words", F.col("words"))).cast("double") if strict else F.lit(None).cast("double")
    out = out.select("words", F.when(few, short).otherwise(F.col("rho")).alias("rho"))
    return out.withColumn("p", _p_value(F.col("rho"), F.col("words")))


def vocabulary_correlations(vocabularies: dict[str, DataFrame], sizes: tuple[int, ...] = (100, 1000, 10_000)) -> DataFrame:
    """(gold, other, top, words, rho, p) for all ordered pairs of vocabularies and all sizes; a handful of corpora, so a
    handful of plans. Where a vocabulary is too small for a size, rho and p are null."""
    out = None
    for gold, a in vocabularies.items():
        for other, b in vocabularies.items():
            if gold != other:
                for n in sizes:
                    one = vocabulary_correlation(a, b, n, strict=False).select(F.lit(gold).alias("gold"), F.lit(other).alias("other"), F.lit(n).alias("top"), "words", "rho", "p")
                    out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("two vocabularies are needed")
    return out
