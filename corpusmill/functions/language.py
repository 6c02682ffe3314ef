"""Language identification with character 1- to 3-grams, trained with Spark from labelled texts."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
_JUNK = re.compile(r"https?://\S+|[\w.+-]+@[\w.-]+|<[^>]*>")
_WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=200_000)
def word_grams(word: str) -> tuple[str, ...]:
    """The 1- to 3-grams of a word, blanks standing for its ends."""
    padded = f" {word} "
    return tuple(padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1) if padded[i : i + n] != " ")


def words_of(text: str) -> Counter:
    return Counter(_WORD.findall(_JUNK.sub(" ", text.lower()) if "@" in text or "<" in text or "://" in text else text.lower()))


def grams(text: str) -> Counter:
    """Counts of the n-grams of the words of a text."""
    out: Counter = Counter()
    for word, n in words_of(text).items():
        for g in word_grams(word):
            out[g] += n
    return out


def train(samples: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, ngram, n, count): the profile of each language. Counting is distributed; rows without label or text are left out."""

    def count(frames):
        for frame in frames:
            sums: dict[tuple[str, str], int] = {}
            for label, t in zip(frame["lang"], frame["text"]):
                for g, n in grams(t).items():
                    sums[label, g] = sums.get((label, g), 0) + n
            yield pd.DataFrame([(a, g, len(g), n) for (a, g), n in sums.items()], columns=["lang", "ngram", "n", "count"])

    rows = samples.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.lower(F.trim(F.col(lang))).alias("lang"), F.col(text).alias("text"))
    return rows.mapInPandas(count, "lang string, ngram string, n int, count bigint").groupBy("lang", "ngram", "n").agg(F.sum("count").alias("count"))


class Identifier:
    """Naive Bayes over the n-grams of a text."""

    def __init__(self, profiles: dict[str, dict[str, int]], threshold: float = 0.80, weight: float = 0.5):
        self.langs = sorted(profiles)
        self.threshold, self.weight = threshold, weight
        vocabulary = {g for p in profiles.values() for g in p}
        self.table: dict[str, np.ndarray] = {}
        totals = {(k, n): sum(c for g, c in p.items() if len(g) == n) + len(vocabulary) * weight for k, p in profiles.items() for n in (1, 2, 3)}
        for g in vocabulary:
            self.table[g] = np.array([math.log((profiles[k].get(g, 0) + weight) / totals[k, len(g)]) for k in self.langs])
        self.known: dict[str, np.ndarray | None] = {}

    def word_scores(self, word: str) -> np.ndarray | None:
        """The log likelihoods of a word, kept for the next text; None if no language has any of its n-grams."""
        if word not in self.known:
            if len(self.known) >= 200_000:
                self.known.clear()
            rows = [self.table[g] for g in word_grams(word) if g in self.table]
            self.known[word] = sum(rows) if rows else None
        return self.known[word]

    @classmethod
    def of(cls, profiles: DataFrame, most: int = 300, **options) -> Identifier:
        """From a profile table, which goes to the driver; more than ``most`` languages with 200,000 n-grams each are refused."""
        top = profiles.where(F.col("count") > 0).limit(most * 200_000 + 1).collect()
        if len(top) > most * 200_000:
            raise ValueError("the profiles have too many n-grams; train on fewer samples")
        out: dict[str, dict[str, int]] = {}
        for r in top:
            out.setdefault(r["lang"], {})[r["ngram"]] = r["count"]
        return cls(out, **options)

    def probabilities(self, text: str | None) -> dict[str, float]:
        scores, seen = np.zeros(len(self.langs)), False
        for word, n in words_of(text or "").items():
            row = self.word_scores(word)
            if row is not None:
                scores += n * row
                seen = True
        if not seen or not self.langs:
            return {}
        odds = np.exp(np.maximum(scores - scores.max(), -700.0))
        return dict(zip(self.langs, (odds / odds.sum()).tolist()))

    def identify(self, text: str | None) -> str:
        """The likeliest language, or ``unknown`` for no text and where none has more than the threshold."""
        p = self.probabilities(text)
        if not p:
            return UNKNOWN
        best = max(p, key=lambda k: (p[k], k))
        return best if p[best] > self.threshold else UNKNOWN

    def column(self, text: Column) -> Column:
        identify = self.identify

        @F.pandas_udf("string")
        def run(texts: pd.Series) -> pd.Series:
            return texts.map(identify)

        return run(text)
