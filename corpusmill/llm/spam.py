"""Problem 2: keyword-stuffed and link-list pages.

Method: the rank-frequency curve of each page's words is fitted with SQL windows (log frequency on log rank). Slope and
residual of the fit, the heads of the curves of words and of word pairs, and the share of different words are compared
with what prose of the same language and comparable length shows, in robust deviations (median and quartiles); so are
the share of the language's common words and of closed lines. A page is spam if

* its curve, of ``least`` words or more, is none of prose: ``curve``, the root mean square of the curve's deviations, is
  ``bent`` or more, towards fewer different words; or
* it diverges from prose in what it is made of: far fewer common words (``wordless``) and unclosed lines (``open``),

unless its form says what it is instead: tables, directories, code and other lists bend the curve too, as do error
messages and filler. Nothing is spam without such a deviation, whatever its form.

Defined results: pages without words are no spam; languages and lengths with little prose use the prose of all, and so
do pages in no language, however many there are: their prose is filler, spoiled text or a language without common words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What is compared with prose, and the least deviation that each is measured in. The first five are the curve's.
FIGURES = {"slope": 0.01, "residual": 0.01, "top_word": 0.01, "top_pair": 0.01, "ttr": 0.01, "common": 0.01, "closed": 0.1}
CURVE = ["slope", "residual", "top_word", "top_pair", "ttr"]


def curves(profiles: DataFrame) -> DataFrame:
    """Adds slope, residual and ttr: the fit of ln frequency on ln rank, each step of the curve weighing its words.

    The curve comes as steps (frequency, number of words that have it), so a page is a dozen rows, not its words;
    the window and the sums use one partitioning by record.
    """
    step = profiles.select("record_id", F.explode("curve").alias("s")).select("record_id", "s.f", "s.m")
    w = W.partitionBy("record_id").orderBy(F.desc("f")).rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = step.withColumn("upto", F.sum("m").over(w))
    at = upto.select("record_id", F.col("m").cast("double").alias("w"), F.log(F.col("upto") - (F.col("m") - 1) / 2.0).alias("x"), F.log("f").alias("y"))
    sums = at.groupBy("record_id").agg(
        *(F.sum(e).alias(k) for k, e in {"sw": F.col("w"), "sx": F.expr("w*x"), "sy": F.expr("w*y"), "sxx": F.expr("w*x*x"), "sxy": F.expr("w*x*y"), "syy": F.expr("w*y*y")}.items())
    )
    spread = F.expr("sw*sxx - sx*sx")
    slope = F.when(spread > 1e-9, F.expr("sw*sxy - sx*sy") / spread).otherwise(0.0)
    fit = sums.withColumn("slope", slope).withColumn("intercept", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("sw"))
    left = F.expr("syy - slope*sxy - intercept*sy") / F.col("sw")
    fit = fit.select("record_id", "slope", F.sqrt(F.greatest(left, F.lit(0.0))).alias("residual"))
    n = F.greatest(F.col("n_words"), F.lit(1))
    return profiles.join(fit, "record_id", "left").withColumn("ttr", F.col("n_types") / n).fillna(0.0, ["slope", "residual"])


def _quartiles() -> list[Column]:
    return [F.percentile_approx(k, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q_{k}") for k in FIGURES] + [F.count("*").alias("pages")]


def _sized(fitted: DataFrame) -> DataFrame:
    return fitted.withColumn("size", F.floor(F.log2(F.greatest(F.col("n_words"), F.lit(1)))).cast("int")).withColumn("lang", F.coalesce("lang", F.lit("?")))


def against_prose(fitted: DataFrame, least: int = 20, of: DataFrame | None = None) -> DataFrame:
    """Adds z_<figure>, how far each figure is from prose of the language and length in robust deviations, with its sign.

    The reference has a row per language (those of common_words) and power of two of the length: at most some hundred
    rows however large the corpus, hence the broadcast. It is fitted on the pages ``of``, or else on those judged.
    Without any prose to compare with all deviations are 0.
    """
    rows = _sized(fitted)
    prose = (rows if of is None else _sized(of)).where((F.col("prose") >= 0.8 * F.col("chars")) & (F.col("closed") >= 0.5) & (F.col("n_words") >= 8))
    near = prose.where(F.col("lang") != "?").groupBy("lang", "size").agg(*_quartiles()).where(F.col("pages") >= least)
    every = prose.agg(*_quartiles()).first()  # one row: three numbers a figure
    ref = rows.join(F.broadcast(near), ["lang", "size"], "left")
    z = {}
    for k, floor in FIGURES.items():
        overall = F.array(*(F.lit(float(x)) for x in every[f"q_{k}"])) if every[f"q_{k}"] else F.lit(None).cast("array<double>")
        q = F.coalesce(F.col(f"q_{k}"), overall)
        z[f"z_{k}"] = F.coalesce((F.col(k) - q[1]) / F.greatest((q[2] - q[0]) / 1.349, F.lit(floor)), F.lit(0.0))
    return ref.withColumns(z).drop(*(f"q_{k}" for k in FIGURES), "pages", "size")


def form_explains() -> Column:
    """Whether a page's form says why its words are not spread like prose: mostly lists, tables or junk, or messages and filler."""
    return (F.col("list") + F.col("table") + F.col("junk") > 0.5 * F.col("chars")) | (F.col("filler") + F.col("said") > 0.5 * F.col("chars"))


def spam(profiles: DataFrame, bent: float = 4.75, wordless: float = 4.0, open: float = 3.5, least: int = 40, of: DataFrame | None = None) -> DataFrame:
    """The profiles with the curve's figures, their deviations, ``curve`` and ``is_spam``; profiles hold one row a record.
    The prose compared with is that of the profiles ``of``, where they are others than those judged. Profiles that have
    gone through ``curves`` already are taken as they are."""
    fitted = [x if "slope" in x.columns else curves(x) for x in (profiles, of) if x is not None]
    scored = against_prose(fitted[0], of=fitted[1] if len(fitted) > 1 else None)
    squares = sum((F.pow(F.least(F.abs(F.col(f"z_{k}")), F.lit(15.0)), 2) for k in CURVE), F.lit(0.0))
    scored = scored.withColumn("curve", F.sqrt(squares / len(CURVE)))
    unlike = (F.col("n_words") >= least) & (F.col("curve") >= bent) & (F.col("z_ttr") < 0) | (F.col("z_common") <= -wordless) & (F.col("z_closed") <= -open)
    return scored.withColumn("is_spam", (F.col("n_words") > 0) & unlike & ~form_explains())
