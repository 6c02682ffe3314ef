"""Problem 9: mixing sources to target weights.

Two ways of setting the weights, both by bisecting an exponent:

* ``temperature``: the natural shares of the sources in the tokens, raised to an exponent and normalised. At 1 the mix is
  what the data holds, at 0 every source weighs the same. The exponent is the one at which the mix has a wanted entropy.
  For a given total it is raised as far as needed for no source to be used more often than it may; without one the
  total is the largest at which none is.
* ``solve``: the mix between supply and target shares, w(a) proportional to target^a * supply^(1-a), where a source's
  supply is its share of all tokens that may be used, each record as often as its source allows. At a = 1 the mix has
  the target shares; at a = 0 it is always possible. For a given total the exponent is bisected: the largest a at
  which no source needs more than its supply. Without a given total the largest one is taken at which a = 1 is possible,
  so that the shares are the targets, as problem 9 states.

A source's budget is realised by block permutations: whole passes over its records, then one more pass in
pseudo-random order up to the budget. Records are hashed into blocks, blocks are ordered and summed, and only
the block in which the budget ends is cut between records: no task holds a source.

Defined results: sources without a target, with a null share or without tokens give nothing; the shares of the others are
scaled to 1; records without tokens are never used; null max_repeats means once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.llm.tokens import source_name
from corpusmill.plans.shared import materialize


def weights(target: dict[str, float], supply: dict[str, float], a: float) -> dict[str, float]:
    """The normalised mix at exponent a."""
    whole = sum(supply.values())
    raw = {s: target[s] ** a * (supply[s] / whole) ** (1 - a) for s in target}
    total = sum(raw.values())
    return {s: v / total for s, v in raw.items()}


def solve(target: dict[str, float], supply: dict[str, float], total: float | None = None, rounds: int = 60) -> tuple[dict[str, float], float, float]:
    """(tokens by source, exponent, entropy of the mix in nats) for the sources that have both a target and tokens."""
    target = {s: t for s, t in target.items() if t is not None and t > 0 and supply.get(s, 0) > 0}
    if not target:
        return {}, 1.0, 0.0
    scale = sum(target.values())
    target = {s: t / scale for s, t in target.items()}
    supply = {s: float(supply[s]) for s in target}
    if total is None:
        total = min(supply[s] / target[s] for s in target)
    total = min(total, sum(supply.values()))

    def fits(a: float) -> bool:
        return all(total * w <= supply[s] * (1 + 1e-9) for s, w in weights(target, supply, a).items())

    low, high = 0.0, 1.0
    if fits(1.0):
        low = 1.0
    else:
        for _ in range(rounds):
            mid = (low + high) / 2
            low, high = (mid, high) if fits(mid) else (low, mid)
    w = weights(target, supply, low)
    return {s: total * x for s, x in w.items()}, low, -sum(x * math.log(x) for x in w.values() if x > 0)


def entropy_of(shares: dict[str, float]) -> float:
    """In nats."""
    return -sum(x * math.log(x) for x in shares.values() if x > 0)


def temperature(tokens: dict[str, float], repeats: dict[str, int], total: float | None = None, entropy: float | None = None, rounds: int = 60) -> tuple[dict[str, float], float, float]:
    """(tokens by source, exponent, entropy) of the natural shares raised to an exponent between 0 and 1.

    The exponent is bisected to the wanted entropy; without one to the middle between that of the natural shares and
    that of equal ones. With a ``total`` it is then bisected upwards as far as it takes for no source to be used more than
    ``repeats`` times; without, the total is the largest at which none is. An entropy below the natural one gives the
    natural shares, one above that of equal shares gives those.
    """
    have = {s: float(n) for s, n in tokens.items() if n > 0}
    if not have:
        return {}, 1.0, 0.0
    whole = sum(have.values())
    supply = {s: n * repeats.get(s, 1) for s, n in have.items()}
    if entropy is None:
        entropy = (entropy_of({s: n / whole for s, n in have.items()}) + math.log(len(have))) / 2

    def mix(a: float) -> dict[str, float]:
        raw = {s: (n / whole) ** a for s, n in have.items()}
        norm = sum(raw.values())
        return {s: x / norm for s, x in raw.items()}

    def bisect(good) -> float:
        """The smallest exponent that is good, where those above a good one are."""
        low, high = 0.0, 1.0
        if good(0.0):
            return 0.0
        for _ in range(rounds):
            mid = (low + high) / 2
            low, high = (low, mid) if good(mid) else (mid, high)
        return high

    a = bisect(lambda x: entropy_of(mix(x)) <= entropy)
    if total is None:
        total = min(supply[s] / w for s, w in mix(a).items())
    else:
        total = min(total, sum(supply.values()))
        a = max(a, bisect(lambda x: all(total * w <= supply[s] * (1 + 1e-9) for s, w in mix(x).items())))
    w = mix(a)
    # beyond one pass over all that there is even the natural shares may ask a source for more than it may give
    budget = {s: min(total * x, supply[s]) for s, x in w.items()}
    return budget, a, entropy_of(w)


def mix(tokens: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 17, block_tokens: int = 500_000, tempered: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, report): records has a row a use (doc_id, source, use, tokens), the report a row a source of ``targets``.

    ``tempered``: the weights are the natural shares of the targets' sources, tempered, and not the target shares
    themselves. ``targets`` is a short table: beyond 100,000 sources it is refused, as the weights are solved on the driver.
    """
    rows = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("mix_targets must have at most 100,000 sources")
    spark = tokens.sparkSession
    goal = spark.createDataFrame([(r["source"], r["target_share"], max(1, r["max_repeats"] or 1)) for r in rows], "source string, target_share double, max_repeats int").where("source <> ''")
    goal = goal.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    used = materialize(tokens.where("doc_id is not null and tokens > 0").dropDuplicates(["doc_id"]).join(F.broadcast(goal), "source"), "mix-tokens")
    have = {r["source"]: r["n"] for r in used.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}  # sources of targets only
    most = {r["source"]: r["max_repeats"] for r in goal.collect()}
    want = {r["source"]: r["target_share"] for r in goal.collect() if r["target_share"] is not None and not math.isnan(r["target_share"])}
    if tempered:
        budget, exponent, entropy = temperature({s: n for s, n in have.items() if want.get(s, 0.0) > 0}, most, total)
    else:
        budget, exponent, entropy = solve(want, {s: n * most[s] for s, n in have.items()}, total)
    natural = sum(have[s] for s in budget) or 1
    plan = [(s, float(b), int(b // have[s]), float(b - (b // have[s]) * have[s]), max(1, round(have[s] / block_tokens))) for s, b in budget.items()]
    plan = [(s, b, min(k, most[s]), (r if k < most[s] else 0.0), n) for s, b, k, r, n in plan]
    plans = spark.createDataFrame(plan, "source string, budget double, passes int, rest double, blocks int")
    order = F.xxhash64(F.lit(seed), "doc_id")
    records = used.join(F.broadcast(plans), "source").withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.col("blocks")))
    sums = records.groupBy("source", "block").agg(F.sum("tokens").alias("n"))
    before = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # a row a block of half a million tokens
    sums = sums.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    placed = records.join(sums, ["source", "block"])
    within = W.partitionBy("source", "block").orderBy(order, "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = placed.withColumn("end", F.col("start") + F.sum("tokens").over(within))
    # a record belongs to the last pass if more than half of it lies within the budget
    last = F.when(F.col("end") - F.col("tokens") / 2.0 <= F.col("rest"), 1).otherwise(0)
    times = placed.withColumn("times", F.col("passes") + last)
    uses = times.where("times > 0").withColumn("use", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc_id", "source", F.col("use").cast("int"), "tokens")
    got = times.groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("mixed_tokens"), F.max("times").alias("most_uses"), F.count(F.when(F.col("times") > 0, 1)).alias("records"))
    whole = max(1, got.agg(F.sum("mixed_tokens").alias("whole")).first()["whole"] or 0)
    report = (
        goal.join(F.broadcast(got), "source", "left")
        .join(F.broadcast(plans.select("source", "budget", F.lit(float(natural)).alias("natural"))), "source", "left")
        .join(F.broadcast(spark.createDataFrame(sorted(have.items()), "source string, source_tokens long")), "source", "left")
        .select(
            "source", "target_share", "max_repeats", F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce(F.col("mixed_tokens") / F.lit(whole), F.lit(0.0)).alias("actual_share"),
            F.coalesce(F.when(F.col("budget").isNotNull(), F.col("source_tokens") / F.col("natural")), F.lit(0.0)).alias("natural_share"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), F.coalesce("records", F.lit(0)).alias("records"), F.lit(exponent).alias("exponent"), F.lit(entropy).alias("entropy"),
        )
    )
    return uses, report
