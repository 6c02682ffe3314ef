"""Exact and near duplicates, and the removal of records by id.

Near duplicates are found between *different* fingerprints; copies of one fingerprint are never paired with one
another. A class of records with one fingerprint is its heaviest member (by length, then id) when decisions are made,
so a fingerprint that a third of all records share costs one row, not a third squared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.simhash import bands, hamming

NEAR = 3


def exact_duplicates(docs: DataFrame, length: Column, fingerprint: Column, id: str = "record_id", keep: list[str] | None = None) -> DataFrame:
    """One record of each (length, fingerprint): the one with the smallest id. Records without either form a group of
    their own. Only one record a group leaves each map task."""
    columns = keep or docs.columns
    best = docs.groupBy(length.alias("_length"), fingerprint.alias("_print")).agg(F.min_by(F.struct(*columns), F.col(id)).alias("r"))
    return best.select("r.*")


def fingerprint_classes(docs: DataFrame) -> DataFrame:
    """(simhash, n, top): how many documents have a fingerprint, and the one among them that stays last, the greatest
    by (doc_len, doc_id). ``docs`` is (doc_id, doc_len, simhash)."""
    return docs.groupBy("simhash").agg(F.count("*").alias("n"), F.max(F.struct("doc_len", "doc_id")).alias("top"))


def near_fingerprints(prints: DataFrame, most: int = NEAR) -> DataFrame:
    """(a, b, distance), a < b: pairs of different fingerprints of at most ``most`` different bits, each once.

    ``prints`` has distinct fingerprints in ``simhash``. A pair is compared only in the first band it shares, so no
    distinct is needed. Within a band, fingerprints that differ in one bit of the doubled word are joined on the word with that bit
    out: for each of 32 bits the word without it is a key, so candidates of a key are at most two. ``most`` 0 and
    1 give none, as distances of doubled words are even; 2 and 3 mean one bit of 32.
    """
    if most < 2:
        return prints.select(F.col("simhash").alias("a"), F.col("simhash").alias("b"), F.lit(0).alias("distance")).where(F.lit(False))
    if most < 4:
        word = F.col("simhash").bitwiseAND(F.lit(0xFFFFFFFF))
        bits = prints.select("simhash", F.posexplode(F.array(*(word.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << i))) for i in range(32)))).alias("bit", "rest"))
        pairs = bits.groupBy("bit", "rest").agg(F.min("simhash").alias("a"), F.max("simhash").alias("b"), F.count("*").alias("k"))
        return pairs.where("k = 2").select("a", "b", hamming(F.col("a"), F.col("b")).cast("int").alias("distance"))
    raise ValueError("beyond three bits the bands are not complete; compare other keys")


def band_candidates(prints: DataFrame, most: int = NEAR) -> DataFrame:
    """The same pairs by joining on the three bands; for fingerprints that aren't doubled words. Bands of many
    fingerprints are split by AQE; a pair that shares several bands is kept in the first."""
    one = prints.select("simhash", F.posexplode(bands(F.col("simhash"))).alias("band", "bits"))
    other = one.select(F.col("simhash").alias("b"), "band", "bits")
    pairs = one.withColumnRenamed("simhash", "a").join(other, ["band", "bits"]).where((F.col("a") < F.col("b")) & (hamming(F.col("a"), F.col("b")) <= most))
    a, b = bands(F.col("a")), bands(F.col("b"))
    shared_before = F.when(F.col("band") > 0, a[0] == b[0]).otherwise(False) | F.when(F.col("band") > 1, a[1] == b[1]).otherwise(False)
    return pairs.where(~shared_before).select("a", "b", hamming(F.col("a"), F.col("b")).cast("int").alias("distance"))


def near_pairs(docs: DataFrame, most: int = NEAR) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs of fingerprints near one another, and (doc_id, doc_len, simhash) of every document."""
    return near_fingerprints(docs.select("simhash").distinct(), most), docs.select("doc_id", "doc_len", "simhash")


def link_counts(docs: DataFrame, most: int = NEAR) -> DataFrame:
    """(doc_id, simhash, n_near): for each document, how many others have its fingerprint or one near it. A fingerprint is the id of its class."""
    classes = fingerprint_classes(docs).select("simhash", "n")
    pairs = near_fingerprints(classes.select("simhash"), most)
    both = pairs.select(F.col("a").alias("simhash"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("simhash"), F.col("a").alias("other")))
    near = both.join(classes.select(F.col("simhash").alias("other"), "n"), "other").groupBy("simhash").agg(F.sum("n").alias("near"))
    sums = classes.join(near, "simhash", "left").select("simhash", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_near"))
    return docs.join(sums, "simhash").select("doc_id", "simhash", "n_near")


def ids_to_delete(docs: DataFrame, most: int = NEAR) -> DataFrame:
    """(doc_id): documents that some near duplicate beats by (doc_len, doc_id): of every pair the smaller one goes.

    A document goes exactly if the greatest of its own class or of a class near it is greater than itself, so no pair of documents is formed.
    """
    classes = fingerprint_classes(docs).select("simhash", "top")
    pairs = near_fingerprints(classes.select("simhash"), most)
    both = pairs.select(F.col("a").alias("simhash"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("simhash"), F.col("a").alias("other")))
    near = both.join(classes.select(F.col("simhash").alias("other"), F.col("top").alias("other_top")), "other").groupBy("simhash").agg(F.max("other_top").alias("other_top"))
    best = classes.join(near, "simhash", "left").select("simhash", F.greatest("top", F.coalesce("other_top", "top")).alias("best"))
    return docs.join(best, "simhash").where(F.struct("doc_len", "doc_id") < F.col("best")).select("doc_id").distinct()


def remove_ids(docs: DataFrame, ids: DataFrame, id: str = "record_id", language: str | None = "language") -> DataFrame:
    """Records that are not listed, whose id no other record has, and that have a language.

    Ids with several records are found by a count that is combined before the shuffle, not by gathering them.
    """
    single = docs.groupBy(id).agg(F.count("*").alias("_n")).where("_n = 1").select(id)
    kept = docs.join(single, id, "left_semi").join(ids.select(F.col(ids.columns[0]).alias(id)), id, "left_anti")
    return kept.where(F.col(language).isNotNull()) if language else kept


def greedy_selection(clusters: list[list[tuple[int, str]]]) -> tuple[set[str], set[str]]:
    """(kept, deleted) ids of clusters of (length, id), in the order given: the longest of a cluster is kept unless it
    shares a cluster with one that is kept already, and the others are deleted. A plain function for short lists."""
    left = [set(c) for c in clusters]
    kept: set[str] = set()
    deleted: set[str] = set()
    for i, cluster in enumerate(left):
        if not cluster:
            continue
        best = max(cluster)
        rivals = {d for c in left if best in c for d in c}
        if not any(d[1] in kept for d in rivals if d != best):
            kept.add(best[1])
            left[i] = cluster - {best}
            deleted |= {d[1] for d in left[i]}
        else:
            deleted |= {d[1] for d in cluster}
    return kept, deleted


def connected(prints: DataFrame, pairs: DataFrame) -> DataFrame:
    """(simhash, component): the smallest fingerprint of each component of near fingerprints, by contraction.

    Each fingerprint points at its smallest neighbour, whatever its own value. Such pointers form trees but for one pair a tree
    that point at each other, of which the smaller is the least of the tree and becomes its root. Trees become single
    fingerprints, edges run between roots, until none is left. A tree has two fingerprints at least, so each level has
    at most half of those of the level before: there is no limit to the length of a component, and no round per step of its way.

    Each level is written to the shared folder, so the lineage stays short and survives lost executors.
    """
    from corpusmill.plans.shared import materialize

    edges = materialize(pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).where("x <> y"), "edges")
    levels = []
    while not edges.isEmpty():
        levels.append(_trees(edges))
        x, y = (levels[-1].select(F.col("simhash").alias(c), F.col("root").alias(f"{c}_root")) for c in "xy")
        ends = edges.join(x, "x").join(y, "y").where("x_root <> y_root")
        edges = materialize(ends.select(F.least("x_root", "y_root").alias("x"), F.greatest("x_root", "y_root").alias("y")).distinct(), "edges")
    if not levels:
        return prints.select("simhash", F.col("simhash").alias("component"))
    roots = levels.pop()
    for level in reversed(levels):
        higher = roots.select(F.col("simhash").alias("lower"), F.col("root").alias("higher"))
        roots = level.join(higher, F.col("root") == F.col("lower"), "left").select("simhash", F.coalesce("higher", "root").alias("root"))
    return prints.join(roots, "simhash", "left").select("simhash", F.coalesce("root", "simhash").alias("component"))


def _trees(edges: DataFrame) -> DataFrame:
    """(simhash, root, moved): each end of an edge with the root of its tree of smallest neighbours; ways are halved until all are at it."""
    from corpusmill.plans.shared import materialize

    def of(trees: DataFrame) -> DataFrame:
        return trees.join(trees.select(F.col("simhash").alias("s"), F.col("root").alias("hop")), F.col("root") == F.col("s"))

    both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = materialize(both.groupBy(F.col("x").alias("simhash")).agg(F.min("y").alias("root")), "least")
    # of two that point at each other, the smaller comes to point at itself; for others, either is on the way to the root
    trees = materialize(of(least).select("simhash", F.least("root", "hop").alias("root")), "trees")
    while True:
        trees = materialize(of(trees).select("simhash", F.col("hop").alias("root"), (F.col("hop") != F.col("root")).alias("moved")), "trees")
        if trees.where("moved").isEmpty():
            return trees
