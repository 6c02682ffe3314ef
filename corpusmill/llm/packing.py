"""Problem 8: filling containers of fixed capacity, with the sources mixed to target proportions.

Deficit round robin: for each container every source is credited its target share of the capacity; the source with
the largest deficit gives the next item of its queue, or if that does not fit its largest one that does. When little
room is left, the item that fits best is taken from whatever source. Queues are in pseudo-random order, so that windows
are alike from the first to the last. Deficits are carried from container to container and, by the tokens of the parts
before and up to a container of each source, from part to part of the data, so parts are packed in parallel. Parts are
pseudo-random, so the shares of each are about those of all data.

Only items larger than the capacity are split, when it is their turn: into full containers, which count as windows of
their source, and a rest that is packed like an item.

Defined results: items of size 0 (null and empty texts) join the last container of their part; rows without an id are left out; a
capacity that is null or below 1 is an error; of repeated ids one row counts.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.plans.shared import materialize

SCHEMA = "container_id int, capacity int, bin long, doc_id long, piece int, first_token long, tokens long"


class Shelf:
    """Items by size: the largest one that fits is found by the bits of a number, whatever the count of items."""

    def __init__(self):
        self.by_size: dict[int, deque[int]] = {}
        self.mask = 0

    def put(self, at: int, size: int) -> None:
        self.by_size.setdefault(size, deque()).append(at)
        self.mask |= 1 << size

    def best(self, left: int, gone: bytearray) -> int | None:
        """The item of the largest size up to ``left``; those gone meanwhile are dropped."""
        while fits := self.mask & ((1 << (left + 1)) - 1):
            size = fits.bit_length() - 1
            row = self.by_size[size]
            while row and gone[row[0]]:
                row.popleft()
            if row:
                return row[0]
            self.mask ^= 1 << size
        return None


def pack(items: Iterable[tuple[int, str, int]], capacity: int, target: dict[str, float], deficit: dict[str, float] | None = None, room: float | None = None) -> list[tuple[int, int, int, int, int]]:
    """(bin, item, piece, first token, tokens) for (item, source, tokens) in the order of the queues; bins count from 0.

    ``room``: below this share of the capacity left, the best fit of any source is taken; without one, below what
    1.7 items need, so that the last item or two fill a container and all before it mix it.
    """
    out: list[tuple[int, int, int, int, int]] = []
    rows = list(items)
    nothing = [item for item, _, size in rows if size == 0]
    rows = [(item, source, size) for item, source, size in rows if size > 0]
    if room is None:
        rests = [size if size <= capacity else size % capacity for _, _, size in rows]
        room = min(0.9, max(0.1, 1.7 * sum(rests) / (capacity * len(rests)))) if rests else 0.1
    #: what is left of each item: size, first token, number of the piece
    size_of = [size for _, _, size in rows]
    first_of, piece_of = [0] * len(rows), [0] * len(rows)
    gone = bytearray(len(rows))
    queues: dict[str, deque[int]] = {}
    shelves: dict[str, Shelf] = {}
    every = Shelf()
    for at, (_, source, size) in enumerate(rows):
        queues.setdefault(source, deque()).append(at)
        shelf = shelves.setdefault(source, Shelf())
        if size <= capacity:
            shelf.put(at, size)
            every.put(at, size)
    owed = {s: (deficit or {}).get(s, 0.0) for s in {*queues, *target}}
    goal = {s: target.get(s, 0.0) * capacity for s in owed}
    remaining, bins = len(rows), 0

    def place(at: int, n: int) -> None:
        out.append((bins, rows[at][0], piece_of[at], first_of[at], n))
        owed[rows[at][1]] -= n

    while remaining:
        for s in owed:
            owed[s] += goal[s]
        left = capacity
        while remaining:
            taken = None
            if left > room * capacity:
                for s in sorted(queues, key=lambda s: (-owed[s], s)):
                    q = queues[s]
                    while q and gone[q[0]]:
                        q.popleft()
                    if not q:
                        del queues[s]
                        continue
                    if size_of[q[0]] <= left:
                        taken = q[0]
                    elif left == capacity:
                        # an item larger than a container fills this one; its rest stays first in the queue
                        at = q[0]
                        place(at, capacity)
                        size_of[at] -= capacity
                        first_of[at] += capacity
                        piece_of[at] += 1
                        if size_of[at] <= capacity:
                            shelves[s].put(at, size_of[at])
                            every.put(at, size_of[at])
                        left = 0
                    else:
                        taken = shelves[s].best(left, gone)
                    if taken is not None or not left:
                        break
            else:
                taken = every.best(left, gone)
            if taken is None:
                break
            place(taken, size_of[taken])
            gone[taken] = 1
            left -= size_of[taken]
            remaining -= 1
        bins += 1
    for item in nothing:
        out.append((max(0, bins - 1), item, 0, 0, 0))
    return out


def running(df: DataFrame, keys: list[str], value: str, name: str, block: int = 1024) -> DataFrame:
    """Adds the sum of ``value`` over all smaller ``part`` of the same keys, in two levels: within blocks of parts, and over
    the blocks' sums, so no task holds more than a block's rows or a row a block."""
    df = df.withColumn("_block", F.floor(F.col("part") / block))
    sums = df.groupBy(*keys, "_block").agg(F.sum(value).alias("_n"))
    blocks = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_start", F.coalesce(F.sum("_n").over(blocks), F.lit(0))).drop("_n")
    within = W.partitionBy(*keys, "_block").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    out = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0))).join(sums, [*keys, "_block"])
    return out.withColumn(name, F.col("_start") + F.col("_within")).drop("_start", "_within", "_block")


def packing(tokens: DataFrame, containers: DataFrame, part_tokens: int = 8_000_000) -> DataFrame:
    """One row a piece; see SCHEMA. ``part_tokens``: about how much of the data is packed by one task at a time.

    ``containers`` is a short table of capacities; beyond 1,000 rows it is refused.
    """
    sizes = containers.select("container_id", "capacity_tokens").distinct().limit(1001).collect()
    if len(sizes) > 1000 or any(r["capacity_tokens"] is None or r["capacity_tokens"] < 1 for r in sizes):
        raise ValueError("containers must be at most 1,000 rows with capacities of at least 1")
    wanted = [(int(r["container_id"]), int(r["capacity_tokens"])) for r in sizes]
    if not wanted:
        return tokens.sparkSession.createDataFrame([], SCHEMA)
    items = materialize(tokens.where("doc_id is not null"), "tokens")
    total = items.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-int(total) // part_tokens))
    items = items.dropDuplicates(["doc_id"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    # credits: target tokens of each source in all parts before, less what it had there
    each = materialize(items.groupBy("part", "source").agg(F.sum("tokens").alias("n")), "part-sums")
    share = each.groupBy("source").agg((F.sum("n") / F.lit(max(1, int(total)))).alias("share"))
    by_part = running(each.groupBy("part").agg(F.sum("n").alias("all")), [], "all", "all_before") if parts > 1 else each.groupBy("part").agg(F.lit(0).alias("all_before"))
    credit = running(each, ["source"], "n", "own_before").join(by_part, "part").join(share, "source")
    credit = credit.select("part", F.struct("source", "share", (F.col("share") * F.col("all_before") - F.col("own_before")).alias("owed")).alias("c"))
    credits = credit.groupBy("part").agg(F.collect_list("c").alias("credits"))  # as many as the part has sources
    # a part's credits travel as one more row of it
    none = F.lit(None).cast(credits.schema["credits"].dataType)
    rows = items.select("part", "doc_id", "source", "tokens", none.alias("credits")).unionByName(
        credits.select("part", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("bigint").alias("tokens"), "credits")
    )
    rows = rows.withColumn("size", F.explode(F.array(*(F.struct(F.lit(i).alias("container_id"), F.lit(c).alias("capacity")) for i, c in wanted))))
    # as many partitions as there are parts to pack, up to what a job should have: the rows are small, the work is not, so
    # they are not to be coalesced by size; beyond that a task packs several parts
    slots = min(parts * len(wanted), max(4096, int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = rows.select("size.container_id", "size.capacity", "part", "doc_id", "source", "tokens", "credits").repartition(slots, "container_id", "part")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        container, capacity, part = int(pdf["container_id"].iloc[0]), int(pdf["capacity"].iloc[0]), int(pdf["part"].iloc[0])
        given = next(c for c in pdf["credits"] if c is not None)
        pdf = pdf[pdf["doc_id"].notna()]
        # Fibonacci hashing: an order that has nothing to do with the ids, the same in every run
        docs = sorted(((int(d) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, int(d), s, int(n)) for d, s, n in zip(pdf["doc_id"], pdf["source"], pdf["tokens"])))
        # every item is to be placed, so a part can keep to no other shares than its own from its first window to its last;
        # what the parts before left open, which would be more than a part holds in the end, decides who is first in it
        own: dict[str, int] = {}
        for _, _, s, n in docs:
            own[s] = own.get(s, 0) + n
        whole = max(1, sum(own.values()))
        owed = {c["source"]: min(float(capacity), max(-float(capacity), c["owed"])) for c in given}
        placed = pack([x[1:] for x in docs], capacity, {s: n / whole for s, n in own.items()}, owed)
        base = part << 32
        return pd.DataFrame(
            [(container, capacity, base + b, d, p, f, n) for b, d, p, f, n in placed], columns=["container_id", "capacity", "bin", "doc_id", "piece", "first_token", "tokens"]
        )

    return rows.groupBy("container_id", "capacity", "part").applyInPandas(run, SCHEMA)


def fill_report(packed: DataFrame) -> DataFrame:
    """By capacity: containers, tokens, and the share of room left unused."""
    out = packed.groupBy("container_id", "capacity").agg(F.countDistinct("bin").alias("bins"), F.sum("tokens").alias("tokens"))
    return out.withColumn("unused", F.lit(1.0) - F.col("tokens") / (F.col("bins") * F.col("capacity")))


def mixture_report(packed: DataFrame, tokens: DataFrame) -> DataFrame:
    """By capacity and quarter of each part's containers: the total variation distance between the sources' shares there
    and their shares of all tokens."""
    packed = packed.join(tokens.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "source"), "doc_id").withColumn("part", F.shiftright("bin", 32))
    last = packed.groupBy("container_id", "part").agg((F.max("bin") - F.shiftleft(F.col("part"), 32) + 1).alias("bins"))
    quarter = F.least(F.lit(3), F.floor((F.col("bin") - F.shiftleft(F.col("part"), 32)) * 4 / F.col("bins"))).cast("int")
    sums = packed.join(last, ["container_id", "part"]).groupBy("container_id", "capacity", quarter.alias("quarter"), "source").agg(F.sum("tokens").alias("n"))
    here, all_ = W.partitionBy("container_id", "quarter"), W.partitionBy("container_id")  # a row a source and quarter
    shares = sums.withColumn("share", F.col("n") / F.sum("n").over(here)).withColumn("whole", F.sum("n").over(W.partitionBy("container_id", "source")) / F.sum("n").over(all_))
    # sources that a quarter has nothing of count with all of their share
    out = shares.groupBy("container_id", "capacity", "quarter").agg((F.sum(F.abs(F.col("share") - F.col("whole"))) / 2 + (F.lit(1.0) - F.sum("whole")) / 2).alias("distance"))
    return out
