"""Shards of nearly equal bytes: minimax contiguous partition of ordered groups of equal texts.

Groups lie in the order of their smallest doc_id. The smallest capacity that lets a greedy fill do with the given number
of shards is found by search, then the order is cut as that fill does. All steps are DataFrame operations.

Defined results: a missing text has size 1 (no bytes) and no checksum, and all such rows form one group; missing ids come
last; repeated rows get slots of their own; no rows, no result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import running, stored, table

SHARDS = 8
#: Capacities tried at once in each round of the search.
TRIES = 32


def fill_ends(groups: DataFrame, starts: list[int], capacities: list[int], largest: int) -> list[int]:
    """For each start and capacity, the last group end that a shard begun there reaches.

    ``groups``: stored, ranged by ``upto`` (the running size), so that only the files around the ends are read: a group end
    lies within one largest group below any point.
    """
    aims = [s + c for s, c in zip(starts, capacities)]
    near = groups.filter((F.col("upto") > min(aims) - largest) & (F.col("upto") <= max(aims)))
    found = near.agg(*[F.max(F.when(F.col("upto") <= a, F.col("upto"))) for a in aims]).first()
    return [s if f is None else max(s, f) for s, f in zip(starts, found)]


def cuts(groups: DataFrame, shards: int = SHARDS, tries: int = TRIES) -> list[int]:
    """Running sizes at which shards end, for the smallest capacity at which ``shards`` greedy fills take all.

    A binary search that tries several capacities at once: the interval shrinks by ``tries`` per round, a round is
    ``shards`` small aggregates, and only ``tries`` numbers come to the driver.
    """
    total, largest = groups.agg(F.max("upto"), F.max("group_size")).first()
    if not total:
        return []

    def ends(capacities: list[int]) -> list[list[int]]:
        at = [[0] for _ in capacities]
        for _ in range(shards):
            open_ = [i for i, a in enumerate(at) if a[-1] < total]
            if not open_:
                break
            reached = fill_ends(groups, [at[i][-1] for i in open_], [capacities[i] for i in open_], largest)
            for i, r in zip(open_, reached):
                at[i].append(r)
        return [a[1:] for a in at]

    low = max(largest, -(-total // shards))  # no capacity below can do
    high = low + largest  # always does: each shard but the last takes at least total / shards
    best = None
    while low < high:
        step = max(1, (high - low) // tries)
        tried = [*range(low, high, step)]
        done = ends(tried)
        fits = [i for i, e in enumerate(done) if e and e[-1] == total]
        if fits:
            high, best = tried[fits[0]], done[fits[0]]
            low = tried[fits[0] - 1] + 1 if fits[0] else high
        else:
            low = tried[-1] + 1
    return best if best is not None else ends([high])[0]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row."""
    raw = F.col("text").cast("binary")
    base = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.coalesce(F.unhex(F.sha2(raw, 256)), F.lit(b"")).alias("_text"))
    base = stored(base, "shard-rows")
    groups = base.groupBy("_text").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("group_size"), F.count("*").alias("rows"))
    groups = stored(running(groups, ["first_id", "_text"], {"upto": "group_size"}, "shard-order"), "shard-groups")
    ends = cuts(groups, shards)
    number = sum((F.when(F.col("upto") > e, 1).otherwise(0) for e in ends[:-1]), F.lit(0))
    placed = groups.select("_text", "first_id", number.alias("shard"), "rows")
    first, starts = 0, []
    counts = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.sum("rows")).collect()}  # one row per shard
    for i in range(shards):
        starts.append(first)
        first += counts.get(i, 0)
    rows = base.hint("merge").join(placed.drop("rows"), "_text").withColumn("_one", F.lit(1))
    rows = running(rows, ["first_id", "_text", "doc_id"], {"_nth": "_one"}, "shard-slots")
    start = F.array(*[F.lit(s).cast("long") for s in starts])[F.col("shard")]
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_nth") - 1 - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
