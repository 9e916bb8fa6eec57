"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``vnodes`` points of a 64-bit ring. A key goes to the shard of
the first point at or after its hash; if that shard is full, it continues
clockwise to the next shard that isn't. Keys between two neighbouring points
share their way round the ring, so the walk is decided for whole segments: the
driver holds one count a segment (``shards * vnodes`` of them, whatever the
input) and settles which ranks of a segment go to which shard; rows then look
up their own rank.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import prefix_sums, written

SHARDS, VNODES, SEED = 8, 64, 17
SHARDED = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def points(shards: int, vnodes: int, seed: int) -> list[tuple[int, int]]:
    """(position, shard) in ring order; a shard's points don't depend on the number of shards."""
    def position(shard: int, v: int) -> int:
        digest = hashlib.blake2b(f"{seed}/{shard}/{v}".encode(), digest_size=8).digest()
        return int.from_bytes(digest, "little", signed=True)

    return sorted((position(s, v), s) for s in range(shards) for v in range(vnodes))


def clockwise(ring: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """For each point, the shards in the order a key that starts there meets them."""
    order: list[list[int]] = []
    for i in range(len(ring)):
        met: dict[int, None] = {}
        for k in range(len(ring)):
            met.setdefault(ring[(i + k) % len(ring)][1])
            if len(met) == shards:
                break
        order.append(list(met))
    return order


def capacities(total: int, shards: int, epsilon: float) -> list[int]:
    """(1 + epsilon) times the mean, rounded up; for epsilon 0 they add up to the total exactly."""
    if epsilon == 0:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [int(-(-total * (1 + epsilon) // shards))] * shards


def settle(counts: dict[int, int], ring: list[tuple[int, int]], shards: int,
           epsilon: float) -> list[tuple[int, int, int, int, int]]:
    """(segment, first rank, end rank, shard, slot of the first): all keys placed, no shard over its load.

    Step k offers what is left of each segment, in ring order, to the k-th shard on its way."""
    left = capacities(sum(counts.values()), shards, epsilon)
    placed = {g: 0 for g in counts}
    used = [0] * shards
    ways = clockwise(ring, shards)
    plan = []
    for k in range(shards):
        for g in sorted(counts):
            shard = ways[g][k]
            n = min(counts[g] - placed[g], left[shard])
            if n:
                plan.append((g, placed[g], placed[g] + n, shard, used[shard]))
                placed[g] += n
                used[shard] += n
                left[shard] -= n
    return plan


def shard_documents(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, epsilon: float = 0.0,
                    seed: int = SEED) -> DataFrame:
    """Puts every row of ``docs`` (doc_id, text; other columns are ignored) into one of ``shards`` shards.

    The load is a row; with ``epsilon`` 0 counts differ by one at most (law ``rows``), a larger one
    trades balance for fewer moved keys. Returns doc_id, size (UTF-8 bytes of the text plus 1; null
    text: 1), text_crc32, law, shard, slot (gapless from 0 in each shard) and grown_shard (null: that
    is for the ``key`` law). Null ids share one place on the ring and overflow from there. Rows equal
    in all columns are interchangeable. An empty table gives an empty result.

    The text is reduced to its size and CRC in the scan and never shuffled. Ranks in a segment come
    from two-level prefix sums, so a segment that holds a third of all rows is split."""
    spark = docs.sparkSession
    ring = points(shards, vnodes, seed)
    positions = np.array([p for p, _ in ring], np.int64)

    @F.pandas_udf("int")
    def segment_of(position: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(positions, position.to_numpy()) % len(positions)).astype("int32")

    text = F.coalesce("text", F.lit(""))
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        (F.octet_length(text).cast("long") + 1).alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"),
                        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text).alias("order"))
    light = written(light.withColumn("segment", segment_of(F.xxhash64("doc_id"))).withColumn("one", F.lit(1)),
                    "ring-rows")
    counts = {r.segment: r.n for r in light.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(settle(counts, ring, shards, epsilon),
                                 "segment int, first long, beyond long, shard int, base long")
    parts = F.collect_list(F.struct("first", "beyond", "shard", "base")).alias("parts")
    ranked = prefix_sums(light, ["segment"], "order", ["one"], plan.groupBy("segment").agg(parts))
    rank = F.col("before_one")
    part = F.filter("parts", lambda p: (p["first"] <= rank) & (rank < p["beyond"]))[0]
    return ranked.withColumn("part", part).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("part.shard").alias("shard"),
        (F.col("part.base") + rank - F.col("part.first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
