"""Sharding by rendezvous hashing of record keys over weighted shards.

A key goes to the shard with the best draw: each shard draws ``-ln(u) / weight`` with u in (0, 1) from a hash of the key
and the shard's number, and the least draw wins. A draw does not depend on the other shards, so one more shard takes
keys only into itself, and a change of one weight moves keys only from or to that shard.

Draws are one expression a row; no row is shuffled to be dealt out. Slots (places in a shard) are numbered without
gathering a shard: rows are sorted by shard within the partitions in which they are read, written with their running
number, and shifted by the rows of that shard in earlier partitions, which are summed from one small row for each
partition and shard.

Rows with a null key all go to the shard of the null key; repeated keys go to one shard. Null texts count as empty.
An empty table gives no rows; columns of ``carry`` may not be named shard or slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpour.llm.store import written

SEED = 20


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard of a key among shards with these weights (0: no row)."""
    if not any(weight > 0 for weight in weights):
        raise ValueError("some weight must be positive")
    draws = []
    for shard, weight in enumerate(weights):
        if weight <= 0:
            continue
        # 52 bits of the hash, moved off zero and one.
        uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED + shard), key), 12) + F.lit(0.5)) / F.lit(2.0**52)
        draws.append(F.struct((-F.ln(uniform) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard")))
    best = draws[0] if len(draws) == 1 else F.least(*draws)
    return best["shard"]


def shard_rows(docs: DataFrame, key: str, weights: Sequence[float], carry: Sequence[Column] = ()) -> DataFrame:
    """The key, the columns of ``carry``, and shard and slot (places in a shard, gapless from 0)."""
    dealt = docs.select(F.col(key), *carry, rendezvous(F.col(key), weights).alias("shard"))
    numbered = written(
        dealt.sortWithinPartitions("shard").select(
            "*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__row")
        ),
        "shard-rows",
    )
    parts = numbered.groupBy("__part", "shard").agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    # One row for each partition and shard; a window holds one row for each partition.
    before = F.sum("__rows").over(Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("__part", "shard", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    placed = numbered.join(written(offsets, "shard-offsets"), ["__part", "shard"])
    return placed.withColumn("slot", F.col("__row") + F.col("__shift")).drop("__part", "__row", "__shift")
