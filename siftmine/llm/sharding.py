"""Uniform shuffle into shards of exact sizes.

How many rows each input partition sends to each shard is drawn beforehand:
the counts of a uniform permutation are multivariate hypergeometric, and given
them, a uniform order inside every partition and inside every shard makes the
whole permutation uniform. So the exchange moves each row once, every shard
gets exactly its size, and no task needs to know another one's rows.

The counts (partitions x shards) are drawn on the driver from one row count
per partition; rows are handled by DataFrame operations only.

Defined cases: nulls in any column are kept as values, a repeated row is a row
of its own, an empty table gives no rows; columns ``shard`` and ``slot`` of the
input are replaced, all others are passed on.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import numbered, place_in_partition, settle, uncommon


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good`` + ``bad`` are good: inversion outwards from the mode."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    at_mode = math.exp(
        log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws)
    )
    left = rng.random() - at_mode
    down, up, p_down, p_up = mode, mode, at_mode, at_mode
    while left > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def communication_matrix(sent: list[int], received: list[int], seed: int) -> list[list[int]]:
    """Counts from each partition to each shard, with these row and column sums."""
    rng = random.Random(seed)
    room, matrix = list(received), []
    for rows in sent:
        total, line = sum(room), []
        for shard, free in enumerate(room):
            taken = hypergeometric(rng, free, total - free, rows)
            line.append(taken)
            room[shard] -= taken
            rows, total = rows - taken, total - free
        matrix.append(line)
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that differ by one at most."""
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def uniform_shards(
    df: DataFrame, shards: int, seed: int = 0, sizes: list[int] | None = None
) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot`` (from 0 within the shard).

    ``sizes`` gives each shard's rows; without it they differ by one at most.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    part, place, key, ends = (uncommon(name, df) for name in ("part", "place", "key", "ends"))
    # Local permutation: a random order within each input partition, written with each row's place.
    placed = settle(
        df.withColumn(key, F.rand(seed))
        .sortWithinPartitions(key)
        .withColumn(part, F.spark_partition_id())
        .withColumn(place, place_in_partition()),
        "placed-rows",
    )
    counts = {row[0]: row[1] for row in placed.groupBy(part).agg(F.count(F.lit(1))).collect()}
    total = sum(counts.values())
    sizes = shard_sizes(total, shards) if sizes is None else sizes
    if len(sizes) != shards or sum(sizes) != total:
        raise ValueError("the sizes must be one per shard and add up to the rows")
    parts = sorted(counts)
    lines = communication_matrix([counts[p] for p in parts], sizes, seed)

    spark = df.sparkSession
    # One row per partition, bounded by partitions x shards numbers.
    drawn = spark.createDataFrame(
        [(p, [sum(line[: s + 1]) for s in range(shards)]) for p, line in zip(parts, lines)],
        f"`{part}` int, `{ends}` array<long>",
    )
    passed = F.filter(ends, lambda end: end <= F.col(place))
    sent = settle(
        placed.join(F.broadcast(drawn), part)
        .withColumn("shard", F.size(passed))
        .withColumn(key, F.rand(seed + 1))
        .drop(ends, part, place),
        "sent-rows",
    )
    # Exchange and permute again: the order within a shard is that of a new random key.
    index = uncommon("index", sent)
    starts = F.array(*[F.lit(sum(sizes[:s])).cast("long") for s in range(shards)])
    return (
        numbered(sent, ["shard", key], index, "shard-slots")
        .withColumn("slot", F.col(index) - F.element_at(starts, F.col("shard") + 1))
        .drop(index, key)
    )
