"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siftmine.operators.skew import settle

__all__ = ["HOT_SHARE", "hash_unit", "join_figures", "numbered", "place_in_partition", "settle", "small_batches", "uncommon"]

#: A key with more than one in so many rows is hot; so no more than this many keys are.
HOT_SHARE = 1_000

# monotonically_increasing_id() keeps the position within the partition in its lower 33 bits.
_POSITION = (1 << 33) - 1


#: Bytes of an Arrow batch, so that long texts come in few rows at a time.
BATCH_BYTES = "8MB"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let the session cut Arrow batches by their bytes, unless it has a setting of its own."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def uncommon(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores in front until no frame has such a column (in any case)."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hash_unit(*parts: Column | str, seed: int = 0) -> Column:
    """A number in (0, 1) from 52 bits of the md5 of ``seed`` and ``parts``; null parts count as empty."""
    text = F.concat_ws(
        "|", F.lit(str(seed)), *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]
    )
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / float(1 << 52)


def place_in_partition() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))


def join_figures(rows: DataFrame, figures: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the figures of their ``key``; rows without one drop out.

    ``figures`` has one row per key; its column ``size`` holds the key's number
    of rows in ``rows``. Keys with more than 1 / ``HOT_SHARE`` of all rows are
    at most ``HOT_SHARE``, so theirs are broadcast and their rows stay where
    they are; all others meet in a plain join. Both inputs are read twice and
    should be settled.
    """
    cut = figures.agg((F.coalesce(F.sum(size), F.lit(0)) / HOT_SHARE).alias("cut")).first()[0]
    hot = F.broadcast(figures.filter(F.col(size) > cut))
    spread = rows.join(hot, key)
    rest = rows.join(hot.select(key), key, "left_anti")
    return spread.unionByName(rest.join(figures.filter(F.col(size) <= cut), key))


def numbered(df: DataFrame, order_by: list[str], name: str, purpose: str) -> DataFrame:
    """Number the rows 0, 1, 2, … in the order of ``order_by``, without one sorting task.

    Rows are range-partitioned, sorted and written with their place, so that a
    lost task cannot move them; the partitions' starts are a running sum over
    one row per partition. The input is read twice (for the ranges) and should
    be settled. Ties are numbered in any order.
    """
    part, place = uncommon("part", df), uncommon("place", df)
    ranged = settle(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(part, F.spark_partition_id())
        .withColumn(place, place_in_partition()),
        purpose,
    )
    start = uncommon("start", ranged)
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    # One row per partition.
    return (
        ranged.join(F.broadcast(starts), part)
        .withColumn(name, F.col(start) + F.col(place))
        .drop(part, place, start)
    )
