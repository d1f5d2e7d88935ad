"""Consecutive numbers for the rows of a sorted table, without a single sorting task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.session import shared_folder

# monotonically_increasing_id() keeps the position within the partition in its lower 33 bits.
_POSITION_BITS = 33


def ordered_index(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Number the rows 0, 1, 2, … in the order of ``order_by``, which must be unique.

    Rows are range-partitioned and sorted, and the result is checkpointed so
    that partition borders stay fixed if a task has to run again. Only one
    count per partition reaches the driver.
    """
    spark = df.sparkSession
    shared_folder(spark)
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).checkpoint()

    sizes = {
        row["part"]: row["n"]
        for row in ranged.groupBy(F.spark_partition_id().alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    parts = sorted(sizes)
    starts = [0, *accumulate(sizes[part] for part in parts)][: len(parts)]
    offsets = spark.createDataFrame(list(zip(parts, starts)), "_part int, _start long")

    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        ranged.withColumn("_part", F.spark_partition_id())
        .withColumn("_position", position)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col("_position"))
        .drop("_part", "_position", "_start")
    )


def dense_ids(df: DataFrame, column: str) -> DataFrame:
    """(value, id): ids 0, 1, 2, … for the distinct values in ascending order."""
    values = df.select(F.col(column).alias("value")).filter("value is not null").distinct()
    return ordered_index(values, ["value"], "id").select("value", "id")
