"""Tables that several steps use, and joins whose output a single key could make too large.

Plain equi-joins are left to adaptive execution, which splits a partition that
one key makes large. What it cannot see is a join that multiplies its rows;
there every key is split by its own count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmine.session import run_folder


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For tables that several later steps use: they are computed once, survive
    the loss of executors, and their true size decides how they are joined.
    """
    spark = df.sparkSession
    path = run_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_splits(
    df: DataFrame, counts: DataFrame, key: str, rows_per_split: int, name: str = "_splits"
) -> DataFrame:
    """Add the number of splits of the row's ``key``, from ``counts`` (key, n); 1 where it has none."""
    splits = F.ceil(F.col("n") / rows_per_split).cast("int")
    known = counts.select(key, F.greatest(F.lit(1), splits).alias(name))
    return df.join(known, key, "left").withColumn(name, F.coalesce(name, F.lit(1)))


def spread(columns: list[str], splits: Column) -> Column:
    """Split number of a row, taken from columns that vary within its key."""
    return F.pmod(F.xxhash64(*columns), splits).cast("int")


def replicate(splits: Column) -> Column:
    """One row per split."""
    return F.explode(F.sequence(F.lit(0), splits - 1))
