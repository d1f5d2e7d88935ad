"""Cleaning and per-group statistics of survey-like tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmine.functions.values import lenient_double, per_year, saturating_int, strip_commas


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, by ``order_by`` if given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def sentinel_filter(
    df: DataFrame, column: str, sentinels: tuple[str, ...] = ("NA", "0"), nulls: str = "keep"
) -> DataFrame:
    """Drop rows whose ``column`` equals a sentinel as text.

    ``nulls='keep'`` compares as a program does and keeps null; ``'drop'``
    compares as SQL does and drops it.
    """
    if nulls not in ("keep", "drop"):
        raise ValueError("nulls must be 'keep' or 'drop'")
    wanted = ~F.col(column).isin(*sentinels)
    return df.filter(F.col(column).isNull() | wanted if nulls == "keep" else wanted)


def annualise(
    df: DataFrame, amount: str, period: str, factors: dict[str, int] | None = None
) -> DataFrame:
    """Replace the text ``amount`` by its yearly value and drop ``period``.

    Commas in numbers are removed and text that is no number becomes null.
    """
    value = per_year(lenient_double(strip_commas(F.col(amount))), F.col(period), factors)
    return df.withColumn(amount, value).drop(period)


def group_stats(
    df: DataFrame, key: str, value: str, int_mode: str = "none", round_to: int = 2
) -> DataFrame:
    """Count of non-null values, minimum, maximum and mean per group, in one aggregation.

    Commas are removed from the key first, so names that differ by commas only
    fall together. ``int_mode='saturate'`` gives the extremes as 32-bit integers.
    """
    if int_mode not in ("none", "saturate"):
        raise ValueError("int_mode must be 'none' or 'saturate'")
    shape = saturating_int if int_mode == "saturate" else (lambda column: column)
    return (
        df.groupBy(strip_commas(F.col(key)).alias(key))
        .agg(
            F.count(value).alias("n"),
            shape(F.min(value)).alias("min_value"),
            shape(F.max(value)).alias("max_value"),
            F.round(F.avg(value), round_to).alias("avg_value"),
        )
        .orderBy(key)
    )


def group_count_with_total(df: DataFrame, key: str, total_label: str = "Total") -> DataFrame:
    """Rows per group, with the grand total as first row.

    The rollup runs over the counts, not over the rows. Commas are removed
    from the key when the result is shown, after grouping.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.rollup(key)
        .agg(F.sum("n").alias("n"), F.grouping(key).alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, F.lit(total_label))
            .otherwise(strip_commas(F.col(key)))
            .alias(key),
            "n",
            (1 - F.col("is_total")).cast("int").alias("sort_flag"),
        )
        .orderBy("sort_flag", key)
    )


def align_metrics(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of metric tables that each hold one row per key."""
    return reduce(lambda left, right: left.join(right, keys, "full"), frames)


def md5_partition(key: str, n: int) -> Column:
    """The partition of 0 to n - 1 that the md5 of ``key`` names; null goes with the empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def partition_profile(
    df: DataFrame, key: str | None = None, n: int | None = None, layout: str = "hash"
) -> DataFrame:
    """Rows per physical partition, after repartitioning into ``n`` by ``key`` if given.

    ``layout='hash'`` leaves the placing to Spark; ``'md5'`` names each row's
    partition by the key's md5, the same in any engine. Meant to show how a key
    spreads, so a heavy key stays in one partition here.
    """
    if layout not in ("hash", "md5") or (layout == "md5" and (key is None or n is None)):
        raise ValueError("layout must be 'hash', or 'md5' with a key and a number of partitions")
    if layout == "md5":
        df = df.repartitionById(n, md5_partition(key, n))
    elif n is not None:
        df = df.repartition(n, key) if key else df.repartition(n)
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )
