"""Uniform fixed-size samples and figures about the texts in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmine.functions.text import tag_array

SAMPLE_SIZE = 100


def priority(id_col: str, seed: int) -> Column:
    """Random but repeatable rank of a row, from its id."""
    return F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed))))


def reservoir_sample(
    df: DataFrame, id_col: str, n: int = SAMPLE_SIZE, seed: int = 0
) -> DataFrame:
    """A uniform sample of ``n`` rows without replacement.

    Keeps the ``n`` smallest priorities, so samples of parts of the data merge
    into the sample of the whole, in any order and any number of steps.
    """
    return (
        df.withColumn("_priority", priority(id_col, seed))
        .orderBy("_priority", id_col)
        .limit(n)
        .drop("_priority")
    )


def extract_tags(
    df: DataFrame, text: str, order_cols: list[str], prefix: str = "#"
) -> DataFrame:
    """(order columns, pos, tag): the tags of every text in order."""
    return df.select(*order_cols, F.posexplode(tag_array(F.col(text), prefix)).alias("pos", "tag"))


def tag_counts(df: DataFrame, text: str, prefix: str = "#") -> DataFrame:
    """(tag, n): how often each tag occurs."""
    return (
        df.select(F.explode(tag_array(F.col(text), prefix)).alias("tag"))
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def reservoir_stats(
    sample: DataFrame,
    text: str,
    texts_seen: Column,
    n_tags: int = 5,
    prefix: str = "#",
) -> DataFrame:
    """(rank, tag, n, texts_seen, mean_length): most frequent tags of the sample, ties by tag.

    ``mean_length`` is the mean text length of the sample with 2 decimals. A
    sample without tags gives no row.
    """
    mean_length = sample.agg(F.round(F.avg(F.length(text)), 2)).scalar()
    best = tag_counts(sample, text, prefix).orderBy(F.desc("n"), "tag").limit(n_tags)
    # The few best tags are ranked as one array.
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus_n"), "tag")))
    ranked = best.agg(order.alias("_best")).select(F.posexplode("_best").alias("_pos", "_tag"))
    return ranked.select(
        (F.col("_pos") + 1).alias("rank"),
        F.col("_tag.tag").alias("tag"),
        (-F.col("_tag.minus_n")).alias("n"),
        texts_seen.alias("texts_seen"),
        F.format_string("%.2f", mean_length).alias("mean_length"),
    )
