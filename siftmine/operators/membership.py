"""Seen-before tests over ordered tags: exact, and by a Bloom filter of m bits.

A sequential filter reports an occurrence as new if it sets a bit that no
earlier occurrence has set, so the new occurrences are the first positions of
the bits. Only the first occurrence of a tag can set a bit. Both facts turn the
sequential loop into minimum aggregations, which combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmine.functions.text import bit_positions

BITS = 1024


def bloom_hashes(
    df: DataFrame, tag: str = "tag", m: int = BITS, legacy: bool = False
) -> DataFrame:
    """Add ``h1`` and ``h2``, the bits of ``tag``."""
    h1, h2 = bit_positions(F.col(tag), m, legacy)
    return df.withColumn("h1", h1).withColumn("h2", h2)


def _first(df: DataFrame, key: str, order: list[str], *others: Column) -> DataFrame:
    """Smallest position per ``key``, as the struct ``first``."""
    # A single number is aggregated by hashing, a struct only by sorting.
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    found = df.groupBy(key).agg(F.min(position).alias("first"), *others)
    if len(order) == 1:
        found = found.withColumn("first", F.struct(F.col("first").alias(order[0])))
    return found


def first_seen(tags: DataFrame, order: list[str]) -> DataFrame:
    """(tag, first, n): first position and number of occurrences of every tag."""
    return _first(tags, "tag", order, F.count(F.lit(1)).alias("n"))


def first_set(firsts: DataFrame, m: int = BITS, legacy: bool = False) -> DataFrame:
    """(bit, first): first position that sets each bit; at most ``m`` rows."""
    bits = F.array(*bit_positions(F.col("tag"), m, legacy))
    order = firsts.schema["first"].dataType.names
    return _first(firsts.select(F.explode(bits).alias("bit"), "first.*"), "bit", order)


def _flag(tags: DataFrame, order: list[str], news: DataFrame, name: str) -> DataFrame:
    """Flag occurrences whose position is not in ``news`` (first). Positions are unique."""
    marks = news.select(*[F.col(f"first.{c}").alias(c) for c in order], F.lit(False).alias("_new"))
    return (
        tags.join(marks, order, "left")
        .withColumn(name, F.coalesce("_new", F.lit(True)))
        .drop("_new")
    )


def seen_audit(tags: DataFrame, order: list[str]) -> DataFrame:
    """``tags`` with ``seen``: whether the tag occurred at an earlier position."""
    return _flag(tags, order, first_seen(tags, order).select("first"), "seen")


def bloom_flags(
    tags: DataFrame, order: list[str], m: int = BITS, legacy: bool = False
) -> DataFrame:
    """``tags`` with ``bloom_seen``: whether both bits were set at an earlier position."""
    setters = first_set(first_seen(tags, order), m, legacy).select("first").distinct()
    return _flag(tags, order, setters, "bloom_seen")


def audit_figures(
    occurrences: Column, distinct_tags: Column, bloom_new: Column
) -> list[Column]:
    """The report columns of a filter run from its three counts.

    ``correct`` is distinct tags minus false positives; ``fp_rate`` relates the
    false positives to the occurrences that were really new.
    """
    false_positives = distinct_tags - bloom_new
    return [
        occurrences.alias("occurrences"),
        distinct_tags.alias("distinct_tags"),
        (occurrences - bloom_new).alias("bloom_positive"),
        (occurrences - distinct_tags).alias("exact_positive"),
        false_positives.alias("false_positives"),
        (distinct_tags - false_positives).alias("correct"),
        F.round(F.try_divide(false_positives.cast("double"), distinct_tags), 6).alias("fp_rate"),
    ]


def bloom_audit(
    tags: DataFrame, order: list[str], m: int = BITS, legacy: bool = False
) -> DataFrame:
    """One row: how the filter's answers compare with exact ones over all occurrences.

    Every tag gives one row for each of its bits and one, under the null bit,
    that carries its counts, so a single pass over the tags yields all figures.
    """
    h1, h2 = (position.alias("bit") for position in bit_positions(F.col("tag"), m, legacy))
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    entries = F.array(
        F.struct(F.lit(None).cast("int").alias("bit"), F.col("n"), one.alias("tags")),
        *[F.struct(bit, none.alias("n"), none.alias("tags")) for bit in (h1, h2)],
    )
    rows = first_seen(tags, order).select("first.*", F.inline(entries))
    per_bit = _first(rows, "bit", order, F.sum("n").alias("n"), F.sum("tags").alias("tags"))
    totals = per_bit.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("occurrences"),
        F.coalesce(F.sum("tags"), F.lit(0)).alias("distinct_tags"),
        F.count_distinct(F.when(F.col("bit").isNotNull(), F.col("first"))).alias("bloom_new"),
    )
    return totals.select(
        *audit_figures(F.col("occurrences"), F.col("distinct_tags"), F.col("bloom_new"))
    )
