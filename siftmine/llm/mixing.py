"""Mixing sources to target weights by Poisson replication.

Every source has a mean repetition rate: the share of the output it is meant
to have over the share it has. A document's number of copies is a Poisson
variable with that mean, found by inversion from a uniform number hashed from
its id, so it depends on nothing but the id, the seed and the rate. Documents
are exploded by their count, and the copies ordered by another hash.

Defined cases: a null source is a source of its own; a null id is hashed as
empty; size is the UTF-8 bytes of the text plus one, so null and empty texts
weigh one; rows that repeat an id get the same number of copies each; an empty
table gives no rows; a weight of 0 (or a source that is not in given weights)
gives no copies; further columns are passed on.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import hash_unit, join_figures, numbered, settle, uncommon

SEED = 17
TEMPERATURE = 0.5
#: Rates of so many sources are sent to every task; more are joined.
BROADCAST_SOURCES = 10_000


def document_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def poisson_steps(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, … until what is beyond is smaller than the hash can tell."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(
        (-rate).alias("log_p"), F.exp(-rate).alias("at_most"), F.array(F.exp(-rate)).alias("steps")
    )

    def step(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.log(rate) - F.log(k.cast("double"))
        at_most = state["at_most"] + F.exp(log_p)
        return F.struct(
            log_p.alias("log_p"),
            at_most.alias("at_most"),
            F.concat(state["steps"], F.array(at_most)).alias("steps"),
        )

    reduced = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["steps"])
    return F.when(rate > 0, reduced).otherwise(F.array(F.lit(1.0)))


def source_rates(
    sizes: DataFrame,
    weights: Mapping[str, float] | DataFrame | None = None,
    temperature: float = TEMPERATURE,
    epochs: float = 1.0,
) -> DataFrame:
    """(source, n_docs, rate, steps) from (source, size, n_docs).

    ``weights`` maps sources to target weights, or is a table (source, weight);
    without it a source weighs its size to the power ``temperature``. The
    output is meant to be ``epochs`` times as large as the input.
    """
    spark = sizes.sparkSession
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        if not isinstance(weights, DataFrame):
            weights = spark.createDataFrame(
                [(name, float(weight)) for name, weight in weights.items()], "source string, weight double"
            )
        given = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double").alias("weight"))
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
        weighted = weighted.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    size, weight = weighted.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.lit(0.0)
    if weight:
        rate = F.lit(epochs * size / weight) * F.col("weight") / F.col("size")
    return weighted.withColumn("rate", rate).select(
        "source", "n_docs", "rate", poisson_steps(F.col("rate")).alias("steps")
    )


def with_copies(
    docs: DataFrame,
    weights: Mapping[str, float] | DataFrame | None = None,
    temperature: float = TEMPERATURE,
    epochs: float = 1.0,
    seed: int = SEED,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    rate: str = "rate",
    copies: str = "copies",
) -> DataFrame:
    """``docs`` with the columns ``rate`` and ``copies``, a row for each document that has any copy."""
    group, size, steps = (uncommon(name, docs) for name in ("group", "size", "steps"))
    keyed = docs.withColumn(
        group, F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source)))
    )
    sizes = (
        keyed.groupBy(group)
        .agg(F.sum(document_size(F.col(text))).alias("size"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("source", F.when(F.col(group) != "-", F.expr(f"substring({group}, 2)")))
    )
    sizes = settle(sizes, "source-sizes")
    found = source_rates(sizes.select("source", "size", "n_docs"), weights, temperature, epochs)
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    rates = settle(
        found.select(key.alias(group), F.col("n_docs").alias(size), F.col("rate").alias(rate), F.col("steps").alias(steps)),
        "source-rates",
    )
    if rates.count() <= BROADCAST_SOURCES:
        rated = keyed.join(F.broadcast(rates), group)
    else:
        rated = join_figures(keyed, rates, group, size)
    chance = hash_unit(F.col(id_col).cast("string"), seed=seed)
    return (
        rated.withColumn(size, chance)
        .withColumn(copies, F.size(F.filter(steps, lambda step: step < F.col(size))))
        .drop(group, size, steps)
        .filter(F.col(copies) > 0)
    )


def copy_key(id_col: str, copy: str, seed: int) -> Column:
    """Random order of the copies."""
    return F.md5(
        F.concat_ws(
            "|",
            F.lit(str(seed + 1)),
            F.coalesce(F.col(id_col).cast("string"), F.lit("")),
            F.col(copy).cast("string"),
        ).cast("binary")
    )


def mix(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", **options) -> DataFrame:
    """The copies of ``docs``, same columns, in a random order over all partitions."""
    copy, key, rate, copies = (uncommon(name, docs) for name in ("copy", "key", "rate", "copies"))
    counted = with_copies(docs, seed=seed, id_col=id_col, rate=rate, copies=copies, **options)
    exploded = counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    shuffled = exploded.withColumn(key, copy_key(id_col, copy, seed))
    # The key is random, so its hash deals the copies out evenly.
    return shuffled.repartition(F.col(key)).sortWithinPartitions(key).select(*docs.columns)


def mix_order(
    docs: DataFrame,
    seed: int = SEED,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    **options,
) -> DataFrame:
    """(doc_id, source, rate, copies, copy, position): the whole mixture by its places from 0."""
    plain = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")
    )
    counted = with_copies(plain, seed=seed, **options).drop("text")
    exploded = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    chosen = settle(exploded.withColumn("_key", copy_key("doc_id", "copy", seed)), "mixed-copies")
    return numbered(chosen, ["_key", "doc_id", "copy"], "position", "mixed-order").drop("_key")
