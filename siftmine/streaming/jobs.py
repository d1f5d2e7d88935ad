"""Running sample and running filter audit over a stream of texts.

The sources give no order across batches other than that of the batches, so a
position is the time of the batch followed by the order columns within it. The
figures of a batch are a folder of their own, written anew if the batch runs again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftmine.functions.text import bit_positions, tag_array
from siftmine.operators.membership import BITS, audit_figures
from siftmine.operators.sampling import SAMPLE_SIZE, reservoir_sample, reservoir_stats
from siftmine.streaming.state import VersionedTable

BATCH_SECONDS = 10


def _start(
    stream: DataFrame,
    state_dir: str,
    on_batch: Callable[[DataFrame, int], None],
    available_now: bool,
) -> StreamingQuery:
    writer = (
        stream.writeStream.outputMode("update")
        .foreachBatch(on_batch)
        .option("checkpointLocation", f"{state_dir}/progress")
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{BATCH_SECONDS} seconds").start()


def _metrics_path(state_dir: str, batch_id: int) -> str:
    return f"{state_dir}/metrics/batch={batch_id}"


def read_metrics(spark: SparkSession, state_dir: str) -> DataFrame:
    """The figures of every batch so far, with its number in ``batch``."""
    return spark.read.parquet(f"{state_dir}/metrics")


def stream_reservoir(
    stream: DataFrame,
    state_dir: str,
    id_col: str = "event_id",
    text: str = "text",
    n: int = SAMPLE_SIZE,
    seed: int = 0,
    n_tags: int = 5,
    prefix: str = "#",
    available_now: bool = True,
) -> StreamingQuery:
    """Keep a uniform sample of all texts so far and report its top tags every batch."""
    kept = stream.select(
        F.col(id_col).cast("string").alias("event_id"), F.col(text).alias("text")
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read once, used for the count and for the sample
        samples, totals = _reservoir_state(spark, state_dir)
        before = totals.before(batch_id).agg(F.coalesce(F.sum("texts"), F.lit(0))).scalar()
        seen = totals.write(
            batch_id, batch.agg((F.count(F.lit(1)) + before).cast("long").alias("texts"))
        )
        part = reservoir_sample(batch, "event_id", n, seed)
        both = samples.before(batch_id).unionByName(part)
        sample = samples.write(batch_id, reservoir_sample(both, "event_id", n, seed))
        texts_seen = seen.select("texts").scalar()
        stats = reservoir_stats(sample, "text", texts_seen, n_tags, prefix)
        stats.coalesce(1).write.mode("overwrite").parquet(_metrics_path(state_dir, batch_id))
        batch.unpersist()

    return _start(kept, state_dir, on_batch, available_now)


def _reservoir_state(
    spark: SparkSession, state_dir: str
) -> tuple[VersionedTable, VersionedTable]:
    return (
        VersionedTable(spark, f"{state_dir}/sample", "event_id string, text string"),
        VersionedTable(spark, f"{state_dir}/totals", "texts long"),
    )


def _bloom_keys(
    stream: DataFrame, order_col: str, tags: Column, m: int, legacy: bool
) -> DataFrame:
    """One row per text, per tag occurrence and per bit of an occurrence, with its position."""
    # In a stream this is the time of the batch, which stays the same if the batch runs again.
    at = F.current_timestamp().alias("at")
    occurrences = stream.select(at, F.col(order_col).alias("event"), tags.alias("tags")).select(
        "at", "event", F.size("tags").alias("n_tags"), F.posexplode_outer("tags")
    )
    h1, h2 = bit_positions(F.col("col"), m, legacy)

    def entry(condition: Column, kind: str, key: Column) -> Column:
        return F.when(
            condition, F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))
        )

    is_tag = F.col("col").isNotNull()
    entries = F.array_compact(
        F.array(
            entry(F.coalesce("pos", F.lit(0)) == 0, "text", F.lit("")),
            entry(is_tag, "tag", F.col("col")),
            entry(is_tag, "bit", h1),
            entry(is_tag, "bit", h2),
        )
    )
    return occurrences.select("at", "event", "pos", "n_tags", F.inline(entries))


def stream_bloom(
    stream: DataFrame,
    state_dir: str,
    order_col: str = "event_id",
    text: str | None = "text",
    tag: str | None = None,
    m: int = BITS,
    legacy: bool = False,
    prefix: str = "#",
    available_now: bool = True,
) -> StreamingQuery:
    """Audit a Bloom filter over the tags of a stream; cumulative figures every batch.

    Tags come from ``text`` by ``prefix``, or one per row from the column ``tag``.
    Spark's state store holds the first position of every tag and bit; a batch
    touches only the keys it contains, and copies of a key are combined before
    the shuffle. What is first seen in a batch is what the batch adds.
    """
    tags = F.array(F.col(tag)) if tag is not None else tag_array(F.col(text), prefix)
    state = (
        _bloom_keys(stream, order_col, tags, m, legacy)
        .groupBy("kind", "key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("n_tags").alias("n_tags"),
            F.min(F.struct("at", "event", "pos")).alias("first"),
            F.max("at").alias("last"),
        )
    )

    def on_batch(touched: DataFrame, batch_id: int) -> None:
        spark = touched.sparkSession
        is_text, is_new = F.col("kind") == "text", F.col("first.at") == F.col("last")
        new_bit = F.when((F.col("kind") == "bit") & is_new, F.col("first"))
        figures = touched.agg(
            F.max("last").alias("at"),
            F.max(F.when(is_text, F.col("n"))).alias("texts"),
            F.max(F.when(is_text, F.col("n_tags"))).alias("occurrences"),
            F.count_if((F.col("kind") == "tag") & is_new).alias("distinct_tags"),
            F.count_distinct(new_bit).alias("bloom_new"),
        )
        if batch_id:
            before = spark.read.parquet(_metrics_path(state_dir, batch_id - 1))
            # Positions compare by batch time, so it has to grow from batch to batch.
            is_later = F.coalesce(F.col("at") > before.select("at").scalar(), F.lit(True))
            checked = F.when(
                is_later, F.col("at")
            ).otherwise(F.raise_error(F.lit("the clock went back between two batches")))
            figures = figures.withColumn("at", checked)
            both = before.select(figures.columns).unionByName(figures)
            figures = both.agg(
                F.max("at").alias("at"),
                F.max("texts").alias("texts"),
                F.max("occurrences").alias("occurrences"),
                F.sum("distinct_tags").alias("distinct_tags"),
                F.sum("bloom_new").alias("bloom_new"),
            )
        report = figures.select(
            "at",
            "bloom_new",
            F.coalesce("texts", F.lit(0)).alias("texts"),
            *audit_figures(
                F.coalesce("occurrences", F.lit(0)), F.col("distinct_tags"), F.col("bloom_new")
            ),
        )
        report.write.mode("overwrite").parquet(_metrics_path(state_dir, batch_id))

    return _start(state, state_dir, on_batch, available_now)


def batch_metrics(spark: SparkSession, state_dir: str, batch_id: int) -> DataFrame:
    """The figures of one batch."""
    return spark.read.parquet(_metrics_path(state_dir, batch_id))


def last_batch(spark: SparkSession, state_dir: str) -> int:
    """Number of the last batch that has figures."""
    return read_metrics(spark, state_dir).agg(F.max("batch")).first()[0]


def current_sample(spark: SparkSession, state_dir: str, batch_id: int) -> DataFrame:
    """The sample as batch ``batch_id`` left it."""
    return _reservoir_state(spark, state_dir)[0].of(batch_id)
