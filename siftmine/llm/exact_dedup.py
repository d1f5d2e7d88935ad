"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table bucketed and sorted by digest. New rows are
digested, grouped, deduplicated by a sort-merge anti-join with the index, and
what is new is appended. The index side of the join is not shuffled; once
several batches have been added, a bucket has a sorted file of each, and the
join sorts the bucket. A whole table goes through one index in ranges of ids,
so later ranges meet the digests of earlier ones.

A batch has a name. A digest that the same batch brought counts as new, and
only digests that the index lacks are appended, so a batch that failed at any
point can run again with the same result.

Defined cases: null text counts as empty; texts that differ only in runs of
space, tab, line feed, vertical tab, form feed and carriage return are equal;
of equal texts the smallest id stays, a null id only if there is no other; of
rows that repeat an id and text, one stays; an empty table gives no rows;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmine.llm.common import join_figures, settle, uncommon
from siftmine.session import run_folder

#: Rows of the index that one bucket is meant to hold at first.
BUCKET_ROWS = 2_000_000
MIN_BUCKETS = 8
#: Ranges of ids in which a whole table goes through an index of its own.
RANGES = 4
#: Numbers of rows (8 bytes each) that are sent to every task; more are joined.
BROADCAST_ROWS = 1_000_000


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.regexp_replace(spaced, " {2,}", " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


_SETTINGS = "buckets int"


class DigestIndex:
    """Digests seen so far, each with the id that stays and the batch that brought it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        """The index at ``path``, made if there is none; ``buckets`` is as it was made with."""
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    @classmethod
    def create(cls, spark: SparkSession, path: str, buckets: int) -> DigestIndex:
        """A new index, whose settings are written beside it."""
        spark.createDataFrame([(buckets,)], _SETTINGS).coalesce(1).write.parquet(f"{path}-settings")
        return cls(spark, path, buckets)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        """The index that any earlier session made at ``path``."""
        return cls(spark, path, spark.read.schema(_SETTINGS).parquet(f"{path}-settings").first()[0])

    def close(self) -> None:
        """Take the table's name out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE {self.table}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _append(self, groups: DataFrame, batch: str) -> DataFrame:
        """Append the digests of ``groups`` (digest, first, n) that are new; returns all with keep_id and kept_row."""
        known = self.rows().hint("merge")
        new = settle(
            groups.join(known, "digest", "left_anti").select(
                "digest", F.col("first.doc_id").alias("keep_id"), F.lit(batch).alias("batch")
            ),
            "new-digests",
        )
        (
            new.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )
        own = (F.col("batch") == batch) & F.col("keep_id").eqNullSafe(F.col("first.doc_id"))
        figures = groups.join(self.rows().hint("merge"), "digest").select(
            "digest", "keep_id", F.col("n").alias("group_size"), F.when(own, F.col("first.row")).alias("kept_row")
        )
        return settle(figures, "digest-figures")

    def add(self, docs: DataFrame, batch: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """Deduplicate ``docs`` and append the new digests.

        One row per row of ``docs``: its id, keep_id (of the row that stays, in
        this or an earlier batch), group_size (equal rows of this batch), kept
        and text_sha256. ``batch`` is the same if the same rows are added again
        after a failure, and else a name that was never used.
        """
        return self.add_in_ranges(docs, batch, 1, id_col, text)

    def add_in_ranges(
        self, docs: DataFrame, batch: str, ranges: int, id_col: str = "doc_id", text: str = "text"
    ) -> DataFrame:
        """As :meth:`add`, one range of ids after the other; group_size is over all of them."""
        digested = settle(_digests(docs, id_col, text), "digests")
        return _decided(digested, self._decide(digested, batch, ranges))

    def _decide(self, digested: DataFrame, batch: str, ranges: int) -> DataFrame:
        """(digest, keep_id, group_size, kept_row) for the digests of all ranges, which are appended."""
        # Borders between the ranges: as many numbers as there are ranges.
        shares = [number / ranges for number in range(1, ranges)]
        found = digested.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
        borders = sorted(set(found or []))
        number = F.lit(0)
        for place, border in enumerate(borders, 1):
            number = F.when(F.col("doc_id") > border, place).otherwise(number)
        # Without an id comes last, as any other id stays before it.
        number = F.when(F.col("doc_id").isNull(), len(borders)).otherwise(number)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
        groups = settle(
            digested.groupBy("digest", number.alias("range")).agg(first.alias("first"), F.count(F.lit(1)).alias("n")),
            "digest-groups",
        )
        figures = None
        for place in range(len(borders) + 1):
            own = self._append(groups.filter(F.col("range") == place).drop("range"), f"{batch}/{place}")
            figures = own if figures is None else figures.unionByName(own)
        # Of the ranges that hold a digest at most one has the row that stays.
        return settle(
            figures.groupBy("digest").agg(
                F.max("keep_id").alias("keep_id"),
                F.sum("group_size").alias("group_size"),
                F.max("kept_row").alias("kept_row"),
            ),
            "digest-decisions",
        )


def _digests(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        text_digest(F.col(text)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )


def _decided(digested: DataFrame, decisions: DataFrame) -> DataFrame:
    return join_figures(digested, decisions, "digest", "group_size").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def new_index(spark: SparkSession, expected_rows: int) -> DigestIndex:
    """An empty index in the shared folder, with buckets for so many rows."""
    buckets = max(MIN_BUCKETS, -(-expected_rows // BUCKET_ROWS))
    return DigestIndex.create(spark, run_folder(spark, "digest-index"), buckets)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranges: int = RANGES) -> DataFrame:
    """Every row's decision, as of :meth:`DigestIndex.add`, by an index of the table's own."""
    index = new_index(docs.sparkSession, docs.count())
    found = index.add_in_ranges(docs, "table", ranges, id_col, text)
    index.close()
    return found


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranges: int = RANGES) -> DataFrame:
    """``docs`` without the rows whose text an earlier id has, by an index of their own.

    Rows are numbered once, each text is digested once, and only the numbers
    of the rows that leave are brought to the rows.
    """
    spark = docs.sparkSession
    number = uncommon("row_number", docs)
    rows = settle(docs.withColumn(number, F.monotonically_increasing_id()), "numbered-documents")
    digested = settle(
        rows.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text)).alias("digest"), F.col(number).alias("row")),
        "digests",
    )
    index = new_index(spark, digested.count())
    decisions = index._decide(digested, "table", ranges)
    index.close()
    # A text that is there once stays; the others are compared with their group's row.
    several = decisions.filter("group_size > 1").select("digest", "group_size", "kept_row")
    leaving = settle(
        join_figures(digested, settle(several, "copied-digests"), "digest", "group_size")
        .filter(F.col("row") != F.col("kept_row"))
        .select(F.col("row").alias(number)),
        "leaving",
    )
    leaving = F.broadcast(leaving) if leaving.count() <= BROADCAST_ROWS else leaving
    return rows.join(leaving, number, "left_anti").drop(number)
