"""The jobs' inputs, derived by Spark from the given tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftmine.operators.features import tokenize_docs
from siftmine.session import run_folder
from siftmine.sources.readers import read_table


def survey(spark: SparkSession, folder: str) -> DataFrame:
    """respondent, country, salary, salary_type as text with the flaws of real answers."""
    customer = read_table(spark, folder, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.floor(F.abs("c_acctbal")).cast("long").alias("x"),
    )
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    key, x = F.col("c_custkey"), F.col("x")
    thousands = F.floor(x / 1000).cast("long").cast("string")
    salary = (
        F.when(key % 17 == 0, "NA")
        .when(key % 19 == 0, "0")
        .when(key % 23 == 0, None)
        .when(key % 29 == 0, "abc")
        .when(key % 31 == 0, F.concat(x.cast("string"), F.lit("000000")))
        .when(
            x >= 1000, F.concat_ws(",", thousands, F.lpad((x % 1000).cast("string"), 3, "0"))
        )
        .otherwise(x.cast("string"))
    )
    country = F.when(
        key % 5 == 0,
        F.concat_ws(",", F.substring("n_name", 1, 2), F.substring("n_name", 3, 1000)),
    ).otherwise(F.col("n_name"))
    salary_type = F.when(key % 4 == 0, "Monthly").when(key % 4 == 1, "Weekly").when(
        key % 4 == 2, "Yearly"
    )
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("respondent"),
        country.alias("country"),
        salary.alias("salary"),
        salary_type.alias("salary_type"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """user, item, rating from 1 to 5: one row per customer and part."""
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("item"),
        (F.lit(1.0) + F.col("l_quantity").cast("int") % 5).alias("rating"),
    )
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user")
    )
    return (
        lines.join(orders, "o_orderkey")
        .groupBy("user", "item")
        .agg(F.avg("rating").alias("rating"))
    )


def train_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = ratings(spark, folder)
    is_test = (F.col("user") * 7 + F.col("item") * 3) % 10 == 0
    return rows.filter(~is_test), rows.filter(is_test)


def event_baskets(spark: SparkSession, folder: str) -> DataFrame:
    """(basket, item): the event types of each user and day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return read_table(spark, folder, "events").select(
        F.concat_ws("|", F.col("user_id").cast("string"), day).alias("basket"),
        F.col("event_type").alias("item"),
    )


def order_baskets(spark: SparkSession, folder: str) -> DataFrame:
    """(basket, item): the part groups of each order."""
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("basket"),
        F.concat(F.lit("p"), (F.col("l_partkey") % 50).cast("string")).alias("item"),
    )


def share_of_baskets(rows: DataFrame, share: float) -> int:
    """The support that stands for ``share`` of the baskets, rounded up."""
    return math.ceil(rows.agg(F.count_distinct("basket")).first()[0] * share)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, lang, tokens."""
    docs = read_table(spark, folder, "documents").select("doc_id", "lang", "text")
    return tokenize_docs(docs, "text").drop("text")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """vec_id, label, features."""
    return read_table(spark, folder, "embeddings").select(
        "vec_id", "label", F.col("embedding").alias("features")
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """event_id, text: the turns of the conversations in lower case."""
    return as_texts(read_table(spark, folder, "conversations"))


def as_texts(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.concat_ws(
            "-", F.col("conv_id").cast("string"), F.col("turn").cast("string")
        ).alias("event_id"),
        F.lower("text").alias("text"),
    )


def as_event_tags(events: DataFrame) -> DataFrame:
    """event_id, tag: one tag per event."""
    return events.select(
        "event_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type")).alias("tag"),
    )


def event_tags(spark: SparkSession, folder: str) -> DataFrame:
    return as_event_tags(read_table(spark, folder, "events"))


#: Rows of one file of a stream's input, and the files that a batch has at least.
FILE_ROWS = 1_000_000
BATCH_FILES = 2


def in_slices(df: DataFrame, by: str, slices: int, path: str, file_rows: int = FILE_ROWS) -> int:
    """Write ``df`` as files in the order of the number ``by``; returns how many files a slice has.

    The table is read once and dealt to a folder per slice; the slices are then
    published one after the other, as streams take files by their time. Every
    slice is written by as many tasks as it has files. Null and negative numbers
    come first.
    """
    spark = df.sparkSession
    staged = run_folder(spark, "stream-slices")
    df.withColumn("_slice", slice_of(df, by, slices)).write.partitionBy("_slice").parquet(staged)
    rows = spark.read.schema(T.StructType([*df.schema, T.StructField("_slice", T.IntegerType())])).parquet(staged)
    # One row per slice.
    largest = rows.groupBy("_slice").count().agg(F.max("count")).first()[0] or 0
    files = max(BATCH_FILES, -(-largest // file_rows))
    for number in range(slices):
        part = rows.filter(F.col("_slice") == number).drop("_slice")
        part.repartition(files).write.mode("append").parquet(path)
    return files


def slice_of(df: DataFrame, by: str, slices: int) -> Column:
    """Number of the slice of a row, from 0; null and negative numbers belong to the first."""
    last = df.agg(F.max(by)).first()[0]
    if last is None or last < 0:
        return F.lit(0)
    part = F.floor(F.col(by) * slices / (last + 1)).cast("int")
    return F.greatest(F.lit(0), F.coalesce(part, F.lit(0)))
