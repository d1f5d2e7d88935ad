"""Readers for the tables the jobs work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftmine.functions.text import split_tokens

RATING_SCHEMA = "user string, item string, rating double"
BASKET_SCHEMA = "basket string, item string"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_survey(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...] = ("Country", "Salary", "SalaryType"),
) -> DataFrame:
    """CSV with header, every column text, cut to ``columns``.

    The columns are found by name, so files may hold any others in any order.
    """
    return spark.read.csv(path, header=True, inferSchema=False).select(*columns)


def read_ratings(spark: SparkSession, path: str, naive: bool = False) -> DataFrame:
    """user, item, rating from comma text with a header line in every file.

    ``naive=True`` splits at every comma without regard to quotes.
    """
    if not naive:
        return spark.read.schema(RATING_SCHEMA).csv(path, header=True)
    field = F.split("value", ",")
    rating = field[2].try_cast("double")
    return (
        spark.read.text(path)
        .select(field[0].alias("user"), field[1].alias("item"), rating.alias("rating"))
        .filter("rating is not null")
    )


def read_baskets(spark: SparkSession, path: str, naive: bool = False) -> DataFrame:
    """basket, item from comma text without a header line."""
    if not naive:
        return spark.read.schema(BASKET_SCHEMA).csv(path)
    field = F.split("value", ",")
    return spark.read.text(path).select(field[0].alias("basket"), field[1].alias("item"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per line, with its tokens."""
    return spark.read.text(path).select(
        F.col("value").alias("text"), split_tokens(F.col("value")).alias("tokens")
    )


def read_itemset_report(spark: SparkSession, path: str) -> DataFrame:
    """size, shown from a written report."""
    entries = spark.read.schema("value string, size int").option("lineSep", "), ").text(path)
    return entries.select("size", F.concat("value", F.lit(")")).alias("shown"))


def stream_texts(
    spark: SparkSession, schema: T.StructType | str, path: str, max_files: int | None = None
) -> DataFrame:
    """Stream of the parquet files under ``path``, at most ``max_files`` per batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
