"""Text features: tokens, hashed term counts and inverse document frequencies."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siftmine.functions.text import split_tokens
from siftmine.operators.skew import settle


def tokenize_docs(
    df: DataFrame, text_col: str, sep: str = " ", keep_empty: bool = True
) -> DataFrame:
    """Add ``tokens``; a line break counts as a separator."""
    text = F.replace(F.col(text_col), F.lit("\n"), F.lit(sep))
    return df.withColumn("tokens", split_tokens(text, sep, keep_empty))


def hashed_tf(docs: DataFrame, num_features: int = 2**18) -> DataFrame:
    """Add ``tf``, the sparse vector of hashed term counts of ``tokens``."""
    return HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features).transform(docs)


def tfidf(tf: DataFrame) -> DataFrame:
    """Add ``tfidf``: ``tf`` weighted by the inverse document frequency of each bucket."""
    return IDF(inputCol="tf", outputCol="tfidf").fit(tf).transform(tf)


def bucket_tf(docs: DataFrame, num_features: int = 2**18, id_col: str = "doc_id") -> DataFrame:
    """(id, bucket, n): how often the terms of each bucket are in a document.

    A term's bucket is the first 32 bits of its md5 modulo ``num_features``, so
    any engine finds the same ones. Rows of one id count as one document; a
    document without tokens has no rows.
    """
    terms = docs.select(id_col, F.explode("tokens").alias("_term"))
    bits = F.conv(F.substring(F.md5(F.col("_term").cast("binary")), 1, 8), 16, 10).cast("long")
    bucket = F.pmod(bits, F.lit(num_features)).cast("int")
    return terms.groupBy(id_col, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def bucket_tfidf(docs: DataFrame, num_features: int = 2**18, id_col: str = "doc_id") -> DataFrame:
    """(id, bucket, n, weight): the counts of ``bucket_tf`` times ln((m + 1) / (df + 1)) for m documents."""
    m = docs.select(id_col).distinct().count()
    counts = settle(bucket_tf(docs, num_features, id_col), "bucket-counts")
    # One row per bucket, of which there are at most num_features.
    idf = counts.groupBy("bucket").agg(F.log((m + 1) / (F.count(F.lit(1)) + 1)).alias("_idf"))
    return counts.join(idf, "bucket").select(id_col, "bucket", "n", (F.col("n") * F.col("_idf")).alias("weight"))


def term_idf(docs: DataFrame, min_df: int = 1) -> DataFrame:
    """(term, df, idf) by exact term, with idf = ln((m + 1) / (df + 1)) for m documents."""
    m = docs.agg(F.count(F.lit(1))).scalar()
    return (
        docs.select(F.explode(F.array_distinct("tokens")).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .filter(F.col("df") >= min_df)
        .select("term", "df", F.log((m + 1) / (F.col("df") + 1)).alias("idf"))
    )


def vocabulary(docs: DataFrame, n: int) -> DataFrame:
    """(term, place, idf): the ``n`` terms in most documents, ties by term, numbered from 0."""
    common = term_idf(docs).orderBy(F.desc("df"), "term").limit(n)
    # No more than n rows.
    place = F.row_number().over(W.orderBy(F.desc("df"), "term")) - 1
    return common.select("term", place.alias("place"), "idf")


def vocabulary_tf(
    docs: DataFrame, terms: DataFrame, n: int, weighting: str = "tf", id_col: str = "doc_id"
) -> DataFrame:
    """Add an array with the counts of the ``terms`` (term, place, idf), times the idf for ``tfidf``."""
    weight = F.col("idf") if weighting == "tfidf" else F.lit(1.0)
    counts = (
        docs.select(F.col(id_col).alias("_id"), F.explode("tokens").alias("term"))
        .join(F.broadcast(terms), "term")
        .groupBy("_id", "place")
        .agg((F.count(F.lit(1)) * F.first(weight)).alias("_n"))
        .groupBy("_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "_n"))).alias("_counts"))
    )
    every = F.sequence(F.lit(0), F.lit(n - 1))
    values = F.transform(every, lambda i: F.coalesce(F.try_element_at("_counts", i), F.lit(0.0)))
    joined = docs.join(counts, F.col(id_col) == F.col("_id"), "left")
    return joined.withColumn(weighting, values).drop("_id", "_counts")
