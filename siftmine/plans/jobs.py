"""The whole jobs, from an input table to the result that is written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.operators.clustering import (
    bisecting_kmeans,
    cluster_report,
    cluster_summary,
    cluster_terms,
    kmeans,
    kmeans_assign,
    kmeans_lloyd,
)
from siftmine.operators.factors import ITERS, RANK, REG, als_fit, als_predict
from siftmine.operators.features import hashed_tf, tfidf, vocabulary, vocabulary_tf
from siftmine.operators.itemsets import frequent_itemsets, itemset_report, son_itemsets
from siftmine.operators.recommend import (
    item_cf_predict,
    rating_error_histogram,
    rating_rmse,
)
from siftmine.operators.skew import settle
from siftmine.operators.stats import (
    annualise,
    group_count_with_total,
    group_stats,
    partition_profile,
    sentinel_filter,
)

# Fixed value: number of hash buckets of the MLlib clustering job.
MLLIB_BUCKETS = 82
CLUSTER_SEED = 11


def salaried_by_country(
    survey: DataFrame, country: str = "country", salary: str = "salary"
) -> DataFrame:
    """Respondents with a salary per country, the total first."""
    return group_count_with_total(sentinel_filter(survey, salary, nulls="keep"), country)


def partition_comparison(
    survey: DataFrame, key: str = "country", n: int = 2, layout: str = "hash"
) -> DataFrame:
    """(layout, partition, rows) as read and after repartitioning by ``key``."""
    as_read = partition_profile(survey).withColumn("layout", F.lit("standard"))
    by_key = partition_profile(survey, key, n, layout).withColumn("layout", F.lit("partition"))
    return as_read.unionByName(by_key).select("layout", "partition", "rows")


def salary_statistics(
    survey: DataFrame,
    country: str = "country",
    salary: str = "salary",
    period: str = "salary_type",
    int_mode: str = "none",
) -> DataFrame:
    """Count, minimum, maximum and mean of the yearly salary per country."""
    answered = sentinel_filter(survey.select(country, salary, period), salary, nulls="drop")
    return group_stats(annualise(answered, salary, period), country, salary, int_mode)


@dataclass
class RatingResult:
    predictions: DataFrame
    histogram: DataFrame
    rmse: DataFrame


def factor_ratings(
    train: DataFrame, test: DataFrame, rank: int = RANK, iters: int = ITERS, reg: float = REG, seed: int = 0
) -> RatingResult:
    """Predictions of the factor model for ``test`` (user, item, rating), and their errors."""
    predicted = als_predict(als_fit(train, rank, iters, reg, seed), test)
    return RatingResult(
        predicted.select("user", "item", "prediction").orderBy("user", "item"),
        rating_error_histogram(predicted),
        rating_rmse(predicted),
    )


def neighbour_ratings(
    train: DataFrame, test: DataFrame, k: int = 10, denominator: str = "abs"
) -> RatingResult:
    """Predictions from similar items for ``test`` (user, item, rating), and their errors."""
    predicted = item_cf_predict(train, test, k, denominator).withColumnRenamed(
        "pred_rating", "prediction"
    )
    return RatingResult(
        predicted.select("user", "item", "prediction").orderBy("user", "item"),
        rating_error_histogram(predicted, count_nan=False),
        rating_rmse(predicted),
    )


def frequent_itemset_lines(rows: DataFrame, support: int, method: str = "growth") -> DataFrame:
    """The report of all itemsets with at least ``support`` baskets."""
    if method not in ("growth", "son"):
        raise ValueError("method must be 'growth' or 'son'")
    find = frequent_itemsets if method == "growth" else son_itemsets
    return itemset_report(find(rows, support))


def _report(assigned: DataFrame, name: str) -> DataFrame:
    """The report of (cluster, sqdist, tokens), which are computed once."""
    assigned = settle(assigned.select("cluster", "sqdist", "tokens"), "assigned")
    return cluster_report(cluster_summary(assigned), cluster_terms(assigned), name)


def lloyd_report(
    docs: DataFrame,
    k: int = 5,
    iters: int = 20,
    weighting: str = "tf",
    num_features: int = 2**20,
    seed: int = CLUSTER_SEED,
    id_col: str = "doc_id",
    terms: int | None = None,
) -> DataFrame:
    """Cluster ``docs`` (id, tokens) by explicit K-Means steps on term counts or TF-IDF.

    Terms are hashed, or with ``terms`` are those of that many most frequent ones.
    """
    if weighting not in ("tf", "tfidf"):
        raise ValueError("weighting must be 'tf' or 'tfidf'")
    if terms:
        docs = settle(docs, "tokens")
        known = settle(vocabulary(docs, terms), "vocabulary")
        features = settle(vocabulary_tf(docs, known, terms, weighting, id_col), "features")
    else:
        # Dealt out by id, as each row is read many times.
        features = settle(hashed_tf(docs.repartition(id_col), num_features), "features")
        if weighting == "tfidf":
            features = settle(tfidf(features), "features")
    centres, _ = kmeans_lloyd(features, k, iters, seed, id_col, weighting)
    return _report(kmeans_assign(features, centres, weighting), "K-Means")


def mllib_report(
    docs: DataFrame,
    k: int = 8,
    iters: int = 20,
    algorithm: str = "kmeans",
    num_features: int = MLLIB_BUCKETS,
    seed: int = 42,
    id_col: str = "doc_id",
) -> DataFrame:
    """Cluster ``docs`` (id, tokens) on TF-IDF with an MLlib estimator."""
    if algorithm not in ("kmeans", "bisecting"):
        raise ValueError("algorithm must be 'kmeans' or 'bisecting'")
    # Dealt out by id, as each row is read many times.
    counts = settle(hashed_tf(docs.repartition(id_col), num_features), "features")
    features = settle(tfidf(counts), "features")
    fit, name = {
        "kmeans": (kmeans, "K-Means"),
        "bisecting": (bisecting_kmeans, "Bisecting K-Means"),
    }[algorithm]
    return _report(fit(features, k, iters, seed, "tfidf"), name)
