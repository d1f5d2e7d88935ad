"""Every operator as a query over the given tables, with the same result as SQL where possible."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmine.operators import clustering, factors, features, ids, itemsets, membership
from siftmine.operators import recommend, sampling, stats
from siftmine.plans import inputs, jobs, sql
from siftmine.session import run_folder
from siftmine.sources import readers, writers
from siftmine.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _round(df: DataFrame, digits: int, *names: str) -> DataFrame:
    # Adding zero turns a negative zero into zero.
    return df.withColumns({name: F.round(name, digits) + F.lit(0.0) for name in names})


# Survey statistics


@query
def preview(spark, folder):
    return stats.preview(inputs.survey(spark, folder), 10, ["respondent"])


@query
def sentinel_filter_keep(spark, folder):
    return stats.sentinel_filter(inputs.survey(spark, folder), "salary", nulls="keep")


@query
def sentinel_filter_drop(spark, folder):
    return stats.sentinel_filter(inputs.survey(spark, folder), "salary", nulls="drop")


@query
def annualise(spark, folder):
    return stats.annualise(inputs.survey(spark, folder), "salary", "salary_type")


@query
def group_stats(spark, folder):
    return jobs.salary_statistics(inputs.survey(spark, folder))


@query
def group_stats_saturate(spark, folder):
    return jobs.salary_statistics(inputs.survey(spark, folder), int_mode="saturate")


@query
def group_count_with_total(spark, folder):
    return jobs.salaried_by_country(inputs.survey(spark, folder))


@query
def align_metrics(spark, folder):
    answered = stats.sentinel_filter(inputs.survey(spark, folder), "salary", nulls="drop")
    yearly = answered.withColumn("kind", F.col("salary_type"))
    yearly = stats.annualise(yearly, "salary", "salary_type")
    frames = [
        yearly.filter(F.col("kind") == kind)
        .filter(F.col("salary") >= least)
        .groupBy("country")
        .agg(F.max("salary").alias(f"max_{kind.lower()}"))
        for kind, least in (("Monthly", 60_000), ("Weekly", 200_000), ("Yearly", 7_000))
    ]
    return stats.align_metrics(frames, ["country"])


@query
def partition_profile(spark, folder):
    # Where rows lie differs between runs; all of them must be there in either layout.
    found = jobs.partition_comparison(inputs.survey(spark, folder))
    return found.groupBy("layout").agg(F.sum("rows").alias("rows"))


@query
def partition_layout(spark, folder):
    # Every partition by its number: the layout itself, not its sum.
    survey = inputs.survey(spark, folder)
    found = jobs.partition_comparison(survey, n=sql.PARTITIONS, layout="md5")
    return found.filter(F.col("layout") == "partition").select("partition", "rows")


# Sources and sinks, by writing and reading back


@query
def read_survey(spark, folder):
    path = run_folder(spark, "survey")
    writers.write_delimited(inputs.survey(spark, folder), path, header=True)
    return readers.read_survey(spark, path, ("country", "salary", "salary_type"))


@query
def read_ratings(spark, folder):
    path = run_folder(spark, "ratings")
    writers.write_delimited(inputs.ratings(spark, folder), path, header=True)
    return _round(readers.read_ratings(spark, path), 6, "rating")


@query
def read_baskets(spark, folder):
    path = run_folder(spark, "baskets")
    writers.write_delimited(inputs.event_baskets(spark, folder), path)
    return itemsets.frequent_items(readers.read_baskets(spark, path), 1)


@query
def read_documents(spark, folder):
    path = run_folder(spark, "documents")
    one_line = readers.read_table(spark, folder, "documents").select(
        F.translate("text", "\n\r", "  ").alias("value")
    )
    writers.write_lines(one_line, path)
    return (
        readers.read_documents(spark, path)
        .groupBy(F.size("tokens").cast("long").alias("n_tokens"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def write_delimited(spark, folder):
    path = run_folder(spark, "statistics")
    result = jobs.salary_statistics(inputs.survey(spark, folder), int_mode="saturate")
    shown = result.withColumn("avg_value", F.format_string("%.2f", "avg_value"))
    writers.write_lines(writers.delimited_lines(shown), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def write_counts(spark, folder):
    path = run_folder(spark, "counts")
    counts = jobs.salaried_by_country(inputs.survey(spark, folder)).drop("sort_flag")
    writers.write_lines(writers.delimited_lines(counts), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def write_itemset_report(spark, folder):
    path = run_folder(spark, "itemsets")
    writers.write_itemset_report(jobs.frequent_itemset_lines(*_event_baskets(spark, folder)), path)
    return readers.read_itemset_report(spark, path)


@query
def write_cluster_report(spark, folder):
    path = run_folder(spark, "clusters")
    writers.write_report(_labelled_report(spark, folder), path)
    schema = (
        "algorithm string, wsse double, "
        "clusters array<struct<id int, size long, error double, terms array<string>>>"
    )
    return _flat_report(spark.read.schema(schema).json(path))


# Recommendation


@query
def dense_ids(spark, folder):
    return ids.dense_ids(
        readers.read_table(spark, folder, "orders").select(
            F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user")
        ),
        "user",
    )


@query
def item_means(spark, folder):
    return _round(recommend.item_means(inputs.ratings(spark, folder)), 6, "mean")


@query
def user_means(spark, folder):
    return _round(recommend.user_means(inputs.ratings(spark, folder)), 6, "mean")


@query
def item_deviations(spark, folder):
    return recommend.item_deviations(inputs.ratings(spark, folder))


@query
def item_pair_similarity(spark, folder):
    dev = recommend.item_deviations(inputs.train_test(spark, folder)[0])
    return recommend.item_pair_similarity(dev)


@query
def similar_items(spark, folder):
    dev = recommend.item_deviations(inputs.train_test(spark, folder)[0])
    return recommend.similar_items(dev, sql.NEIGHBOURS)


def _cf(spark, folder, denominator):
    train, test = inputs.train_test(spark, folder)
    return recommend.item_cf_predict(train, test, denominator=denominator)


@query
def item_cf_predict(spark, folder):
    return _round(_cf(spark, folder, "abs"), 4, "rating", "pred_dev", "pred_rating")


@query
def item_cf_predict_signed(spark, folder):
    return _round(_cf(spark, folder, "signed"), 4, "rating", "pred_dev", "pred_rating")


def _rounded_cf(spark, folder):
    return _round(_cf(spark, folder, "abs"), 4, "rating", "pred_rating")


@query
def rating_error_histogram(spark, folder):
    return recommend.rating_error_histogram(
        _rounded_cf(spark, folder), prediction="pred_rating", count_nan=False
    )


@query
def rating_rmse(spark, folder):
    found = recommend.rating_rmse(_rounded_cf(spark, folder), prediction="pred_rating")
    return _round(found, 6, "rmse")


@query
def als_predict(spark, folder):
    train, test = inputs.train_test(spark, folder)
    return _round(jobs.factor_ratings(train, test).predictions, 4, "prediction")


@query
def als_error_histogram(spark, folder):
    return jobs.factor_ratings(*inputs.train_test(spark, folder)).histogram


@query
def als_rmse(spark, folder):
    return _round(jobs.factor_ratings(*inputs.train_test(spark, folder)).rmse, 4, "rmse")


def _written_predictions(spark, result):
    path = run_folder(spark, "predictions")
    rounded = _round(result.predictions, 4, "prediction")
    shown = rounded.withColumn("prediction", F.format_string("%.4f", "prediction"))
    writers.write_lines(writers.delimited_lines(shown), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def neighbour_ratings(spark, folder):
    return _written_predictions(spark, jobs.neighbour_ratings(*inputs.train_test(spark, folder)))


@query
def factor_ratings(spark, folder):
    return _written_predictions(spark, jobs.factor_ratings(*inputs.train_test(spark, folder)))


# Frequent itemsets


def _event_baskets(spark, folder):
    rows = inputs.event_baskets(spark, folder)
    return rows, inputs.share_of_baskets(rows, sql.EVENT_SHARE)


def _order_baskets(spark, folder):
    rows = inputs.order_baskets(spark, folder)
    return rows, inputs.share_of_baskets(rows, sql.ORDER_SHARE)


def _joined(found: DataFrame) -> DataFrame:
    return found.withColumn("items", F.array_join("items", ","))


@query
def baskets(spark, folder):
    return _joined(itemsets.baskets(inputs.event_baskets(spark, folder), "basket", "item"))


@query
def frequent_itemsets(spark, folder):
    return _joined(itemsets.frequent_itemsets(*_event_baskets(spark, folder)))


@query
def frequent_itemsets_orders(spark, folder):
    return _joined(itemsets.frequent_itemsets(*_order_baskets(spark, folder)))


@query
def son_candidates(spark, folder):
    rows, support = _order_baskets(spark, folder)
    weighted = itemsets.weighted_baskets(rows, support)
    found = itemsets.son_candidates(rows, support, chunk_baskets=4_000, weighted=weighted)
    frequent = itemsets.frequent_itemsets(rows, support, weighted=weighted).select("items")
    seen = found.select("items", F.lit(True).alias("seen"))
    return frequent.join(seen, "items", "left").agg(
        F.count(F.lit(1)).alias("frequent"), F.count_if(F.col("seen").isNull()).alias("missed")
    )


@query
def son_itemsets(spark, folder):
    rows, support = _order_baskets(spark, folder)
    return _joined(itemsets.son_itemsets(rows, support, chunk_baskets=4_000))


@query
def son_verify(spark, folder):
    rows, support = _event_baskets(spark, folder)
    found = itemsets.son_candidates(rows, support, chunk_baskets=8)
    return _joined(itemsets.son_verify(rows, found, support))


@query
def apriori_level_2(spark, folder):
    rows, support = _order_baskets(spark, folder)
    single = itemsets.frequent_items(rows, support).select(F.array("item").alias("items"))
    return _joined(itemsets.apriori_level(rows, single, 2, support))


@query
def apriori_level_3(spark, folder):
    rows, support = _event_baskets(spark, folder)
    pairs = itemsets.frequent_itemsets(rows, support).filter(F.col("size") == 2)
    return _joined(itemsets.apriori_level(rows, pairs, 3, support))


@query
def itemset_report(spark, folder):
    return jobs.frequent_itemset_lines(*_event_baskets(spark, folder))


# Text features and clustering


@query
def tokenize_docs(spark, folder):
    return inputs.documents(spark, folder).select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.md5(F.array_join("tokens", "|")).alias("tokens_md5"),
    )


@query
def term_idf(spark, folder):
    return _round(features.term_idf(inputs.documents(spark, folder)), 6, "idf")


def _vector_figures(df: DataFrame, column: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array(column)
    return df.select(
        "doc_id",
        F.round(F.aggregate(values, F.lit(0.0), lambda s, x: s + x), 6).alias("total"),
        F.size(F.filter(values, lambda x: x != 0)).alias("filled"),
    )


@query
def hashed_tf(spark, folder):
    docs = inputs.documents(spark, folder)
    counted = _vector_figures(features.hashed_tf(docs, jobs.MLLIB_BUCKETS), "tf")
    # The buckets are the library's; their counts add up to the tokens whatever they are.
    return counted.select("doc_id", "total")


@query
def tfidf(spark, folder):
    counts = features.hashed_tf(inputs.documents(spark, folder), jobs.MLLIB_BUCKETS)
    return _vector_figures(features.tfidf(counts), "tfidf")


@query
def bucket_tf(spark, folder):
    return features.bucket_tf(inputs.documents(spark, folder), jobs.MLLIB_BUCKETS)


@query
def bucket_tfidf(spark, folder):
    found = features.bucket_tfidf(inputs.documents(spark, folder), jobs.MLLIB_BUCKETS)
    return _round(found, 6, "weight")


@query
def kmeans_seed(spark, folder):
    seeds = clustering.kmeans_seed(inputs.vectors(spark, folder), "vec_id", sql.K, sql.SEED)
    return seeds.select("cluster", F.col("id").alias("vec_id"))


def _seeds(spark, folder):
    vectors = inputs.vectors(spark, folder)
    return clustering.centroid_array(
        clustering.kmeans_seed(vectors, "vec_id", sql.K, sql.SEED)
    )


@query
def kmeans_assign(spark, folder):
    assigned = clustering.kmeans_assign(inputs.vectors(spark, folder), _seeds(spark, folder))
    return _round(assigned.select("vec_id", "cluster", "sqdist"), 6, "sqdist")


def _cells(centroids: DataFrame) -> DataFrame:
    found = centroids.select("cluster", "n", F.posexplode("centroid").alias("dim", "value"))
    return _round(found, 6, "value")


@query
def kmeans_update(spark, folder):
    seeds = _seeds(spark, folder)
    assigned = clustering.kmeans_assign(inputs.vectors(spark, folder), seeds)
    return _cells(clustering.kmeans_update(assigned, seeds))


@query
def kmeans_lloyd(spark, folder):
    vectors = inputs.vectors(spark, folder)
    centres, _ = clustering.kmeans_lloyd(vectors, sql.K, sql.ITERS, sql.SEED, "vec_id")
    assigned = clustering.kmeans_assign(vectors, centres)
    return _round(assigned.select("vec_id", "cluster", "sqdist"), 6, "sqdist")


@query
def cluster_summary(spark, folder):
    assigned = clustering.kmeans_assign(inputs.vectors(spark, folder), _seeds(spark, folder))
    return _round(clustering.cluster_summary(assigned), 6, "error")


def _fit_figures(found: DataFrame) -> DataFrame:
    """Rows, and whether all clusters together cost less than a single one."""
    cells = found.select("sqdist", F.posexplode("features").alias("dim", "x"))
    x = F.col("x").cast("double")
    by_dim = cells.groupBy("dim").agg(
        F.count(F.lit(1)).alias("rows"), (F.sum(x * x) - F.sum(x) * F.avg(x)).alias("spread"),
        F.sum("sqdist").alias("cost"),
    )
    return by_dim.agg(F.max("rows").alias("rows"), (F.max("cost") < F.sum("spread")).alias("better"))


@query
def kmeans(spark, folder):
    return _fit_figures(clustering.kmeans(inputs.vectors(spark, folder), sql.K, 20))


@query
def bisecting_kmeans(spark, folder):
    return _fit_figures(clustering.bisecting_kmeans(inputs.vectors(spark, folder), sql.K, 20))


@query
def cluster_terms(spark, folder):
    return clustering.cluster_terms(inputs.documents(spark, folder), "lang")


def _labelled(spark, folder):
    """doc_id, cluster, features, tokens: labelled documents with their length as feature."""
    docs = readers.read_table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    labels = readers.read_table(spark, folder, "labels")
    return features.tokenize_docs(docs, "text").join(labels, "doc_id").select(
        "doc_id",
        (F.col("quality") * 2 + F.col("toxic")).alias("cluster"),
        F.array(F.col("n_chars") / 1000.0).alias("features"),
        "tokens",
    )


def _labelled_report(spark, folder):
    docs = _labelled(spark, folder)
    means = clustering.kmeans_update(docs, [[0.0]] * 4).select(
        "cluster", F.col("centroid").alias("features")
    )
    measured = clustering.distance_to_cluster(docs, clustering.centroid_array(means))
    return clustering.cluster_report(
        clustering.cluster_summary(measured), clustering.cluster_terms(docs), "by label"
    )


def _flat_report(report: DataFrame) -> DataFrame:
    flat = report.select("algorithm", "wsse", F.inline("clusters")).withColumn(
        "terms", F.array_join("terms", ",")
    )
    return _round(flat, 4, "wsse", "error")


@query
def cluster_report(spark, folder):
    return _flat_report(_labelled_report(spark, folder))


@query
def lloyd_report_tf(spark, folder):
    return _flat_report(jobs.lloyd_report(inputs.documents(spark, folder), 5, 20, "tf"))


@query
def lloyd_report_tfidf(spark, folder):
    return _flat_report(jobs.lloyd_report(inputs.documents(spark, folder), 5, 20, "tfidf"))


def _terms_report(spark, folder, weighting):
    docs = inputs.documents(spark, folder)
    report = jobs.lloyd_report(
        docs, sql.CLUSTERS, sql.CLUSTER_ITERS, weighting, seed=sql.SEED, terms=sql.TERMS
    )
    return _flat_report(report)


@query
def lloyd_report_terms_tf(spark, folder):
    return _terms_report(spark, folder, "tf")


@query
def lloyd_report_terms_tfidf(spark, folder):
    return _terms_report(spark, folder, "tfidf")


@query
def kmeans_report(spark, folder):
    return _flat_report(jobs.mllib_report(inputs.documents(spark, folder), 8, 20, "kmeans"))


@query
def bisecting_report(spark, folder):
    return _flat_report(jobs.mllib_report(inputs.documents(spark, folder), 8, 20, "bisecting"))


# Samples, tags and seen-before tests, in batch and as streams


@query
def extract_tags(spark, folder):
    texts = inputs.texts(spark, folder)
    return sampling.extract_tags(texts, "text", ["event_id"], sql.PREFIX)


@query
def tag_counts(spark, folder):
    return sampling.tag_counts(inputs.texts(spark, folder), "text", sql.PREFIX)


@query
def reservoir_sample(spark, folder):
    return sampling.reservoir_sample(inputs.texts(spark, folder), "event_id", seed=sql.SEED)


@query
def reservoir_stats(spark, folder):
    texts = inputs.texts(spark, folder)
    sample = sampling.reservoir_sample(texts, "event_id", seed=sql.SEED)
    seen = texts.agg(F.count(F.lit(1))).scalar()
    return sampling.reservoir_stats(sample, "text", seen, prefix=sql.PREFIX)


@query
def bloom_hashes(spark, folder):
    tags = inputs.event_tags(spark, folder).select("tag").distinct()
    return membership.bloom_hashes(tags)


@query
def bloom_hashes_legacy(spark, folder):
    tags = inputs.event_tags(spark, folder).select("tag").distinct()
    return membership.bloom_hashes(tags, legacy=True)


@query
def seen_audit(spark, folder):
    return membership.seen_audit(inputs.event_tags(spark, folder), ["event_id"])


@query
def bloom_flags(spark, folder):
    return membership.bloom_flags(inputs.event_tags(spark, folder), ["event_id"])


@query
def bloom_audit(spark, folder):
    return membership.bloom_audit(inputs.event_tags(spark, folder), ["event_id"])


@query
def bloom_audit_legacy(spark, folder):
    return membership.bloom_audit(inputs.event_tags(spark, folder), ["event_id"], legacy=True)


def _stream(spark, folder, name, by, batches=sql.BATCHES):
    """The table as a stream of files, several in a batch."""
    path = run_folder(spark, f"{name}-files")
    rows = readers.read_table(spark, folder, name)
    files = inputs.in_slices(rows, by, batches, path)
    return readers.stream_texts(spark, rows.schema, path, max_files=files)


def _finished(stream_query):
    """Number of the last batch."""
    stream_query.awaitTermination()
    return stream_query.lastProgress["batchId"]


def _with_batches(df: DataFrame, last: int) -> DataFrame:
    return df.withColumn("batches", F.lit(last + 1))


def _run_reservoir(spark, folder):
    state = run_folder(spark, "reservoir")
    texts = inputs.as_texts(_stream(spark, folder, "conversations", "conv_id"))
    return state, _finished(
        streams.stream_reservoir(texts, state, seed=sql.SEED, prefix=sql.PREFIX)
    )


@query
def stream_reservoir(spark, folder):
    state, last = _run_reservoir(spark, folder)
    return _with_batches(streams.current_sample(spark, state, last), last)


@query
def stream_reservoir_stats(spark, folder):
    state, last = _run_reservoir(spark, folder)
    return _with_batches(streams.batch_metrics(spark, state, last), last)


@query
def stream_bloom(spark, folder):
    state = run_folder(spark, "bloom")
    tags = inputs.as_event_tags(_stream(spark, folder, "events", "event_id"))
    last = _finished(streams.stream_bloom(tags, state, tag="tag", text=None))
    return _with_batches(streams.batch_metrics(spark, state, last).drop("at", "bloom_new"), last)


@query
def stream_bloom_timed(spark, folder):
    state = run_folder(spark, "bloom-timed")
    tags = inputs.as_event_tags(_stream(spark, folder, "events", "event_id", sql.TIMED_BATCHES))
    # Batches start by the clock, as in a job that never ends; this one ends with its files.
    running = streams.stream_bloom(tags, state, tag="tag", text=None, available_now=False)
    running.processAllAvailable()
    running.stop()
    last = streams.last_batch(spark, state)
    return _with_batches(streams.batch_metrics(spark, state, last).drop("at", "bloom_new"), last)


@query
def stream_bloom_texts(spark, folder):
    state = run_folder(spark, "bloom")
    texts = inputs.as_texts(_stream(spark, folder, "conversations", "conv_id"))
    last = _finished(streams.stream_bloom(texts, state, prefix=sql.PREFIX))
    return _with_batches(streams.batch_metrics(spark, state, last).drop("at", "bloom_new"), last)
