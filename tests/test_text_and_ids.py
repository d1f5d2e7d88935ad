import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftmine.functions.text import bit_positions, character_sum, java_string_hash, split_tokens
from siftmine.operators import features, ids, sampling
from siftmine.session import runs_alone


def _column(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [row[0] for row in df.select(expression(F.col("t"))).collect()]


def test_split_tokens(spark):
    values = ["a b", "a  b ", "", "   ", " a", None]
    assert _column(spark, values, split_tokens) == [
        ["a", "b"], ["a", "", "b"], [""], [], ["", "a"], None,
    ]
    dropped = _column(spark, ["a  b "], lambda c: split_tokens(c, keep_empty=False))
    assert dropped == [["a", "b"]]
    assert _column(spark, ["a.b."], lambda c: split_tokens(c, ".")) == [["a", "b"]]


def test_java_hash_and_anagrams(spark):
    def java_hash(text):
        value, raw = 0, text.encode("utf-16-le")
        for low, high in zip(raw[::2], raw[1::2]):
            value = (value * 31 + high * 256 + low) % 2**32
        return value - 2**32 if value >= 2**31 else value

    words = ["Hello", "", "Aa", "BB", "listen-to-the-longest-tag", "çé", "\U0001f600", "a\U0001f600b\U00020000"]
    assert _column(spark, words, java_string_hash) == [java_hash(w) for w in words]
    assert java_hash("Hello") == 69609650 and java_hash("\U0001f600") == 1772899
    assert _column(spark, ["\U0001f600"], character_sum) == [67 * (0xD83D + 0xDE00)]
    assert _column(spark, ["listen", "silent"], character_sum) == [67 * 655] * 2


def test_bit_positions(spark):
    digest = hashlib.md5(b"tag").hexdigest()
    expected = [int(digest[:8], 16) % 1024, int(digest[8:16], 16) % 1024]
    found = [_column(spark, ["tag"], lambda c, i=i: bit_positions(c)[i])[0] for i in (0, 1)]
    assert found == expected


def test_extract_tags(spark, rows):
    texts = [(1, "#a #a#b x#y # z"), (2, "no\n#after #a"), (3, ""), (4, "#r #r")]
    df = spark.createDataFrame(texts, "id long, text string")
    assert rows(sampling.extract_tags(df, "text", ["id"]), "id", "pos") == [
        (1, 0, "a"), (1, 1, "ab"), (1, 2, ""),
        (2, 0, "after"), (2, 1, "a"),
        (4, 0, "r"), (4, 1, "r"),
    ]
    counts = dict(rows(sampling.tag_counts(df, "text")))
    assert counts == {"a": 2, "ab": 1, "": 1, "after": 1, "r": 2}


def test_reservoir_does_not_depend_on_partitions(spark, rows):
    df = spark.range(1000).withColumnRenamed("id", "event_id")
    whole = set(rows(sampling.reservoir_sample(df.repartition(7), "event_id", 100, 3)))
    assert whole == set(rows(sampling.reservoir_sample(df.coalesce(1), "event_id", 100, 3)))
    parts = [df.filter(f"event_id % 3 = {i}") for i in range(3)]
    merged = sampling.reservoir_sample(parts[0], "event_id", 100, 3)
    for part in parts[1:]:
        both = merged.union(sampling.reservoir_sample(part, "event_id", 100, 3))
        merged = sampling.reservoir_sample(both, "event_id", 100, 3)
    assert set(rows(merged)) == whole and len(whole) == 100
    assert sampling.reservoir_sample(spark.range(5), "id", 100).count() == 5


def test_reservoir_stats_breaks_ties_by_tag(spark, rows):
    texts = ["#b #a", "#a #b #c", "#e #d", "#f #g"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = rows(sampling.reservoir_stats(df, "text", F.lit(9)))
    assert [(r[0], r[1], r[2]) for r in found] == [
        (1, "a", 2), (2, "b", 2), (3, "c", 1), (4, "d", 1), (5, "e", 1),
    ]
    assert {(r[3], r[4]) for r in found} == {(9, "5.75")}


def test_dense_ids_and_ordered_index(spark, rows):
    values = [f"v{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values * 3] + [(None,)], "k string").repartition(5)
    assert rows(ids.dense_ids(df, "k"), "id") == list(zip(values, range(500)))
    clash = spark.createDataFrame([("Aa",), ("BB",)], "k string")
    assert rows(ids.dense_ids(clash, "k"), "id") == [("Aa", 0), ("BB", 1)]
    assert ids.dense_ids(clash.limit(0), "k").count() == 0


def test_term_idf(spark, rows):
    df = spark.createDataFrame([("a a b",), ("a",)], "text string")
    found = {t: (n, round(i, 6)) for t, n, i in rows(features.term_idf(
        features.tokenize_docs(df, "text")))}
    assert found == {"a": (2, 0.0), "b": (1, 0.405465)}


@pytest.mark.parametrize("num_features", [1, 7, 2**18])
def test_bucket_features(spark, num_features):
    docs = [(1, ["a", "b", "a"]), (2, ["b", "", "é"]), (3, []), (4, None), (5, ["b"] * 1000)]
    table = spark.createDataFrame(docs, "doc_id long, tokens array<string>")

    def bucket(term):
        return int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % num_features

    counts = Counter((i, bucket(term)) for i, terms in docs for term in terms or [])
    found = features.bucket_tf(table, num_features).collect()
    assert {(r["doc_id"], r["bucket"]): r["n"] for r in found} == counts
    df = Counter(place for _, place in counts)
    weighted = features.bucket_tfidf(table, num_features).collect()
    assert len(weighted) == len(counts)
    for r in weighted:
        assert r["n"] == counts[r["doc_id"], r["bucket"]]
        assert r["weight"] == pytest.approx(r["n"] * math.log(6 / (df[r["bucket"]] + 1)))
    assert features.bucket_tfidf(table.limit(0), num_features).count() == 0


def test_only_single_processes_do_without_a_shared_folder():
    assert all(map(runs_alone, ["local", "local[8]", "local[*]", "local[4,2]"]))
    assert not any(map(runs_alone, ["local-cluster[3,2,3000]", "spark://host:7077", "yarn", "k8s://host"]))
