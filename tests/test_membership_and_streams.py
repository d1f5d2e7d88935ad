import random

import pytest
from pyspark.sql import functions as F

from siftmine.functions.text import bit_positions
from siftmine.operators import membership, sampling
from siftmine.sources.readers import stream_texts
from siftmine.plans import inputs
from siftmine.streaming import jobs as streams
from siftmine.streaming.state import VersionedTable


def _texts(seed, n=240):
    dice = random.Random(seed)
    words = ["#t%d" % dice.randint(0, 60) for _ in range(3 * n)]
    # One tag makes up a third of the occurrences.
    return [
        (i, " ".join(["#hot", words[3 * i], "plain", words[3 * i + 1]][: 1 + dice.randint(0, 3)]))
        for i in range(n)
    ]


def _sequential(spark, tags, m, legacy):
    """Flags of the occurrences in order, by the plain loop."""
    frame = spark.createDataFrame([(t,) for t in sorted(set(tags))], "tag string")
    h1, h2 = bit_positions(F.col("tag"), m, legacy)
    bits = {r[0]: (r[1], r[2]) for r in frame.select("tag", h1, h2).collect()}
    filled, known, bloom, exact = set(), set(), [], []
    for tag in tags:
        bloom.append(set(bits[tag]) <= filled)
        exact.append(tag in known)
        filled.update(bits[tag])
        known.add(tag)
    return bloom, exact


@pytest.mark.parametrize("legacy", [False, True])
@pytest.mark.parametrize("m", [16, 64, 1024])
def test_audit_matches_the_sequential_filter(spark, m, legacy):
    texts = spark.createDataFrame(_texts(1), "event_id long, text string").repartition(5)
    tags = sampling.extract_tags(texts, "text", ["event_id"]).persist()
    order = ["event_id", "pos"]
    ordered = [r["tag"] for r in tags.orderBy(*order).collect()]
    bloom, exact = _sequential(spark, ordered, m, legacy)
    flags = membership.bloom_flags(tags, order, m, legacy).orderBy(*order).collect()
    assert [r["bloom_seen"] for r in flags] == bloom
    seen = membership.seen_audit(tags, order).orderBy(*order).collect()
    assert [r["seen"] for r in seen] == exact
    assert all(b for b, e in zip(bloom, exact) if e)  # no false negatives
    audit = membership.bloom_audit(tags, order, m, legacy).first()
    assert audit["occurrences"] == len(ordered)
    assert audit["bloom_positive"] == sum(bloom)
    assert audit["exact_positive"] == sum(exact)
    assert audit["false_positives"] == sum(bloom) - sum(exact)
    assert audit["distinct_tags"] == len(set(ordered))
    assert audit["correct"] == audit["distinct_tags"] - audit["false_positives"]


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], "event_id long, pos int, tag string")
    audit = membership.bloom_audit(none, ["event_id", "pos"]).first()
    assert (audit["occurrences"], audit["bloom_positive"], audit["fp_rate"]) == (0, 0, None)


def _write_files(spark, folder, rows, sizes):
    """One file per batch, each later than the one before it."""
    start = 0
    for i, size in enumerate(sizes):
        part = spark.createDataFrame(rows[start : start + size], "event_id long, text string")
        part.coalesce(1).write.mode("append").parquet(f"{folder}/part={i:03d}")
        start += size
    assert start == len(rows)


@pytest.fixture
def source(spark, tmp_path):
    def start(rows, sizes):
        folder = str(tmp_path / "source")
        _write_files(spark, folder, rows, sizes)
        stream = stream_texts(spark, "event_id long, text string", f"{folder}/*", 1)
        return folder, stream

    return start


@pytest.mark.parametrize("sizes", [[240], [30, 70, 0, 5, 135]])
def test_stream_bloom_equals_batch(spark, source, tmp_path, sizes):
    rows = _texts(2)
    _, stream = source(rows, sizes)
    state = str(tmp_path / "state")
    query = streams.stream_bloom(stream, state, m=64)
    query.awaitTermination()
    tags = sampling.extract_tags(
        spark.createDataFrame(rows, "event_id long, text string"), "text", ["event_id"]
    )
    expected = membership.bloom_audit(tags, ["event_id", "pos"], 64).first().asDict()
    last = streams.batch_metrics(spark, state, query.lastProgress["batchId"]).drop("at", "bloom_new").first().asDict()
    assert last.pop("texts") == 240
    assert last == expected
    history = streams.read_metrics(spark, state).orderBy("batch").collect()
    assert [r["texts"] for r in history] == sorted(r["texts"] for r in history)
    assert len(history) == len(sizes)


@pytest.mark.parametrize("sizes", [[240], [30, 70, 0, 140]])
def test_stream_reservoir_equals_batch(spark, rows, source, tmp_path, sizes):
    data = _texts(3)
    _, stream = source(data, sizes)
    state = str(tmp_path / "state")
    query = streams.stream_reservoir(stream, state, seed=5, n=50)
    query.awaitTermination()
    batch = spark.createDataFrame(data, "event_id long, text string").withColumn(
        "event_id", F.col("event_id").cast("string")
    )
    sample = sampling.reservoir_sample(batch, "event_id", 50, 5)
    found = streams.current_sample(spark, state, query.lastProgress["batchId"])
    assert sorted(rows(found)) == sorted(rows(sample))
    expected = rows(sampling.reservoir_stats(sample, "text", F.lit(240)))
    assert sorted(rows(streams.batch_metrics(spark, state, query.lastProgress["batchId"]))) == sorted(expected)


def test_stream_goes_on_after_a_restart(spark, source, tmp_path):
    rows = _texts(4)
    folder, stream = source(rows[:100], [60, 40])
    state = str(tmp_path / "state")
    streams.stream_bloom(stream, state, m=64).awaitTermination()
    first = streams.batch_metrics(spark, state, 1).first()["texts"]
    for i, (a, b) in enumerate([(100, 150), (150, 240)]):
        more = spark.createDataFrame(rows[a:b], "event_id long, text string")
        more.coalesce(1).write.parquet(f"{folder}/part=10{i}")
    again = stream_texts(spark, "event_id long, text string", f"{folder}/*", 1)
    query = streams.stream_bloom(again, state, m=64)
    query.awaitTermination()
    last = streams.batch_metrics(spark, state, query.lastProgress["batchId"]).drop("at", "bloom_new").first().asDict()
    assert (first, last.pop("texts")) == (100, 240)
    tags = sampling.extract_tags(
        spark.createDataFrame(rows, "event_id long, text string"), "text", ["event_id"]
    )
    assert last == membership.bloom_audit(tags, ["event_id", "pos"], 64).first().asDict()


@pytest.mark.parametrize("file_rows", [10, 1_000_000])
def test_slices_lose_nothing(spark, tmp_path, file_rows):
    """Null, negative and repeated numbers; several files in a batch; every batch holds the next slice."""
    rows = [(i, f"t{i}") for i in range(100)] + [(None, "none"), (None, "none"), (-7, "below"), (99, "t99")]
    path = str(tmp_path / "files")
    df = spark.createDataFrame(rows, "n long, text string").repartition(3)
    files = inputs.in_slices(df, "n", 4, path, file_rows)
    assert files == (3 if file_rows == 10 else 2)
    seen = []
    stream = stream_texts(spark, "n long, text string", path, files)
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: seen.append([tuple(r) for r in batch.collect()]))
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert len(seen) == 4
    assert sorted(map(repr, sum(seen, []))) == sorted(map(repr, rows))
    numbers = [[n for n, _ in batch if n is not None and n >= 0] for batch in seen]
    assert all(max(a) < min(b) for a, b in zip(numbers, numbers[1:]))
    assert {"none", "below"} <= {text for _, text in seen[0]}
    # More than one task wrote each batch.
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() == 4 * files


@pytest.mark.parametrize("numbers", [[None, None], [-3, -1, None], []])
def test_slices_without_a_number(spark, tmp_path, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    inputs.in_slices(df, "n", 4, str(tmp_path / "files"))
    found = spark.read.schema("n long").parquet(str(tmp_path / "files"))
    assert sorted(map(repr, [r[0] for r in found.collect()])) == sorted(map(repr, numbers))


def test_timed_batches(spark, source, tmp_path):
    _, stream = source(_texts(5), [100, 140])
    state = str(tmp_path / "state")
    query = streams.stream_reservoir(stream, state, available_now=False)
    query.processAllAvailable()
    query.stop()
    assert streams.batch_metrics(spark, state, 1).first()["texts_seen"] == 240


def test_batches_can_run_twice(spark, tmp_path):
    """Every batch is run two times, as after a failure just before its commit."""
    table = VersionedTable(spark, str(tmp_path / "small"), "n long")
    for batch in range(5):
        for _ in range(2):
            old = table.before(batch).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
            table.write(batch, spark.createDataFrame([(old + batch,)], "n long"))
    assert table.of(4).first()[0] == sum(range(5))


def test_failed_batch_runs_again(spark, source, tmp_path, monkeypatch):
    """A batch that fails after writing its figures is run again with the same result."""
    rows = _texts(6)
    folder, stream = source(rows, [80, 80, 80])
    state = str(tmp_path / "state")
    real, calls = streams.audit_figures, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(streams, "audit_figures", failing)
    with pytest.raises(Exception, match="lost"):
        streams.stream_bloom(stream, state, m=64).awaitTermination()
    again = stream_texts(spark, "event_id long, text string", f"{folder}/*", 1)
    query = streams.stream_bloom(again, state, m=64)
    query.awaitTermination()
    last = streams.batch_metrics(spark, state, query.lastProgress["batchId"]).drop("at", "bloom_new").first().asDict()
    assert last.pop("texts") == 240
    tags = sampling.extract_tags(
        spark.createDataFrame(rows, "event_id long, text string"), "text", ["event_id"]
    )
    assert last == membership.bloom_audit(tags, ["event_id", "pos"], 64).first().asDict()
