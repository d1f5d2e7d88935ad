"""Importance resampling towards a target: documents whose n-grams are likelier in the target are drawn.

Words are runs of letters, digits and characters beyond ASCII; features are
all runs of one to three words of a text, hashed to buckets by their CRC-32.
The counts of the buckets in all documents and in all target texts give each
bucket a gain, a document's weight is the sum of the gains of its features,
and weight plus Gumbel noise from a hash of the id, in falling order, is a
draw without replacement.

Hashing by length-bucketed CRC matrices: of a slice of texts, the distinct
features of equal length form one matrix of bytes, and all their CRCs are
updated together, column by column; the buckets are then scattered back to
the places of the features. Features of more than ``LONG_FEATURE`` bytes are
too few to gain by that and hashed one by one, with the same result.

Tasks hand on one row for each bucket; the driver sees one number for each.
Gains go to the tasks in that form. The draw is a distributed sort of narrow
rows.

Defined cases: a null or empty text has no features and weight 0; texts are
read whole; a null id hashes as an empty one and comes last among equal
scores; rows that repeat are judged one by one, and if they are equal in
score and id, fewer features come first; empty tables give no rows, an empty
target is a target without features; columns that the result adds replace
those of that name, all others are passed on.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import numbered, settle, small_batches, uncommon
from siftmine.llm.words import raw_texts, words_of

BUCKETS = 10_000
LONGEST_RUN = 3
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
#: Bytes of text whose features are made distinct at once.
SLICE_BYTES = 4_000_000
#: Features of more bytes are hashed one by one.
LONG_FEATURE = 512
#: Bytes of one matrix.
MATRIX_BYTES = 4_000_000


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc32_of(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the slices of ``buffer`` (bytes) that start and are as long as given."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for first, last in zip(edges[:-1], edges[1:]):
        length = int(lengths[order[first]])
        if length > LONG_FEATURE:
            for one in order[first:last]:
                out[one] = zlib.crc32(buffer[starts[one] : starts[one] + length])
            continue
        step = max(1, MATRIX_BYTES // max(1, length))
        for at in range(first, last, step):
            own = order[at : min(at + step, last)]
            crc = np.full(len(own), 0xFFFFFFFF, np.uint32)
            # One row for each place in the features, one column for each feature.
            for column in buffer[np.arange(length)[:, None] + starts[own]]:
                crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
            out[own] = ~crc
    return out


def _slices(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """The words of each text, in slices of about ``SLICE_BYTES``."""
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        held.append(words_of(text))
        size += len(text or b"")
        if size >= SLICE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def feature_buckets(texts: list[list[bytes]], buckets: int = BUCKETS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, … words: (place of the first word among all words, bucket) of each feature, in order."""
    words = [word for text in texts for word in text]
    if not words:
        return []
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    own = np.fromiter(map(len, number), np.int64, len(number))
    lengths = own[ids]
    starts = np.cumsum(lengths + 1) - lengths - 1
    buffer = np.frombuffer(b" ".join(words), np.uint8)
    text_of = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
    found = []
    runs = np.zeros(len(ids), np.int64)
    places = np.arange(len(ids))
    for extra in range(LONGEST_RUN):
        # A run that goes on is the number of the shorter one and of its next word.
        inside = places + extra < len(ids)
        inside[inside] = text_of[places[inside]] == text_of[places[inside] + extra]
        places, runs = places[inside], runs[inside]
        if not len(places):
            break
        _, first, runs = np.unique(
            runs * len(number) + ids[places + extra], return_index=True, return_inverse=True
        )
        begin, last = starts[places[first]], places[first] + extra
        crc = crc32_of(buffer, begin, starts[last] + lengths[last] - begin)
        found.append((places, (crc % buckets).astype(np.int64)[runs]))
    return found


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in _slices(raw_texts(batch.column(0))):
                for _, found in feature_buckets(texts, buckets):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    small_batches(docs.sparkSession)
    each = docs.select(text).mapInArrow(counted, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain): what a feature of each bucket says for the target, in thousandths."""
    spark = docs.sparkSession
    every = spark.range(buckets).select(F.col("id").alias("bucket"))
    both = (
        every.join(bucket_counts(docs, text, buckets).withColumnRenamed("n", "s"), "bucket", "left")
        .join(bucket_counts(target, target_text, buckets).withColumnRenamed("n", "t"), "bucket", "left")
        .na.fill(0, ["s", "t"])
    )
    # One row for each bucket.
    both = settle(both, "bucket-counts")
    total = both.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    ratio = (
        (F.col("t") + 1).cast("double") * float(total[0] + buckets)
        / ((F.col("s") + 1).cast("double") * float(total[1] + buckets))
    )
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weigh(docs: DataFrame, gain: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with n_words, n_features and weight, by ``gain`` (bucket, gain) with one row for each bucket."""
    small_batches(docs.sparkSession)
    table = np.zeros(buckets, np.int64)
    for bucket, value in gain.collect():
        table[bucket] = value

    @F.arrow_udf("n_words long, n_features long, weight long")
    def weighed(texts: pa.Array) -> pa.Array:
        words, features, weights = [], [], []
        for found in _slices(raw_texts(texts)):
            sizes = np.array([len(text) for text in found], np.int64)
            each = np.zeros(int(sizes.sum()) + 1, np.int64)
            for places, bucket in feature_buckets(found, buckets):
                each[places + 1] += table[bucket]
            before = np.cumsum(each)
            ends = np.cumsum(sizes)
            words.append(sizes)
            features.append(sum(np.maximum(sizes - extra, 0) for extra in range(LONGEST_RUN)))
            weights.append(before[ends] - before[ends - sizes])
        columns = [np.concatenate(parts) if parts else np.zeros(0, np.int64) for parts in (words, features, weights)]
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], ["n_words", "n_features", "weight"])

    own = uncommon("weighed", docs)
    added = ["n_words", "n_features", "weight"]
    kept = [c for c in docs.columns if c.lower() not in added]
    judged = docs.withColumn(own, weighed(F.col(text)))
    return judged.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{own}`.{c}").alias(c) for c in added])


def noise(id_col: str, seed: int = SEED):
    """Gumbel noise in thousandths from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(
    weighed: DataFrame,
    id_col: str = "doc_id",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``weighed`` (narrow rows of :func:`weigh`) with score and rank, which is null for rows not drawn."""
    added = ["score", "rank"]
    kept = [c for c in weighed.columns if c.lower() not in added]
    scored = weighed.select(*[F.col(f"`{c}`") for c in kept], (F.col("weight") + noise(id_col, seed)).alias("score"))
    few, last, falling, place = (uncommon(n, scored) for n in ("few", "last", "falling", "drawn_place"))
    scored = settle(
        scored.withColumn(few, F.col("n_words") < least_words)
        .withColumn(last, F.col(id_col).isNull())
        .withColumn(falling, -F.col("score")),
        "scored-documents",
    )
    n = scored.filter(~F.col(few)).count() * percent // 100
    ranked = numbered(scored, [few, falling, last, id_col, "n_features"], place, "ranked-documents")
    rank = F.when(~F.col(few) & (F.col(place) < n), F.col(place) + 1)
    return ranked.withColumn("rank", rank).drop(few, last, falling, place)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text", **options) -> DataFrame:
    """The drawn documents, whole, with their rank and score: ``percent`` of those with ``least_words`` words."""
    row = uncommon("row", docs)
    rows = settle(docs.drop("rank", "score").withColumn(row, F.monotonically_increasing_id()), "documents")
    model = gains(rows, target, text, target_text)
    narrow = weigh(rows.select(row, F.col(id_col).alias("doc_id"), F.col(text).alias("text")), model).drop("text")
    drawn = draw(narrow, "doc_id", **options).filter("rank is not null").select(row, "rank", "score")
    return rows.join(drawn, row).drop(row)
