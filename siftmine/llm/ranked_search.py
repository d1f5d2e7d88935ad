"""Ranked lexical search: a K2-treap over the grid of terms and documents.

The index is sharded by documents. Each shard is a grid with a row for each of
its terms, the commonest first, and a column for each of its documents; a cell
holds the impact of the term on the document's score without the term's
weight. The grid is halved in both directions again and again; only quadrants
that hold something exist. Every level keeps four bits for each quadrant, which
say which of its quarters exist, and for each of those by how much its largest
impact is below that of the quadrant, so the numbers are small.

A query item is a set of rows. Their paths from the root descend together over
ranges of documents: a range's bound is the sum over the terms of the weight
times the largest impact in the term's quadrant of that range. Ranges are
opened best first, many of one level at once, and never once their bound is
below the item's k-th best score so far, which goes on from shard to shard
within a task. At the last level the bound is the score itself. So the result
is exact, ties included.

N, L and the document frequencies are of all documents: the first two are
counted before the shards are built, and the frequencies are summed over the
shards' term lists. Shards are built where the texts are read, without a
shuffle. Items are searched in blocks of ``ITEM_BLOCK``; a block's terms are on
the driver and in every task, nothing else is.

Defined cases: a null text, or one without a term, is not found and does not
count; a row without id takes no part; rows that repeat an id are documents of
their own; every row of items is an item of its own, one without known terms
has no result; scores of 0 are no result; texts are read whole; empty tables
give no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siftmine.llm.common import numbered, settle, small_batches
from siftmine.llm.words import raw_texts, words_of
from siftmine.session import run_folder

K = 50
#: Bytes of text, and documents, after which a shard is closed.
SHARD_BYTES = 16_000_000
SHARD_DOCS = 1 << 16
#: Ranges of documents that are opened at once.
WIDTH = 512
#: Items whose terms are in a task at once.
ITEM_BLOCK = 256
#: Parts in which the tasks' results are merged first.
MERGE_PARTS = 64

_SCHEMA = "docs binary, terms binary, frequencies binary, height int, root long, bits array<binary>, below array<binary>"


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 50 + 50 * n * n_docs // n_terms


# The treap


def _spread(numbers: np.ndarray) -> np.ndarray:
    """The lower 32 bits of each number, at every second place."""
    out = numbers.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        out |= out << np.uint64(shift)
        out &= np.uint64(mask)
    return out


def build_treap(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, height: int) -> tuple[int, list[bytes], list[bytes]]:
    """(largest impact, child bits of each level, distances to the quadrant's impact) of cells, each given once."""
    codes = _spread(rows)
    codes <<= np.uint64(1)
    codes |= _spread(columns)
    order = np.argsort(codes)
    codes, most = codes[order], impacts[order]
    del order
    bits, below = [], []
    for _ in range(height):
        above = codes >> np.uint64(2)
        first = np.concatenate([[True], above[1:] != above[:-1]])
        starts = np.flatnonzero(first)
        above = above[starts]
        # A quadrant and its quarter, as a place among the quarters of all quadrants.
        place = np.cumsum(first, dtype=np.int32)
        del first
        place -= 1
        parent_most = np.maximum.reduceat(most, starts)
        below.append((parent_most[place] - most).astype(np.int32).tobytes())
        place *= 4
        codes &= np.uint64(3)
        place += codes.astype(np.int32)
        there = np.zeros(4 * len(starts), bool)
        there[place] = True
        bits.append(np.packbits(there, bitorder="little").tobytes())
        codes, most = above, parent_most
    return int(most[0]), bits[::-1], below[::-1]


class Treap:
    """The levels of a treap, from the root down."""

    def __init__(self, height: int, root: int, bits: list[bytes], below: list[bytes]):
        self.height, self.root = height, root
        self.bits = [np.frombuffer(level, np.uint8) for level in bits]
        self.below = [np.frombuffer(level, np.int32) for level in below]
        self.before = [
            np.concatenate([[0], np.cumsum(np.bitwise_count(level), dtype=np.int64)]) for level in self.bits
        ]

    def children(self, level: int, nodes: np.ndarray, quarter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the quarters exist, their numbers on the next level, and their distances below their node."""
        at = 4 * nodes + quarter
        byte, place = at >> 3, (at & 7).astype(np.uint8)
        held = self.bits[level][byte]
        there = np.flatnonzero((held >> place) & 1)
        byte, place, held = byte[there], place[there], held[there]
        lower = held & ((np.uint8(1) << place) - np.uint8(1))
        child = self.before[level][byte] + np.bitwise_count(lower)
        return there, child, self.below[level][child]


@dataclass
class _Ranges:
    """Ranges of documents of one level, best first, and the nodes of the terms' paths that are in them."""

    level: int
    prefix: np.ndarray  # of each range
    bound: np.ndarray  # of each range
    owner: np.ndarray  # the range of each node, in order
    term: np.ndarray
    node: np.ndarray
    most: np.ndarray

    def upto(self, n: int) -> _Ranges:
        end = np.searchsorted(self.owner, n)
        return _Ranges(
            self.level, self.prefix[:n], self.bound[:n], self.owner[:end], self.term[:end], self.node[:end], self.most[:end]
        )

    def after(self, n: int) -> _Ranges:
        start = np.searchsorted(self.owner, n)
        return _Ranges(
            self.level,
            self.prefix[n:],
            self.bound[n:],
            self.owner[start:] - n,
            self.term[start:],
            self.node[start:],
            self.most[start:],
        )


def _opened(treap: Treap, ranges: _Ranges, rows: np.ndarray, weights: np.ndarray) -> _Ranges:
    """Both halves of each range that hold a node, best first."""
    row_bit = (rows[ranges.term] >> (treap.height - 1 - ranges.level)) & 1
    sides = []
    for side in (0, 1):
        there, child, below = treap.children(ranges.level, ranges.node, 2 * row_bit + side)
        sides.append((2 * ranges.owner[there] + side, ranges.term[there], child, ranges.most[there] - below))
    owner, term, node, most = (np.concatenate(both) for both in zip(*sides))
    bound = np.zeros(2 * len(ranges.prefix), np.int64)
    np.add.at(bound, owner, weights[term] * most)
    prefix = np.repeat(2 * ranges.prefix, 2)
    prefix[1::2] += 1
    order = np.argsort(-bound, kind="stable")
    order = order[: np.count_nonzero(bound)]
    rank = np.empty(len(bound), np.int64)
    rank[order] = np.arange(len(order))
    owner = rank[owner]
    by_owner = np.argsort(owner, kind="stable")
    return _Ranges(
        ranges.level + 1, prefix[order], bound[order], owner[by_owner], term[by_owner], node[by_owner], most[by_owner]
    )


def search_treap(
    treap: Treap, rows: np.ndarray, weights: np.ndarray, doc_ids: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """``best`` (scores, ids) with the documents of this grid that belong to the first ``k``."""
    scores, ids = best
    every = np.arange(len(rows))
    zero = np.zeros(len(rows), np.int64)
    start = _Ranges(0, np.zeros(1, np.int64), np.array([int(weights.sum()) * treap.root]), zero, every, zero, zero + treap.root)
    turn = count()
    heap = [(-int(start.bound[0]), next(turn), start)]
    while heap:
        bound, _, ranges = heapq.heappop(heap)
        least = int(scores[-1]) if len(scores) == k else 1
        if -bound < least:
            break
        # Bounds fall, so those that count come first.
        ranges = ranges.upto(len(ranges.bound) - int(np.searchsorted(ranges.bound[::-1], least)))
        if ranges.level == treap.height:
            scores = np.concatenate([scores, ranges.bound])
            ids = np.concatenate([ids, doc_ids[ranges.prefix]])
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
            continue
        halves = _opened(treap, ranges, rows, weights)
        while len(halves.bound):
            now, halves = halves.upto(WIDTH), halves.after(WIDTH)
            if int(now.bound[0]) < least:
                break
            heapq.heappush(heap, (-int(now.bound[0]), next(turn), now))
    return scores, ids


# The index


@dataclass
class LexicalIndex:
    """One row for each shard, and the figures of all documents."""

    shards: DataFrame
    n_docs: int  # that have a term
    n_terms: int


class _Shard:
    """Cells of the documents of one shard."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.cells: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: list[int | None], texts: list[bytes | None]) -> None:
        own, sizes = [], []
        for doc, text in zip(ids, texts):
            found = words_of(text) if doc is not None else ()
            if found:
                self.ids.append(doc)
                sizes.append(len(found))
                own.append(np.fromiter(map(self.number.__getitem__, found), np.int32, len(found)))
            self.size += len(text or b"")
        if own:
            # One document at a time: a batch may hold megabytes of words.
            for at, numbers in enumerate(own, len(self.lengths)):
                term, tf = np.unique(numbers, return_counts=True)
                self.cells.append((np.full(len(term), at, np.int32), term, tf.astype(np.int32)))
            self.lengths += sizes

    def full(self) -> bool:
        return self.size >= SHARD_BYTES or len(self.ids) >= SHARD_DOCS

    def row(self, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        # Numbers of a shard are below 2 ** 31; the parts are let go as they are put together.
        column, term, tf = (np.concatenate(parts) for parts in zip(*self.cells))
        self.cells = []
        frequency = np.bincount(term, minlength=len(self.number))
        order = np.argsort(-frequency, kind="stable")
        row_of = np.empty(len(order), np.int32)
        row_of[order] = np.arange(len(order))
        m = length_factor(np.array(self.lengths, np.int64), n_docs, n_terms)
        height = (max(len(order), len(self.ids)) - 1).bit_length()
        impacts = impact(tf.astype(np.int64), m[column])
        del tf
        rows = row_of[term]
        del term
        root, bits, below = build_treap(rows, column, impacts, height)
        del rows, column, impacts
        words = list(self.number)
        values = [
            np.array(self.ids, np.int64).tobytes(),
            b" ".join([words[at] for at in order]),
            frequency[order].astype(np.int32).tobytes(),
            height,
            root,
            bits,
            below,
        ]
        kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary())]
        names = ["docs", "terms", "frequencies", "height", "root", "bits", "below"]
        yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds)], names)


def _sizes(rows: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and the terms in all."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = terms = 0
        for batch in batches:
            for doc, text in zip(batch.column(0), raw_texts(batch.column(1))):
                n = len(words_of(text)) if doc.is_valid else 0
                docs, terms = docs + (n > 0), terms + n
        yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], ["docs", "terms"])

    found = rows.mapInArrow(counted, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> LexicalIndex:
    """The index of ``docs``, written to the shared folder."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n_docs, n_terms = _sizes(rows)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            shard.add(batch.column(0).to_pylist(), raw_texts(batch.column(1)))
            if shard.full():
                yield from shard.row(n_docs, n_terms)
                shard = _Shard()
        yield from shard.row(n_docs, n_terms)

    path = run_folder(spark, "lexical-index")
    # Rows are of many megabytes: the writer looks at its buffers after each, and a reader holds few at once.
    writer = rows.mapInArrow(shards, _SCHEMA).write.option("parquet.page.size.row.check.min", 1)
    writer = writer.option("parquet.block.size", SHARD_BYTES)
    writer.option("parquet.page.size.row.check.max", 1).parquet(path)
    return LexicalIndex(spark.read.schema(_SCHEMA).parquet(path), n_docs, n_terms)


# The search


def term_weight(n_docs: int, frequency: Column) -> Column:
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * frequency + 1).cast("double")
    return F.floor(1000 * F.log(ratio)).cast("long")


def _item_terms(items: DataFrame, text: str) -> DataFrame:
    """(item, term): the distinct terms of each numbered item."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch.column(0), raw_texts(batch.column(1))):
                terms = sorted(set(words_of(raw)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number.as_py()] * len(terms), pa.int64()), pa.array(terms, pa.binary())], ["item", "term"]
                )

    return items.select("item", text).mapInArrow(distinct, "item long, term binary")


def _frequencies(index: LexicalIndex, wanted: set[bytes]) -> DataFrame:
    """(term, frequency) of the wanted terms over all shards."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                numbers = np.frombuffer(batch.column("frequencies")[at].as_buffer(), np.int32)
                terms = batch.column("terms")[at].as_py().split(b" ")
                found = [at for at, term in enumerate(terms) if term in wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([terms[at] for at in found], pa.binary()), pa.array(numbers[found].astype(np.int64))],
                    ["term", "frequency"],
                )

    found = index.shards.select("terms", "frequencies").mapInArrow(held, "term binary, frequency long")
    return found.groupBy("term").agg(F.sum("frequency").alias("frequency"))


def _first(found: DataFrame, k: int, *also: str) -> DataFrame:
    order = W.partitionBy("item", *also).orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(index: LexicalIndex, weighted: list[tuple[int, list[tuple[bytes, int]]]], k: int) -> DataFrame:
    """(part, item, doc_id, score): of each task the best ``k`` of each item."""
    wanted = {term for _, terms in weighted for term, _ in terms}

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none) for _ in weighted]
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                row_of = {term: at for at, term in enumerate(row["terms"].as_py().split(b" ")) if term in wanted}
                # The levels stay in the batch; nothing of a shard is copied.
                doc_ids = np.frombuffer(row["docs"].as_buffer(), np.int64)
                bits, below = ([level.as_buffer() for level in row[name]] for name in ("bits", "below"))
                treap = Treap(row["height"].as_py(), row["root"].as_py(), bits, below)
                for number, (_, terms) in enumerate(weighted):
                    known = [(row_of[term], weight) for term, weight in terms if term in row_of]
                    if known:
                        rows, weights = np.array(known, np.int64).T
                        best[number] = search_treap(treap, rows, weights, doc_ids, best[number], k)
                # Let go before the next shard comes.
                del row, row_of, doc_ids, bits, below, treap
            del batch
        for (item, _), (scores, ids) in zip(weighted, best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item)), pa.array(ids), pa.array(scores)], ["item", "doc_id", "score"]
                )

    columns = index.shards.select("docs", "terms", "height", "root", "bits", "below")
    found = columns.mapInArrow(searched, "item long, doc_id long, score long")
    return found.withColumn("part", F.spark_partition_id() % MERGE_PARTS)


def search(index: LexicalIndex, items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = K) -> DataFrame:
    """(item, item_id, rank, doc_id, score): for each row of ``items`` the ``k`` best documents.

    ``item`` numbers the rows of ``items`` in the order of their id.
    """
    small_batches(items.sparkSession)
    plain = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    asked = settle(numbered(settle(plain, "items"), ["item_id", "text"], "item", "numbered-items"), "items-in-order")
    terms = settle(_item_terms(asked, "text"), "item-terms")
    n_items = asked.count()
    found = None
    for start in range(0, n_items, ITEM_BLOCK):
        own = terms.filter(F.col("item").between(start, start + ITEM_BLOCK - 1))
        # The terms of one block of items.
        wanted = {bytes(row[0]) for row in own.select("term").distinct().collect()}
        weighted = own.join(_frequencies(index, wanted), "term").withColumn(
            "weight", term_weight(index.n_docs, F.col("frequency"))
        )
        by_item: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
        for row in weighted.filter("weight > 0").select("item", "term", "weight").collect():
            by_item[row[0]].append((bytes(row[1]), row[2]))
        block = _search_block(index, sorted(by_item.items()), k)
        block = settle(_first(block, k, "part"), "found-in-parts")
        found = block if found is None else found.unionByName(block)
    if found is None:
        none = asked.select("item", "item_id", F.lit(0).alias("rank"), F.lit(None).cast("long").alias("doc_id"))
        return none.withColumn("score", F.lit(None).cast("long")).filter("false")
    named = _first(found.drop("rank"), k).join(asked.select("item", "item_id"), "item")
    return named.select("item", "item_id", "rank", "doc_id", "score")
