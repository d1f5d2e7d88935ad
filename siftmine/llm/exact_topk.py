"""Exact top-k inner-product search by block-at-a-time pruning.

Rows in the order of their id form blocks; a block keeps its vectors (the
forward index) and the largest and smallest value of each component (the
term's extremes). For a query, a block's score is at most the sum over the
components of the larger product with an extreme. Blocks are taken in falling
order of that bound, a few for each query in the first rounds, and scored;
the k-th best score so far is the query's threshold, and a block whose bound
is below it is never read again. The last round scores all blocks that are
left, so the result is exact.

Queries come in blocks, too, and meet the blocks' extremes in bundles; what
is scored are the pairs (query block, block) that have a surviving query.

Defined cases: components are floor(1024 * x) of x as double; a vector that is
null or holds a null, NaN or infinite component takes no part, nor does a row
without id; shorter vectors are filled with 0; a row is no candidate for
queries with its id; rows that repeat an id are candidates, and queries, of
their own; fewer than k candidates are all returned; scores are 64-bit
numbers; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siftmine.llm.common import numbered, settle, small_batches

SCALE = 1024
BLOCK_ROWS = 512
QUERY_ROWS = 256
#: Blocks whose extremes meet a query block at once.
BUNDLE_BLOCKS = 256
#: Blocks scored for each query before the last round.
FIRST_BLOCKS = (4, 16)

_LOWEST = np.iinfo(np.int64).min


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~wrong


def _matrix(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(-1, width)


def _product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole-number products of all rows; through floats where these are exact."""
    high = [int(np.abs(side).max(initial=0)) for side in (left, right)]
    if 0 <= high[0] * high[1] * max(1, left.shape[1]) < 1 << 53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def _bounds(queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The largest score that each query can have in each block."""
    return _product(np.maximum(queries, 0), most) + _product(np.minimum(queries, 0), least)


def _in_blocks(rows: DataFrame, size: int, width: int, purpose: str) -> DataFrame:
    """(block, ids, matrix, most, least) of (vec_id, vector) in the order of the ids."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"block": [], "ids": [], "matrix": [], "most": [], "least": []}
            for block, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                members.sort(key=lambda member: member["index"])
                matrix = np.zeros((len(members), width), np.int64)
                for row, member in zip(matrix, members):
                    row[: len(member["vector"])] = member["vector"]
                ids = np.array([member["vec_id"] for member in members], np.int64)
                out["block"].append(block)
                out["ids"].append(ids.tobytes())
                out["matrix"].append(matrix.tobytes())
                out["most"].append(matrix.max(axis=0).tobytes())
                out["least"].append(matrix.min(axis=0).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["block"], pa.int64()), *[pa.array(out[n], pa.binary()) for n in list(out)[1:]]],
                names=list(out),
            )

    # No more than ``size`` rows are gathered for a block.
    gathered = (
        numbered(rows, ["vec_id"], "index", purpose)
        .groupBy(F.floor(F.col("index") / size).alias("block"))
        .agg(F.collect_list(F.struct("index", "vec_id", "vector")).alias("members"))
    )
    schema = "block long, ids binary, matrix binary, most binary, least binary"
    return settle(gathered.mapInArrow(packed, schema), f"{purpose}-blocks")


def _open_blocks(bundles: DataFrame, queries: DataFrame, n_bundles: int, width: int, first: int | None) -> DataFrame:
    """(query_block, query, block, bound): blocks that may hold a score up to the threshold of a query.

    With ``first`` a bundle hands on only that many of the best for each query.
    """

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                entries = sorted(row["entries"], key=lambda entry: entry["block"])
                most = np.concatenate([_matrix(entry["most"], width) for entry in entries])
                least = np.concatenate([_matrix(entry["least"], width) for entry in entries])
                number = np.array([entry["block"] for entry in entries], np.int64)
                bounds = _bounds(_matrix(row["matrix"], width), most, least)
                thresholds = np.full(len(bounds), _LOWEST)
                for entry in row["thresholds"] or ():
                    thresholds[entry["query"]] = entry["score"]
                open_ = bounds >= thresholds[:, None]
                if first is not None and first < bounds.shape[1]:
                    # Falling bounds, ties to the smaller block, as the blocks are in their order.
                    best = np.argsort(np.invert(bounds), axis=1, kind="stable")[:, :first]
                    among = np.zeros_like(open_)
                    np.put_along_axis(among, best, True, axis=1)
                    open_ &= among
                query, block = np.nonzero(open_)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(query), row["query_block"])),
                        pa.array(query.astype(np.int32)),
                        pa.array(number[block]),
                        pa.array(bounds[query, block]),
                    ],
                    ["query_block", "query", "block", "bound"],
                )

    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_bundles - 1).cast("long")))
    met = queries.withColumn("bundle", each).join(bundles, "bundle")
    return met.select("query_block", "matrix", "thresholds", "entries").mapInArrow(
        survivors, "query_block long, query int, block long, bound long"
    )


def _scored(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, k: int, width: int) -> DataFrame:
    """(query_block, query, query_id, vec_id, score): the best k of each block for each of its queries."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked = np.array(sorted(row["asked"]), np.int32)
                query_ids = np.frombuffer(row["query_ids"], np.int64)[asked]
                ids = np.frombuffer(row["ids"], np.int64)
                scores = _product(_matrix(row["queries"], width)[asked], _matrix(row["matrix"], width))
                other = query_ids[:, None] != ids
                scores[~other] = _LOWEST
                # Ids are in order, so a stable sort leaves ties to the smaller one.
                best = np.argsort(np.invert(scores), axis=1, kind="stable")[:, :k]
                lane = np.repeat(np.arange(len(asked)), best.shape[1])
                place = best.reshape(-1)
                real = other[lane, place]
                lane, place = lane[real], place[real]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lane), row["query_block"])),
                        pa.array(asked[lane]),
                        pa.array(query_ids[lane]),
                        pa.array(ids[place]),
                        pa.array(scores[lane, place]),
                    ],
                    ["query_block", "query", "query_id", "vec_id", "score"],
                )

    asked = pairs.groupBy("query_block", "block").agg(F.collect_set("query").alias("asked"))
    side = queries.select("query_block", F.col("ids").alias("query_ids"), F.col("matrix").alias("queries"))
    met = asked.join(side, "query_block").join(blocks.select("block", "ids", "matrix"), "block")
    schema = "query_block long, query int, query_id long, vec_id long, score long"
    return met.mapInArrow(score, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_block", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` the ``k`` highest scores, ties to the smaller id."""
    small_batches(vectors.sparkSession)
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector))).select(
        F.col(id_col).cast("long").alias("vec_id"),
        whole_numbers(F.col(vector)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = settle(rows, "vectors")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, width)
    blocks = _in_blocks(rows.select("vec_id", "vector"), BLOCK_ROWS, width, "vectors")
    asking = rows.filter("asks").select("vec_id", "vector")
    queries = _in_blocks(asking, QUERY_ROWS, width, "queries").select(
        F.col("block").alias("query_block"), "ids", "matrix"
    )
    bundle = F.floor(F.col("block") / BUNDLE_BLOCKS).alias("bundle")
    bundles = settle(
        blocks.groupBy(bundle).agg(F.collect_list(F.struct("block", "most", "least")).alias("entries")),
        "block-extremes",
    )
    n_bundles = max(1, bundles.count())

    found = pairs_done = None
    had = 0
    for first in (*FIRST_BLOCKS, None):
        if found is None:
            limits = queries.withColumn("thresholds", F.lit(None).cast("array<struct<query: int, score: long>>"))
        else:
            kth = found.filter(F.col("rank") == k).groupBy("query_block")
            known = kth.agg(F.collect_list(F.struct("query", "score")).alias("thresholds"))
            limits = queries.join(known, "query_block", "left")
        # Those that a query has had already may be among a bundle's best.
        best = None if first is None else first + had
        had += first or 0
        pairs = _open_blocks(bundles, limits, n_bundles, width, best)
        if pairs_done is not None:
            pairs = pairs.join(pairs_done, ["query_block", "query", "block"], "left_anti")
        if first is not None:
            order = W.partitionBy("query_block", "query").orderBy(F.desc("bound"), "block")
            pairs = pairs.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= first)
        pairs = settle(pairs.select("query_block", "query", "block"), "block-pairs")
        scored = _scored(pairs, queries, blocks, k, width)
        if found is not None:
            scored = found.drop("rank").unionByName(scored)
            pairs_done = pairs_done.unionByName(pairs)
        else:
            pairs_done = pairs
        found = settle(_best(scored, k), "best-scores")
    return found.select("query_id", "rank", "vec_id", "score")
