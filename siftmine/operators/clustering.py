"""K-Means by explicit steps, the MLlib estimators, and cluster reports.

Feature columns hold number arrays or ``pyspark.ml`` vectors. Centroids live on
the driver, and go to the tasks, without the coordinates that are 0 in all of them.

Deviations from the usual classroom form: documents are assigned on the same
features as the fit used, exactly ``iters`` updates run, an empty cluster
keeps its centroid, the cost is the sum of squared distances, and terms are
joined to clusters by the cluster's id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, Vector, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siftmine.session import small_batches

_COUNT, _COST = -1, -2  # coordinates under which partial sums carry size and cost
#: Numbers that a packed block of rows holds at most, unless one row has more.
BLOCK_NUMBERS = 500_000
#: Partial sums that a task gathers before it adds up those of one coordinate; up to twice as many cells are one table.
TASK_SUMS = 4_000_000
#: Rows that are assigned to their centres at a time.
SLICE_ROWS = 1_000
#: Sums of 2 to this power cells (coordinate, cluster) travel in one row.
SLICE_BITS = 16
_SUMS = [("slice", pa.int64()), ("cells", pa.binary()), ("sums", pa.binary())]
#: Coordinates up to which a table of places takes the place of a search.
PLACES = 2**22


class _Block:
    """Feature vectors of one Arrow batch, dense or in compressed sparse rows."""

    def __init__(self, column: pa.Array):
        self.n = len(column)
        self.dense = None
        if not pa.types.is_struct(column.type):
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            self.dense = values.reshape(self.n, -1) if self.n else values.reshape(0, 0)
            return
        kind, _, indices, values = column.flatten()
        kinds = kind.to_numpy(zero_copy_only=False)
        flat = values.flatten().to_numpy(zero_copy_only=False)
        if (kinds == 1).all():
            self.dense = flat.reshape(self.n, -1) if self.n else flat.reshape(0, 0)
            return
        lengths = np.asarray(values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        self.rows = np.repeat(np.arange(self.n), lengths)
        self.values = flat
        if (kinds == 0).all():
            self.columns = indices.flatten().to_numpy(zero_copy_only=False)
        else:
            sparse = indices.to_pylist()
            parts = [
                np.arange(lengths[i]) if kinds[i] == 1 else np.asarray(sparse[i], dtype=np.int64)
                for i in range(self.n)
            ]
            self.columns = np.concatenate(parts)

    def distances(self, centres: Centroids) -> np.ndarray:
        """Squared distance of every row to every centre, n x k."""
        out = np.empty((self.n, centres.k))
        if self.dense is not None:
            for j, centre in enumerate(centres.rows(self.dense.shape[1])):
                gap = self.dense - centre
                out[:, j] = np.einsum("ij,ij->i", gap, gap)
            return out
        square = np.bincount(self.rows, self.values * self.values, self.n)
        rows, values, places = centres.meet(self.rows, self.values, self.columns)
        for j, centre in enumerate(centres.filled):
            dot = np.bincount(rows, values * centre[places], self.n)
            out[:, j] = np.maximum(square - 2 * dot + centre @ centre, 0.0)
        return out

    def sums(self, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cluster, coordinate, sum of the rows with that label) where the sum is not 0."""
        if self.dense is not None:
            total = np.stack([self.dense[labels == j].sum(axis=0) for j in range(k)])
            cluster, index = np.nonzero(total)
            return cluster, index, total[cluster, index]
        width = int(self.columns.max(initial=0)) + 1
        cell = labels[self.rows].astype(np.int64) * width + self.columns
        cells, inverse = np.unique(cell, return_inverse=True)
        return cells // width, cells % width, np.bincount(inverse, self.values, len(cells))


class Centroids:
    """k centroids of d coordinates, without the coordinates that are 0 in all of them."""

    def __init__(self, k: int, d: int, active: np.ndarray, filled: np.ndarray):
        self.k, self.d, self.active, self.filled = k, d, active, filled

    @classmethod
    def of(cls, centroids) -> Centroids:
        """From rows of numbers or vectors, or centroids as they are."""
        if isinstance(centroids, Centroids):
            return centroids
        rows = list(centroids)
        d = max(len(row) for row in rows)
        cells = [cls._cells(row) for row in rows]
        active = np.unique(np.concatenate([index for index, _ in cells]))
        filled = np.zeros((len(rows), len(active)))
        for j, (index, values) in enumerate(cells):
            filled[j, np.searchsorted(active, index)] = values
        return cls(len(rows), d, active, filled)

    @staticmethod
    def _cells(row) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(row, SparseVector):
            return row.indices[row.values != 0], row.values[row.values != 0]
        values = np.asarray(row.toArray() if isinstance(row, Vector) else row, dtype=np.float64)
        index = np.flatnonzero(values)
        return index, values[index]

    def rows(self, d: int) -> np.ndarray:
        full = np.zeros((self.k, d))
        full[:, self.active] = self.filled
        return full

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        return self.rows(self.d).astype(dtype or np.float64, copy=False)

    def meet(
        self, rows: np.ndarray, values: np.ndarray, columns: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries in active coordinates, with the place of the coordinate."""
        if not len(self.active):
            return rows[:0], values[:0], columns[:0]
        if self.d <= PLACES:
            table = np.full(max(self.d, int(columns.max(initial=-1)) + 1), -1, np.int32)
            table[self.active] = np.arange(len(self.active))
            place = table[columns]
            hit = place >= 0
        else:
            place = np.minimum(np.searchsorted(self.active, columns), len(self.active) - 1)
            hit = self.active[place] == columns
        return rows[hit], values[hit], place[hit]

    def moved(
        self, sizes: np.ndarray, cluster: np.ndarray, index: np.ndarray, total: np.ndarray
    ) -> tuple[Centroids, float]:
        """The means from sizes and sums (cluster, coordinate, total), and the largest squared move.

        An empty cluster stays where it is.
        """
        active = np.union1d(self.active, index).astype(np.int64)
        before = np.zeros((self.k, len(active)))
        before[:, np.searchsorted(active, self.active)] = self.filled
        sums = np.zeros_like(before)
        sums[cluster, np.searchsorted(active, index)] = total
        after = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], before)
        shift = float(((after - before) ** 2).sum(axis=1).max())
        used = after.any(axis=0)
        return Centroids(self.k, self.d, active[used], np.ascontiguousarray(after[:, used])), shift


def _nearest(block: _Block, centres: Centroids, decimals: int) -> tuple[np.ndarray, np.ndarray]:
    distance = block.distances(centres)
    # Rounding makes ties independent of the order of summation; the lowest index wins.
    label = np.round(distance, decimals).argmin(axis=1)
    return label, distance[np.arange(block.n), label]


def kmeans_assign(
    df: DataFrame, centroids, features: str = "features", decimals: int = 9
) -> DataFrame:
    """Add ``cluster`` and ``sqdist``: the nearest centroid and the squared distance to it."""
    small_batches(df.sparkSession)
    centres = Centroids.of(centroids)

    @F.arrow_udf("cluster int, sqdist double")
    def nearest(column: pa.Array) -> pa.Array:
        # In few rows at a time, as the distances take several times their size.
        slices = [column.slice(i, SLICE_ROWS) for i in range(0, len(column), SLICE_ROWS)] or [column]
        found = [_nearest(_Block(part), centres, decimals) for part in slices]
        label, distance = (np.concatenate([pair[i] for pair in found]) for i in (0, 1))
        return pa.StructArray.from_arrays(
            [pa.array(label, pa.int32()), pa.array(distance, pa.float64())], ["cluster", "sqdist"]
        )

    return (
        df.withColumn("_nearest", nearest(features))
        .withColumn("cluster", F.col("_nearest.cluster"))
        .withColumn("sqdist", F.col("_nearest.sqdist"))
        .drop("_nearest")
    )


def distance_to_cluster(
    df: DataFrame, centroids, features: str = "features", cluster: str = "cluster"
) -> DataFrame:
    """Add ``sqdist`` to the centroid of the cluster a row already has."""
    centres = Centroids.of(centroids)

    @F.arrow_udf("double")
    def distance(column: pa.Array, label: pa.Array) -> pa.Array:
        block = _Block(column)
        own = label.to_numpy(zero_copy_only=False)
        return pa.array(block.distances(centres)[np.arange(block.n), own], pa.float64())

    return df.withColumn("sqdist", distance(features, cluster))


def kmeans_seed(
    df: DataFrame, id_col: str, k: int, seed: int, features: str = "features"
) -> DataFrame:
    """(cluster, id, features): ``k`` rows with different features, at random but repeatable.

    Rows are ranked by a hash of their id. Each pass takes the best few rows and
    leaves out features it has seen, so copies cost a pass but no shuffle of the data.
    """
    spark = df.sparkSession
    key = F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed))))
    ranked = df.select(F.col(id_col).alias("id"), F.col(features), key.alias("_key"))
    chosen: dict[Vector | tuple, tuple] = {}
    rest = ranked
    while len(chosen) < k:
        best = rest.orderBy("_key", "id").limit(4 * k).collect()
        for row in best:
            value = row[features]
            value = value if isinstance(value, Vector) else tuple(value)
            if value not in chosen and len(chosen) < k:
                chosen[value] = (len(chosen), row["id"], row[features])
        if len(best) < 4 * k:
            break
        # At most k rows.
        found = spark.createDataFrame(
            [(row[2],) for row in chosen.values()], df.select(features).schema
        )
        rest = ranked.join(F.broadcast(found), features, "left_anti")
    schema = df.select(
        F.lit(0).alias("cluster"), F.col(id_col).alias("id"), F.col(features)
    ).schema
    return spark.createDataFrame(list(chosen.values()), schema)


def centroid_array(rows: DataFrame, features: str = "features") -> np.ndarray:
    """Centroid rows (cluster, features) as a k x d array."""
    ordered = sorted(rows.select("cluster", features).collect(), key=lambda row: row[0])
    return np.array(
        [row[1].toArray() if isinstance(row[1], Vector) else row[1] for row in ordered]
    )


def kmeans_update(assigned: DataFrame, centroids, features: str = "features") -> DataFrame:
    """(cluster, n, centroid): the mean of each cluster; an empty one keeps its centroid."""
    centres = np.asarray(centroids, dtype=np.float64)
    is_vector = isinstance(assigned.schema[features].dataType, VectorUDT)
    vector: Column = F.col(features) if is_vector else array_to_vector(F.col(features))
    means = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(vector)).alias("_mean")
    )
    old = assigned.sparkSession.createDataFrame(
        [(j, centre.tolist()) for j, centre in enumerate(centres)],
        "cluster int, _old array<double>",
    )
    return old.join(means, "cluster", "left").select(
        "cluster",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("_mean", "_old").alias("centroid"),
    )


def _packed(df: DataFrame, features: str) -> DataFrame:
    """(n, width, sizes, coordinates, places, numbers): the rows in blocks that every step reads as they are.

    Sparse rows have sizes, the block's coordinates, and the place of each number's coordinate among them.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _Block(batch.column(0))
            if not block.n:
                continue
            if block.dense is not None:
                each = np.full(block.n, block.dense.shape[1])
            else:
                each = np.bincount(block.rows, minlength=block.n)
            ends = np.cumsum(each)
            first = 0
            while first < block.n:
                before = ends[first] - each[first]
                last = max(first + 1, int(np.searchsorted(ends, before + BLOCK_NUMBERS, "right")))
                if block.dense is not None:
                    cells = [[], np.empty(0), np.empty(0), block.dense[first:last].astype(np.float64).reshape(-1)]
                else:
                    columns, places = np.unique(block.columns[before : ends[last - 1]], return_inverse=True)
                    cells = [each[first:last], columns, places, block.values[before : ends[last - 1]]]
                kinds = (np.int32, np.int64, np.int32, np.float64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([last - first], pa.int32()),
                        pa.array([block.dense.shape[1] if block.dense is not None else -1], pa.int32()),
                        *[pa.array([np.asarray(c, k).tobytes()], pa.binary()) for c, k in zip(cells, kinds)],
                    ],
                    ["n", "width", "sizes", "coordinates", "places", "numbers"],
                )
                first = last

    schema = "n int, width int, sizes binary, coordinates binary, places binary, numbers binary"
    return df.select(features).mapInArrow(packed, schema)


class _PackedBlock(_Block):
    """A block as ``_packed`` writes it."""

    def __init__(self, row: dict):
        self.n = row["n"]
        self.values = np.frombuffer(row["numbers"], np.float64)
        self.dense = self.values.reshape(self.n, -1) if row["width"] >= 0 else None
        self.rows = np.repeat(np.arange(self.n), np.frombuffer(row["sizes"], np.int32)) if self.dense is None else None
        self.coordinates = np.frombuffer(row["coordinates"], np.int64)
        self.places = np.frombuffer(row["places"], np.int32)

    def distances(self, centres: Centroids) -> np.ndarray:
        if self.dense is not None:
            return super().distances(centres)
        out = np.empty((self.n, centres.k))
        square = np.bincount(self.rows, self.values * self.values, self.n)
        here = np.zeros((centres.k, len(self.coordinates)))
        found, _, places = centres.meet(np.arange(len(self.coordinates)), self.coordinates, self.coordinates)
        here[:, found] = centres.filled[:, places]
        for j, centre in enumerate(centres.filled):
            dot = np.bincount(self.rows, self.values * here[j][self.places], self.n)
            out[:, j] = np.maximum(square - 2 * dot + centre @ centre, 0.0)
        return out

    def sums(self, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.dense is not None:
            return super().sums(labels, k)
        width = max(1, len(self.coordinates))
        total = np.bincount(labels[self.rows].astype(np.int64) * width + self.places, self.values, k * width)
        cells = np.flatnonzero(total)
        return cells // width, self.coordinates[cells % width], total[cells]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row the numbers, and the bytes where they lie."""
    for batch in batches:
        for i in range(batch.num_rows):
            cells = {name: batch.column(name)[i] for name in batch.schema.names}
            yield {n: c.as_buffer() if isinstance(c, pa.BinaryScalar) else c.as_py() for n, c in cells.items()}


class _Sums:
    """Sums by cell, a number from 0 to ``n`` - 1: one table where it is small, else gathered and added up."""

    def __init__(self, n: int):
        self.table = np.zeros(n) if n <= 2 * TASK_SUMS else None
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.least = 0

    def add(self, cells: np.ndarray, values: np.ndarray) -> None:
        """``cells`` has no cell twice."""
        if self.table is not None:
            self.table[cells] += values
            return
        self.held.append((cells, values))
        self.size += len(cells)
        # What stays after adding up counts once more before the next time.
        if self.size > TASK_SUMS + self.least:
            self.held = [self.total()]
            self.size = self.least = len(self.held[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """The cells in order with their sums."""
        if self.table is not None:
            cells = np.flatnonzero(self.table)
            return cells, self.table[cells]
        if not self.held:
            return np.empty(0, np.int64), np.empty(0)
        cells, places = np.unique(np.concatenate([part[0] for part in self.held]), return_inverse=True)
        return cells, np.bincount(places, np.concatenate([part[1] for part in self.held]), len(cells))


def _step(data: DataFrame, centres: Centroids, decimals: int) -> tuple[Centroids, float, float]:
    """One assignment and update in a single pass over packed blocks; tasks hand on sums, not rows.

    Gives the new centroids, the largest squared move and the cost before.
    """
    k = centres.k

    def sliced(sums: _Sums) -> Iterator[pa.RecordBatch]:
        cells, s = sums.total()
        slices, starts = np.unique(cells >> SLICE_BITS, return_index=True)
        ends = [*starts[1:], len(cells)]
        for number, i, j in zip(slices, starts, ends):
            row = {"slice": [int(number)], "cells": [cells[i:j].tobytes()], "sums": [s[i:j].tobytes()]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema(_SUMS))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums((centres.d - _COST) * k)
        every = np.arange(k)
        for row in _cells(batches):
            block = _PackedBlock(row)
            label, distance = _nearest(block, centres, decimals)
            cluster, index, total = block.sums(label, k)
            sums.add((index.astype(np.int64) - _COST) * k + cluster, total)
            for place, figure in ((_COUNT, np.bincount(label, minlength=k)), (_COST, np.bincount(label, distance, k))):
                sums.add((place - _COST) * k + every, figure.astype(np.float64))
        yield from sliced(sums)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, _Sums] = {}
        for row in _cells(batches):
            number = row["slice"]
            sums = slices.setdefault(number, _Sums(1 << SLICE_BITS))
            sums.add(np.frombuffer(row["cells"], np.int64) - (number << SLICE_BITS), np.frombuffer(row["sums"], np.float64))
        for number, sums in slices.items():
            cells, s = sums.total()
            row = {"slice": [number], "cells": [(cells + (number << SLICE_BITS)).tobytes()], "sums": [s.tobytes()]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema(_SUMS))

    schema = "slice long, cells binary, sums binary"
    parts = data.mapInArrow(partial, schema).repartition("slice").mapInArrow(together, schema)
    # The sums of the coordinates that occur, the size of the centroids.
    summed = parts.toArrow()
    cells = np.frombuffer(b"".join(summed.column("cells").to_pylist()), np.int64)
    s = np.frombuffer(b"".join(summed.column("sums").to_pylist()), np.float64)
    cluster, index = cells % k, cells // k + _COST
    sizes = np.zeros(k)
    sizes[cluster[index == _COUNT]] = s[index == _COUNT]
    cell = index >= 0
    moved, shift = centres.moved(sizes, cluster[cell], index[cell], s[cell])
    return moved, shift, float(s[index == _COST].sum())


def kmeans_lloyd(
    df: DataFrame,
    k: int,
    iters: int,
    seed: int,
    id_col: str,
    features: str = "features",
    tol: float = 0.0,
    decimals: int = 9,
) -> tuple[Centroids, list[float]]:
    """Centroids after ``iters`` updates and the cost before each of them.

    Stops early once no centroid moves by more than ``tol``, if ``tol`` is positive.
    """
    small_batches(df.sparkSession)
    seeds = kmeans_seed(df.select(id_col, features), id_col, k, seed, features).select("cluster", features).collect()
    # On disk: the executors' memory stays free for the steps.
    data = _packed(df, features).persist(StorageLevel.DISK_ONLY)
    try:
        centres = Centroids.of(row[features] for row in sorted(seeds, key=lambda row: row["cluster"]))
        costs: list[float] = []
        for _ in range(iters):
            centres, shift, cost = _step(data, centres, decimals)
            costs.append(cost)
            if tol > 0 and shift <= tol * tol:
                break
        return centres, costs
    finally:
        data.unpersist()


def _fit_predict(estimator, df: DataFrame, features: str) -> DataFrame:
    is_vector = isinstance(df.schema[features].dataType, VectorUDT)
    vector = F.col(features) if is_vector else array_to_vector(F.col(features))
    df = df.withColumn("_vector", vector)
    model = estimator.setFeaturesCol("_vector").setPredictionCol("cluster").fit(df)
    assigned = distance_to_cluster(model.transform(df), model.clusterCenters(), "_vector")
    return assigned.drop("_vector")


def kmeans(
    df: DataFrame, k: int, iters: int, seed: int = 42, features: str = "features"
) -> DataFrame:
    """Add ``cluster`` and ``sqdist`` by MLlib's K-Means."""
    return _fit_predict(KMeans(k=k, maxIter=iters, seed=seed), df, features)


def bisecting_kmeans(
    df: DataFrame, k: int, iters: int, seed: int = 42, features: str = "features"
) -> DataFrame:
    """Add ``cluster`` and ``sqdist`` by MLlib's bisecting K-Means."""
    return _fit_predict(BisectingKMeans(k=k, maxIter=iters, seed=seed), df, features)


def cluster_summary(assigned: DataFrame) -> DataFrame:
    """(cluster, size, error): rows and sum of squared distances per cluster."""
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.sum("sqdist").alias("error")
    )


def cluster_terms(docs: DataFrame, cluster_col: str = "cluster", n: int = 10) -> DataFrame:
    """(cluster, rank, term, n): the most frequent ``tokens`` of each cluster, ties by term.

    The limit per cluster is applied within every task before the clusters are
    brought together.
    """
    counts = (
        docs.select(F.col(cluster_col).alias("cluster"), F.explode("tokens").alias("term"))
        .groupBy("cluster", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = W.partitionBy("cluster").orderBy(F.desc("n"), F.asc("term"))
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("cluster", "rank", "term", "n")
    )


def cluster_report(summary: DataFrame, terms: DataFrame, algorithm: str) -> DataFrame:
    """One row: algorithm, wsse and the clusters with size, error and top terms.

    Holds one entry per cluster and at most the reported terms of each.
    """
    listed = terms.groupBy("cluster").agg(
        F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_ranked")
    )
    entry = F.struct(
        F.col("cluster").alias("id"),
        F.col("size"),
        F.col("error"),
        F.coalesce(F.col("_ranked.term"), F.array().cast("array<string>")).alias("terms"),
    )
    return (
        summary.join(listed, "cluster", "left")
        .agg(
            F.sum("error").alias("wsse"),
            F.array_sort(F.collect_list(entry)).alias("clusters"),
        )
        .select(F.lit(algorithm).alias("algorithm"), "wsse", "clusters")
    )
