"""Packing of token sequences into as few fixed-length sequences as possible.

Only the lengths matter for the plan, and there are at most ``capacity`` of
them: the plan is made from their counts, which is bounded whatever the number
of documents. It first fixes sets that dominate all alternatives (Martello and
Toth): pieces that nothing fits with, pairs that fill a sequence, and pairs
with the largest partner where only one more piece fits. What is left goes, in
falling order, to the fullest sequence that has room (best fit). A plan is a
list of runs: pieces of one length, numbered in a fixed order, to consecutive
sequences at one place. Pieces are numbered by a distributed sort and look up
their run.

Defined cases: null text counts as empty, and an empty document is its end
token alone; null ids sort first; rows that repeat are pieces of their own;
texts of any length are cut into pieces; an empty table gives no rows;
columns that the result adds replace columns of that name.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import numbered, settle, small_batches, uncommon
from siftmine.llm.vocabulary import BYTE_BPE, fast_encoder, plain_encoder

CAPACITY = 1024
END_ID = 2
#: Pieces of so many ids in all are handed on at once.
BATCH_IDS = 1_000_000

LONG_RUN = re.compile(r"\s{10000}")

Pattern = tuple[int, ...]


def token_ids(text: str, vocabulary: str = BYTE_BPE) -> np.ndarray:
    """Ids of a text, special tokens in it included."""
    if LONG_RUN.search(text):
        # Splitting such runs is too deep for the fast library.
        ids = plain_encoder(vocabulary).encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=np.uint32)
    return fast_encoder(vocabulary).encode_to_numpy(text, allowed_special="all")


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str = BYTE_BPE,
) -> DataFrame:
    """(id, piece, start, length, ids): every text's ids and the end id, cut where longer than ``capacity``.

    The first piece of a cut text takes the remainder, so all others are full.
    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, number, starts, lengths, found, total = [], [], [], [], [], 0
            owner_column = batch.column(0)

            def flush() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [
                        owner_column.take(pa.array(owners, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(found, pa.binary()),
                    ],
                    [id_col, "piece", "start", "length", "ids"],
                )

            for row, value in enumerate(batch.column(1)):
                value = value.as_py()
                ids = token_ids(value, vocabulary) if value else np.empty(0, np.uint32)
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    owners.append(row)
                    number.append(n)
                    starts.append(a)
                    lengths.append(b - a)
                    found.append(ids[a:b].tobytes())
                    total += b - a
                    if total >= BATCH_IDS:
                        yield flush()
                        owners, number, starts, lengths, found, total = [], [], [], [], [], 0
            if owners:
                yield flush()

    schema = f"`{id_col}` {id_type}, piece int, start long, length long, ids binary"
    return docs.select(id_col, text).mapInArrow(pieces, schema)


def _fix_dominant(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Sets that some best packing has; their pieces are taken from ``counts``."""
    fixed: list[tuple[Pattern, int]] = []

    def take(pattern: Pattern, times: int) -> None:
        fixed.append((pattern, times))
        for size in set(pattern):
            counts[size] -= times * pattern.count(size)
            if not counts[size]:
                del counts[size]
                left.remove(size)

    left = sorted(counts)
    for size in sorted(counts, reverse=True):
        if size not in counts:
            continue
        # Whatever else would join this piece fits into the room that its partner fills.
        room = capacity - size
        if room == 0:
            take((size,), counts[size])
        elif room == size and counts[size] > 1:
            take((size, size), counts[size] // 2)
        elif room != size and room in counts:
            take((size, room), min(counts[size], counts[room]))
    for size in sorted(counts, reverse=True):
        while size in counts:
            room = capacity - size
            own = counts[size] - 1
            fitting = [other for other in left[: bisect.bisect_right(left, room)] if other != size or own]
            if not fitting:
                take((size,), counts[size])
                continue
            smallest = fitting[0]
            copies = counts[smallest] - (smallest == size)
            second = smallest if copies > 1 else next(iter(fitting[1:]), capacity)
            if smallest + second <= room:
                break
            partner = fitting[-1]
            # Only one more piece fits: the largest one.
            times = counts[size] // 2 if partner == size else min(counts[size], counts[partner])
            take((size, partner), max(1, times) if partner != size or counts[size] > 1 else 1)
        if size in counts:
            break
    return fixed


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Falling sizes, each to the fullest open sequences with room; equal sequences are filled together."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, times: int) -> None:
        if times:
            if room not in open_:
                bisect.insort(rooms, room)
                open_[room] = []
            open_[room].append((pattern, times))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, pattern, times = capacity, (), n
            each = room // size
            full = min(times, n // each)
            put(room - each * size, (*pattern, *[size] * each), full)
            n -= full * each
            if full < times and n:
                put(room - n * size, (*pattern, *[size] * n), 1)
                n, full = 0, full + 1
            if pattern:
                put(room, pattern, times - full)
    return [entry for entries in open_.values() for entry in entries]


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """(lengths in a sequence, how many such sequences) for all pieces of the counted lengths."""
    if any(size < 1 or size > capacity for size in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    rest = {size: n for size, n in counts.items() if n}
    fixed = _fix_dominant(rest, capacity)
    return fixed + _best_fit(rest, capacity)


def _runs(plan: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """By length: the number of its first piece, the first sequence and the place, for each run."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for size in pattern:
            runs.setdefault(size, []).append((used.get(size, 0), sequence, offset))
            used[size] = used.get(size, 0) + times
            offset += size
        sequence += times
    return {size: np.array(found, dtype=np.int64) for size, found in runs.items()}


def pack(
    pieces: DataFrame, order_by: list[str], length: str = "length", capacity: int = CAPACITY
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, the place in the sequence.

    ``order_by`` orders pieces of one length; ``length`` is from 1 to ``capacity``.
    """
    small_batches(pieces.sparkSession)
    row = uncommon("row", pieces)
    pieces = settle(
        pieces.drop("sequence_id", "offset").withColumn(row, F.monotonically_increasing_id()), "pieces"
    )
    # One row for each length up to the capacity.
    counted = pieces.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {line[0]: line[1] for line in counted}
    runs = _runs(packing_plan(counts, capacity))
    sizes = sorted(counts)
    before = dict(zip(sizes, [0, *accumulate(counts[size] for size in sizes)]))

    @F.arrow_udf("sequence_id long, offset long")
    def place(lengths: pa.Array, index: pa.Array) -> pa.Array:
        lengths, index = lengths.to_numpy(zero_copy_only=False), index.to_numpy(zero_copy_only=False)
        sequence, offset = np.empty(len(index), np.int64), np.empty(len(index), np.int64)
        for size in np.unique(lengths):
            own, run = lengths == size, runs[size]
            number = index[own] - before[size]
            at = np.searchsorted(run[:, 0], number, "right") - 1
            sequence[own] = run[at, 1] + number - run[at, 0]
            offset[own] = run[at, 2]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    # Lengths and orders are sorted alone; what a piece carries moves once, to its place.
    index, placed = uncommon("index", pieces), uncommon("placed", pieces)
    narrow = pieces.select(row, *dict.fromkeys([length, *order_by]))
    places = (
        numbered(narrow, [length, *order_by], index, "numbered-pieces")
        .withColumn(placed, place(length, index))
        .select(row, f"{placed}.sequence_id", f"{placed}.offset")
    )
    return pieces.join(places, row).drop(row)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids, sequence_id, offset) for all texts."""
    return pack(token_pieces(docs, id_col, text), [id_col, "piece"])
