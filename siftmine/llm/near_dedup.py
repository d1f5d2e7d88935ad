"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

Documents are sets of word shingles; two are linked if their Jaccard similarity
reaches the threshold, and a component of linked documents keeps its smallest
id.

1. Every text gives its shingle set's digest, band keys and a signature of one
   byte per hash function. Equal sets are one class from here on.
2. Documents with a band key in common are candidates. Buckets are compared
   in tiles of bounded size: signatures batch by batch, and a pair is given up
   as soon as the posterior probability that it is similar enough falls below
   the chosen miss probability.
3. First only the most similar pairs that span each tile are verified on full
   sets. Then, where a bucket still holds several components, all its pairs
   across components that survive the comparison are verified within their
   tile. So a large group hands on a few links for each member and not all its
   pairs, but no link is left out that could join two components.

Defined cases: a text with fewer words than a shingle is one shingle; a text
that is null, empty or white space only has no shingles and is linked with
nothing; so is a row with a null id, which is kept; rows that repeat an id are
looked at one by one, and rows that also repeat the text all get its figures;
words of any length and texts of any length are read whole; an empty table
gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import join_figures, settle, small_batches, uncommon
from siftmine.llm.components import components

SHINGLE_WORDS = 5
#: Similar means 100 * intersection >= PERCENT * union.
PERCENT = 75
#: At the threshold a pair shares no band with probability (1 - 0.75**4)**32, or 5e-6.
BANDS, ROWS = 32, 4
#: Hash functions of the signature, one byte each, and how many are compared at a time.
HASHES, BATCH = 256, 64
#: Probability with which a similar pair may be given up by the comparison.
MISS = 1e-5
#: Members of a bucket that are compared with each other in one tile.
TILE = 1024
#: Shingles of the members of a tile of the second round, about (16 MB).
TILE_SHINGLES = 2_000_000
#: Bytes of text that are split into words at once.
SLICE_BYTES = 4_000_000
#: So many ids (8 MB) are sent to every task; more are joined.
BROADCAST_IDS = 1_000_000

_RANDOM = np.random.default_rng(20240607)
_PLACES = _RANDOM.integers(1 << 63, size=SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RANDOM.integers(1 << 31, size=HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND_SALTS = _RANDOM.integers(1 << 63, size=BANDS, dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values *= np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of every word, A-Z lower-cased; words are split at ASCII white space."""
    import xxhash

    raw = text.encode("utf-8", "surrogatepass").lower()
    parts, at = [], 0
    while at < len(raw):
        end = at + SLICE_BYTES
        while end < len(raw) and not raw[end : end + 1].isspace():
            end += 1
        words = raw[at:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words; of the whole, if it is shorter."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    width = min(SHINGLE_WORDS, len(words))
    n = len(words) - width + 1
    hashed = np.full(n, width, dtype=np.uint64)
    for place in range(width):
        hashed += words[place : place + n] * _PLACES[place]
    return np.unique(_mixed(hashed))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set that is not empty."""
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(shingles), 256):
        hashed = low[at : at + 256, None] * _FACTORS
        hashed += high[at : at + 256, None]
        np.minimum(least, hashed.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band of each row of minima, different between bands."""
    pairs = np.ascontiguousarray(least[:, : BANDS * ROWS]).view(np.uint64).reshape(len(least), BANDS, ROWS // 2)
    keys = np.broadcast_to(_BAND_SALTS, pairs.shape[:2])
    for place in range(ROWS // 2):
        keys = _mixed(keys + pairs[:, :, place])
    return keys.view(np.int64)


@lru_cache(maxsize=4)
def least_matches(percent: int = PERCENT, miss: float = MISS) -> tuple[int, ...]:
    """Matches that a pair must have after each batch.

    With fewer, a uniform prior on the share of equal bytes gives the pair a
    probability below ``miss`` of being similar. Bytes of different minima are
    equal once in 256.
    """
    share = np.linspace(0, 1, 200_001)[1:-1]
    similar = share >= (lambda s: s + (1 - s) / 256)(percent / 100)
    bounds = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for matches in range(n + 1):
            logs = matches * np.log(share) + (n - matches) * np.log1p(-share)
            weight = np.exp(logs - logs.max())
            if weight[similar].sum() >= miss * weight.sum():
                break
        bounds.append(matches)
    return tuple(bounds)


def compared(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the surviving pairs, their matches); the sides broadcast against each other."""
    alive, matches = None, None
    for at, bound in zip(range(0, HASHES, BATCH), least_matches()):
        a, b = left[..., at : at + BATCH], right[..., at : at + BATCH]
        if alive is not None:
            a = a[alive] if len(left) > 1 else a
            b = b[alive] if len(right) > 1 else b
        equal = (a == b).sum(axis=-1, dtype=np.int32)
        matches = equal if matches is None else matches + equal
        keep = matches >= bound
        alive = np.flatnonzero(keep) if alive is None else alive[keep]
        matches = matches[keep]
        if not len(alive):
            break
    return alive, matches


def _described(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, signature) of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, found = [], [], []
            for value in batch.column(1):
                shingles = shingle_set(value.as_py())
                sizes.append(len(shingles))
                full = len(shingles) > 0
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if full else None)
                found.append(minima(shingles) if full else np.zeros(HASHES, np.uint32))
            if not sizes:
                continue
            least = np.array(found, dtype=np.uint32)
            empty = pa.array([size == 0 for size in sizes])
            keys = pa.array(band_keys(least).reshape(-1))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS), keys)
            # The lowest byte; the highest of a minimum over many shingles is mostly zero.
            signs = pa.array([row.tobytes() for row in (least & np.uint32(0xFF)).astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.compute.if_else(empty, pa.scalar(None, bands.type), bands),
                    pa.compute.if_else(empty, pa.scalar(None, pa.binary()), signs),
                ],
                ["doc_id", "n_shingles", "digest", "bands", "signature"],
            )

    schema = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"
    return docs.select(F.col(id_col).cast("long"), text).mapInArrow(describe, schema)


def _sets_of(docs: DataFrame, ids: DataFrame, id_col: str, text: str) -> DataFrame:
    """(node, shingles) of the texts whose id is in ``ids`` (node)."""
    named = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text).alias("_text"))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(text).tobytes() for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    return named.join(ids, "node", "left_semi").mapInArrow(shingles, "node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar by their full sets."""
    left = sets.withColumnsRenamed({"node": "a", "shingles": "_left"})
    right = sets.withColumnsRenamed({"node": "b", "shingles": "_right"})

    @F.arrow_udf("boolean")
    def similar(ones: pa.Array, others: pa.Array) -> pa.Array:
        out = []
        for one, other in zip(ones, others):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, other))
            # Sizes alone may rule a pair out.
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                out.append(False)
                continue
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())

    met = pairs.join(right, "b").join(left, "a")
    return met.filter(similar("_left", "_right")).select("a", "b").distinct()


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches of whole groups from rows that are sorted by their first columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
        changes = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            changes[1:] |= key[1:] != key[:-1]
        if held:
            last = held[-1]
            changes[0] = any(
                last.column(i)[last.num_rows - 1].as_py() != batch.column(i)[0].as_py() for i in range(n_keys)
            )
        cuts = np.flatnonzero(changes)
        if not len(cuts):
            held.append(batch)
            continue
        done = [*held, batch.slice(0, cuts[-1])] if cuts[-1] else held
        if done:
            yield done
        held = [batch.slice(cuts[-1])]
    if held:
        yield held


def _spanning(count: int, ones: np.ndarray, others: np.ndarray, matches: np.ndarray) -> list[int]:
    """The pairs of a spanning forest that takes the most similar pairs first."""
    root = list(range(count))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    taken = []
    for pair in np.argsort(-matches, kind="stable").tolist():
        a, b = find(int(ones[pair])), find(int(others[pair]))
        if a != b:
            root[a] = b
            taken.append(pair)
            if len(taken) == count - 1:
                break
    return taken


def _in_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """(rows, where tiles start, how many rows they have) of whole tiles (key, tile, …)."""
    for group in _groups(batches, 2):
        table = pa.Table.from_batches(group).combine_chunks()
        key, tile = table.column(0).to_numpy(), table.column(1).to_numpy()
        starts = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1
        starts = np.concatenate([[0], starts])
        yield table, starts, np.diff(np.append(starts, len(key)))


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)


def _as_pairs(node: np.ndarray, ones: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(node[ones], node[others]), np.maximum(node[ones], node[others])
    return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])


def _spanning_pairs(members: DataFrame) -> DataFrame:
    """(a, b), a < b: of each tile (key, tile, node, signature) the surviving pairs that span it."""

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in _in_tiles(batches):
            node, signs = table.column("node").to_numpy(), _signatures(table)
            two = starts[sizes == 2]
            alive = two[compared(signs[two], signs[two + 1])[0]] if len(two) else two
            ones, others = [alive], [alive + 1]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                found = []
                for i in range(start, start + size - 1):
                    alive, matches = compared(signs[i][None], signs[i + 1 : start + size])
                    found.append((np.full(len(alive), i), alive + i + 1, matches))
                a, b, matches = (np.concatenate(x) for x in zip(*found))
                taken = _spanning(size, a - start, b - start, matches)
                ones.append(a[taken])
                others.append(b[taken])
            yield _as_pairs(node, np.concatenate(ones), np.concatenate(others))

    dealt = members.select("key", "tile", "node", "signature").repartition("key", "tile")
    sorted_ = dealt.sortWithinPartitions("key", "tile", "node")
    return sorted_.mapInArrow(survivors, "a long, b long").filter("a < b").distinct()


def _links_across(members: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: links between components of each tile, as many as join what can be joined.

    Tiles have the columns key, tile, node, component, signature, bands and
    shingles. A pair is looked at in the first bucket only that it shares, and
    verified on the spot, so that pairs which are nearly similar enough, of
    which a group may have very many, need not be handed on.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in _in_tiles(batches):
            node, signs = table.column("node").to_numpy(), _signatures(table)
            key, label = table.column("key").to_numpy(), table.column("component").to_numpy().copy()
            bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            sets = [np.frombuffer(value.as_buffer(), np.uint64) for value in table.column("shingles")]
            length = np.array([len(x) for x in sets])
            ones, others = [], []
            for start, size in zip(starts.tolist(), sizes.tolist()):
                end = start + size
                for i in range(start, end - 1):
                    rest = np.flatnonzero(label[i + 1 : end] != label[i]) + i + 1
                    short, long = np.minimum(length[rest], length[i]), np.maximum(length[rest], length[i])
                    rest = rest[100 * short >= percent * long]
                    if not len(rest):
                        continue
                    alive, _ = compared(signs[i][None], signs[rest])
                    rest = rest[alive]
                    if not len(rest):
                        continue
                    same = bands[rest] == bands[i]
                    rest = rest[bands[i][same.argmax(axis=1)] == key[i]]
                    if not len(rest):
                        continue
                    own, theirs = sets[i], np.concatenate([sets[j] for j in rest])
                    place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
                    before = np.cumsum(length[rest]) - length[rest]
                    both = np.add.reduceat((own[place] == theirs).astype(np.int64), before)
                    similar = 100 * both >= percent * (length[rest] + len(own) - both)
                    for j in rest[similar].tolist():
                        if label[j] != label[i]:
                            ones.append(i)
                            others.append(j)
                            label[start:end][label[start:end] == label[j]] = label[i]
            yield _as_pairs(node, np.array(ones, np.int64), np.array(others, np.int64))

    columns = ["key", "tile", "node", "component", "signature", "bands", "shingles"]
    dealt = members.select(*columns).repartition("key", "tile").sortWithinPartitions("key", "tile", "node")
    return dealt.mapInArrow(links, "a long, b long").filter("a < b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    if percent != PERCENT:
        raise ValueError(f"bands and bounds are made for {PERCENT} percent")
    small_batches(docs.sparkSession)
    rows = settle(_described(docs, id_col, text), "described")
    usable = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    least = F.min(F.struct("doc_id", "bands", "signature")).alias("_least")
    classes = settle(
        rows.filter(usable)
        .groupBy("digest")
        .agg(least, F.count(F.lit(1)).alias("n"))
        .select("digest", "n", F.col("_least.doc_id").alias("node"), "_least.bands", "_least.signature"),
        "classes",
    )

    # Buckets with more than one class.
    banded = classes.select("node", F.explode("bands").alias("key"))
    buckets = settle(
        banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets"
    )
    members = settle(join_figures(banded, buckets, "key", "n"), "bucket-members")
    involved = settle(members.select("node").distinct(), "involved")
    sets = settle(_sets_of(docs, involved, id_col, text), "shingle-sets")
    weights = sets.groupBy("node").agg(F.max(F.octet_length("shingles") / 8).alias("weight"))
    looks = settle(
        classes.select("node", "signature", "bands").join(involved, "node", "left_semi"), "signatures"
    )

    # The most similar pairs that span the tiles; a large bucket falls into several tiles.
    tiles = F.ceil(F.col("n") / TILE)
    spanned = members.join(looks, "node").select(
        "key", F.pmod(F.xxhash64("node", "key"), tiles).cast("int").alias("tile"), "node", "signature"
    )
    tried = settle(_spanning_pairs(spanned), "spanning-pairs")
    links = settle(_verified(tried, sets, percent), "links")
    first = settle(components(links), "components")

    # What is still apart within a bucket, each tile against each other. Buckets of two are settled.
    placed = members.filter("n > 2").join(first, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    mixed = (
        placed.join(weights, "node")
        .groupBy("key")
        .agg(F.min("component").alias("_one"), F.max("component").alias("_other"), F.sum("weight").alias("_weight"))
        .filter("_one <> _other")
        .select("key", F.ceil(F.greatest(F.col("_weight") / TILE_SHINGLES, F.lit(1))).alias("_tiles"))
    )
    tiles = F.greatest(tiles, F.col("_tiles")).cast("int")
    own = F.pmod(F.xxhash64("node", "key"), F.col("_grid")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_grid") - 1))
    gridded = (
        placed.join(mixed, "key")
        .withColumn("_grid", tiles)
        .withColumn("_own", own)
        .withColumn("_other", other)
        .withColumn("tile", F.least("_own", "_other") * F.col("_grid") + F.greatest("_own", "_other"))
        .join(looks, "node")
        .join(sets, "node")
    )
    joined = settle(_links_across(gridded, percent), "links-across")

    # The second round joins components of the first.
    def component_of(edges: DataFrame, side: str) -> DataFrame:
        named = first.withColumnsRenamed({"node": side, "component": f"_{side}"})
        return edges.join(named, side, "left").withColumn(side, F.coalesce(f"_{side}", side)).drop(f"_{side}")

    merged = components(component_of(component_of(joined, "a"), "b")).toDF("component", "_merged")
    final = (
        classes.select("digest", "n", "node")
        .join(first, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(merged, "component", "left")
        .select("digest", "n", F.coalesce("_merged", "component").alias("component_id"))
    )
    figures = settle(final, "class-components")
    narrow = rows.select("doc_id", "n_shingles", "digest")
    linked = join_figures(narrow.filter(usable), figures, "digest", "n").select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )
    alone = narrow.filter(~usable).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return linked.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose component keeps another id.

    A row leaves if no row with its id is kept.
    """
    found = near_duplicates(docs, id_col, text).filter("doc_id is not null")
    judged = found.groupBy("doc_id").agg(F.max("kept").alias("kept"))
    leaves = uncommon("leaves", docs)
    leaving = settle(judged.filter("not kept").select(F.col("doc_id").alias(leaves)), "leaving")
    leaving = F.broadcast(leaving) if leaving.count() <= BROADCAST_IDS else leaving
    return docs.join(leaving, F.col(id_col).cast("long") == F.col(leaves), "left_anti")
