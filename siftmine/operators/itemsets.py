"""Frequent itemsets over baskets.

Support is an absolute number of baskets. Equal baskets are counted once with
a weight, and items below the support are dropped before baskets are formed:
no frequent itemset can contain them, and it bounds the length of a basket by
the number of frequent items.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.operators.ids import ordered_index
from siftmine.operators.skew import settle

# Distinct baskets that one task mines in memory.
CHUNK_BASKETS = 100_000
# The support within a chunk stays at least this high, else a chunk would list nearly all subsets.
LEAST_CHUNK_SUPPORT = 5

# Items in the conditional baskets of one pattern that a task grows in memory; above, Spark projects them once more.
GROUP_ITEMS = 16_000_000

# Distinct baskets of one item, and sets of one rarest item, that a task holds at once.
SPLIT_BASKETS = 20_000
TREE_SETS = 50_000

_ITEMSET = "array<string>"


def baskets(df: DataFrame, key: str, item: str) -> DataFrame:
    """(basket, items): the sorted set of items of each basket."""
    return df.groupBy(F.col(key).alias("basket")).agg(
        F.array_sort(F.collect_set(F.col(item).cast("string"))).alias("items")
    )


def frequent_items(rows: DataFrame, support: int) -> DataFrame:
    """(item, n) for items of (basket, item) rows in at least ``support`` baskets."""
    return (
        rows.select("basket", "item")
        .distinct()
        .groupBy("item")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= support)
    )


def pruned_baskets(rows: DataFrame, support: int) -> DataFrame:
    """(basket, ranked): the frequent items of each basket that has any, the commonest first."""
    rows = rows.select("basket", F.col("item").cast("string").alias("item"))
    keep = frequent_items(rows, support)
    # The set drops repeated rows within every task, before baskets are brought together.
    ranks = F.array_sort(F.collect_set(F.struct((-F.col("n")).alias("rank"), "item")))
    return rows.join(keep, "item").groupBy("basket").agg(ranks.getField("item").alias("ranked"))


def weighted_baskets(rows: DataFrame, support: int) -> DataFrame:
    """(items, ranked, weight): distinct baskets of frequent items, sorted and by rank, with their number."""
    counted = pruned_baskets(rows, support).groupBy("ranked").agg(F.count(F.lit(1)).alias("weight"))
    return settle(counted, "baskets").select(F.array_sort("ranked").alias("items"), "ranked", "weight")


def _shape(itemsets: DataFrame) -> DataFrame:
    return itemsets.select("items", F.size("items").alias("size"), "freq")


def _codes(lists: pa.ListArray, known: dict[str, int]) -> np.ndarray:
    """The items of all lists as numbers; new ones are added to ``known``."""
    flat = lists.flatten().dictionary_encode()
    own = np.array([known.setdefault(name, len(known)) for name in flat.dictionary.to_pylist()], np.int32)
    return own[flat.indices.to_numpy()] if len(flat) else own


def _lists(
    batches: Iterator[pa.RecordBatch], column: str
) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Names of the items, numbers of the items of all lists of ``column``, the lists' sizes and weights."""
    known: dict[str, int] = {}
    codes, sizes, weights = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for batch in batches:
        lists = batch.column(column)
        codes.append(_codes(lists, known))
        sizes.append(lists.value_lengths().to_numpy())
        weights.append(batch.column("weight").to_numpy())
    # Numbers of two bytes sort faster.
    kind = np.uint16 if len(known) <= 2**16 else np.int32
    return list(known), np.concatenate(codes).astype(kind), np.concatenate(sizes), np.concatenate(weights)


def _grown(
    names: list[str],
    codes: np.ndarray,
    sizes: np.ndarray,
    weights: np.ndarray,
    threshold: float,
    max_size: int | None = None,
) -> Iterator[tuple[tuple[str, ...], int]]:
    """(itemset, weight) of those in the lists whose weight reaches ``threshold``.

    All lists keep to one order of the items. An itemset grows by an item that
    comes before its own, counted in the parts of its lists that come before it.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    filled = np.flatnonzero(sizes)
    todo: list[tuple[tuple[str, ...], np.ndarray, np.ndarray]] = [((), filled, ends[filled])]
    if not len(filled):
        return
    while todo:
        pattern, held, upto = todo.pop()
        each = upto - starts[held]
        place = np.arange(each.sum()) + np.repeat(upto - np.cumsum(each), each)
        order = np.argsort(codes[place], kind="stable")
        place, owner = place[order], np.repeat(held, each)[order]
        code = codes[place]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        last, sums = np.append(first[1:], len(code)), np.add.reduceat(weights[owner], first)
        for i in np.flatnonzero(sums >= threshold):
            grown = (*pattern, names[code[first[i]]])
            yield grown, int(sums[i])
            if max_size is not None and len(grown) >= max_size:
                continue
            own, end = owner[first[i] : last[i]], place[first[i] : last[i]]
            rest = end > starts[own]
            if rest.any() and weights[own[rest]].sum() >= threshold:
                todo.append((grown, own[rest], end[rest]))


def _batches(found: Iterator[tuple[tuple[str, ...], int]]) -> Iterator[pa.RecordBatch]:
    """(items, freq) of the itemsets, in batches of a bounded size."""
    while some := list(islice(found, 10_000)):
        items, freq = zip(*some)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.list_(pa.string())), pa.array(freq, pa.int64())], ["items", "freq"]
        )


def frequent_itemsets(
    rows: DataFrame, support: int, partitions: int | None = None, weighted: DataFrame | None = None
) -> DataFrame:
    """(items, size, freq) of all itemsets in at least ``support`` baskets, by parallel FP-growth.

    ``rows`` holds (basket, item). The commoner items beside an item are its
    conditional baskets. They are brought together by item, and a task grows the
    item's sets from them. Where they hold more than ``GROUP_ITEMS`` items, Spark
    counts them and projects them on one more item, until a task can hold them.
    ``partitions`` is the number of tasks that grow sets, else it follows the data.
    """
    weighted = weighted_baskets(rows, support) if weighted is None else weighted

    def mine(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = key[0].as_py()
        found = _grown(*_lists(batches, "before"), max(1, support))
        yield from _batches(((*pattern, *items), freq) for items, freq in found)

    none = F.array().cast(_ITEMSET)
    bases = weighted.select(none.alias("pattern"), F.col("ranked").alias("before"), "weight")
    found = []
    while True:
        placed = bases.select("pattern", "before", "weight", F.posexplode("before").alias("place", "item"))
        pattern = F.concat("pattern", F.array("item")).alias("pattern")
        counts = settle(
            placed.groupBy("pattern", "item")
            .agg(F.sum("weight").alias("freq"), F.sum("place").alias("n"))
            .filter(F.col("freq") >= support)
            .select(pattern, "freq", "n"),
            "pattern-counts",
        )
        found.append(counts.select(F.col("pattern").alias("items"), "freq"))
        before = F.expr("slice(before, 1, place)").alias("before")
        projected = placed.filter("place > 0").select(pattern, before, "weight")
        known = projected.join(counts.select("pattern", "n"), "pattern")
        light = known.filter(F.col("n") <= GROUP_ITEMS).drop("n")
        if partitions:
            light = light.repartition(partitions, "pattern")
        found.append(light.groupBy("pattern").applyInArrow(mine, f"items {_ITEMSET}, freq long"))
        if counts.filter(F.col("n") > GROUP_ITEMS).isEmpty():
            break
        heavy = known.filter(F.col("n") > GROUP_ITEMS).groupBy("pattern", "before")
        bases = settle(heavy.agg(F.sum("weight").alias("weight")), "projected")
    every = reduce(DataFrame.union, found)
    return _shape(every.select(F.array_sort("items").alias("items"), "freq"))


def son_candidates(
    rows: DataFrame,
    support: int,
    chunk_baskets: int = CHUNK_BASKETS,
    max_size: int | None = None,
    weighted: DataFrame | None = None,
    low_support: str = "error",
) -> DataFrame:
    """(items): itemsets frequent in some chunk of the baskets, at a proportional support.

    An itemset that is frequent overall reaches its share of the support in at
    least one chunk, so none is missed; ``son_verify`` removes the rest. Where
    there are several chunks and the share of one is below ``LEAST_CHUNK_SUPPORT``, chunks would list
    nearly all subsets: that is an error, or with ``low_support="growth"`` the
    caller asks for the itemsets of parallel FP-growth as candidates instead.
    """
    if low_support not in ("error", "growth"):
        raise ValueError("low_support must be 'error' or 'growth'")
    weighted = weighted_baskets(rows, support) if weighted is None else weighted
    size = weighted.agg(
        F.count(F.lit(1)).alias("sets"), F.coalesce(F.sum("weight"), F.lit(0)).alias("n")
    ).first()
    chunks = max(1, -(-size["sets"] // chunk_baskets))
    too_low = chunks > 1 and support < LEAST_CHUNK_SUPPORT * chunks
    if too_low and low_support == "error":
        raise ValueError(
            f"a support of {support} is below {LEAST_CHUNK_SUPPORT} in each of {chunks} chunks: "
            "take larger chunks, a higher support, or low_support='growth'"
        )
    if too_low:
        found = frequent_itemsets(rows, support, weighted=weighted)
        return (found if max_size is None else found.filter(F.col("size") <= max_size)).select("items")
    share = support / max(1, size["n"])

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, codes, sizes, weights = _lists(batches, "items")
        # The small slack keeps rounding of the share from raising the threshold.
        threshold = max(1.0, share * weights.sum() - 1e-6)
        for batch in _batches(_grown(names, codes, sizes, weights, threshold, max_size)):
            yield batch.select(["items"])

    spread = weighted.repartition(chunks, F.xxhash64("items")).select("items", "weight")
    found = spread.mapInArrow(mine, f"items {_ITEMSET}")
    return found.select(F.array_sort("items").alias("items")).distinct()


def _item_counts(weighted: DataFrame) -> DataFrame:
    """(item, freq, sets): the baskets of every item, and the distinct ones among them."""
    counts = weighted.select(F.explode("items").alias("item"), "weight").groupBy("item")
    return settle(counts.agg(F.sum("weight").alias("freq"), F.count(F.lit(1)).alias("sets")), "item-counts")


def _tree(sets: list[list[str]], anchor: str) -> dict:
    """Prefix tree of the sets without their anchor; the key None marks where one ends, with its number."""
    root: dict = {}
    for number, items in enumerate(sets):
        node = root
        for item in items:
            if item != anchor:
                node = node.setdefault(item, {})
        node[None] = number
    return root


def _holders(tree: dict, columns: dict[str, np.ndarray], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of a set, the baskets that hold it): a branch is left where no basket goes on."""
    mark = np.zeros(n, bool)
    todo = [(tree, np.arange(n))]
    while todo:
        node, held = todo.pop()
        for item, below in node.items():
            if item is None:
                yield below, held
            elif item in columns:
                mark[columns[item]] = True
                both = held[mark[held]]
                mark[columns[item]] = False
                if len(both):
                    todo.append((below, both))


def _counted(weighted: DataFrame, sets: DataFrame, counts: DataFrame, grow: bool = False) -> DataFrame:
    """(candidate, freq) of the sets (items), or with ``grow`` (candidate, next, freq) for each later item.

    A set belongs to its rarest item. The baskets of an item are split by their
    number, and its sets into trees of a bounded size; each split of baskets
    meets each tree once, and only sums leave the task.
    """
    rarest = F.min(F.struct("freq", "item")).alias("rarest")
    anchored = settle(
        sets.select(F.col("items").alias("candidate"), F.explode("items").alias("item"))
        .join(counts, "item")
        .groupBy("candidate")
        .agg(rarest, F.count(F.lit(1)).alias("known"))
        # A set with an item that no basket has is in none.
        .filter(F.col("known") == F.size("candidate"))
        .select("candidate", F.col("rarest.item").alias("item")),
        "anchored",
    )
    shape = settle(
        anchored.groupBy("item")
        .agg(F.ceil(F.count(F.lit(1)) / TREE_SETS).cast("int").alias("trees"))
        .join(counts, "item")
        .select("item", "trees", F.ceil(F.col("sets") / SPLIT_BASKETS).cast("int").alias("splits")),
        "anchors",
    )
    every_tree = F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree")
    every_split = F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split")
    own_split = F.pmod(F.xxhash64("items"), F.col("splits")).cast("int").alias("split")
    own_tree = F.pmod(F.xxhash64("candidate"), F.col("trees")).cast("int").alias("tree")
    members = weighted.select(F.explode("items").alias("item"), "items", "weight").join(shape, "item")
    left = members.select("item", own_split, every_tree, "items", "weight")
    right = anchored.join(shape, "item").select("item", every_split, own_tree, "candidate")

    def count(baskets_: pa.Table, candidates: pa.Table) -> pa.Table:
        out: dict[str, list] = {"candidate": [], "next": [], "freq": []}
        if baskets_.num_rows and candidates.num_rows:
            names = candidates.column("candidate").to_pylist()
            lists = baskets_.column("items").combine_chunks()
            weights = baskets_.column("weight").to_numpy()
            flat = lists.flatten().dictionary_encode()
            items = flat.dictionary.to_pylist()
            sizes = lists.value_lengths().to_numpy()
            codes, of = flat.indices.to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(codes, kind="stable")
            edges = np.searchsorted(codes[order], np.arange(len(items) + 1))
            columns = {item: of[order[edges[i] : edges[i + 1]]] for i, item in enumerate(items)}
            starts = np.cumsum(sizes) - sizes
            anchor = candidates.column("item")[0].as_py()
            for number, held in _holders(_tree(names, anchor), columns, len(sizes)):
                if not grow:
                    out["candidate"].append(names[number])
                    out["next"].append(None)
                    out["freq"].append(int(weights[held].sum()))
                    continue
                each = sizes[held]
                place = np.arange(each.sum()) + np.repeat(starts[held] - np.cumsum(each) + each, each)
                sums = np.bincount(codes[place], np.repeat(weights[held], each), len(items))
                for code in np.flatnonzero(sums):
                    if items[code] > names[number][-1]:
                        out["candidate"].append(names[number])
                        out["next"].append(items[code])
                        out["freq"].append(int(sums[code]))
        return pa.Table.from_pydict(
            {
                "candidate": pa.array(out["candidate"], pa.list_(pa.string())),
                "next": pa.array(out["next"], pa.string()),
                "freq": pa.array(out["freq"], pa.int64()),
            }
        )

    keys = ["item", "split", "tree"]
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        count, f"candidate {_ITEMSET}, next string, freq long"
    )
    by = ["candidate", "next"] if grow else ["candidate"]
    return partial.groupBy(*by).agg(F.sum("freq").alias("freq"))


def son_verify(
    rows: DataFrame, candidates: DataFrame, support: int, weighted: DataFrame | None = None
) -> DataFrame:
    """(items, size, freq) of the candidates in at least ``support`` baskets, counted exactly."""
    weighted = weighted_baskets(rows, support) if weighted is None else weighted
    candidates = settle(candidates.select(F.array_sort("items").alias("items")).distinct(), "candidates")
    counted = _counted(weighted, candidates, _item_counts(weighted))
    return _shape(counted.withColumnRenamed("candidate", "items").filter(F.col("freq") >= support))


def son_itemsets(
    rows: DataFrame, support: int, chunk_baskets: int = CHUNK_BASKETS, low_support: str = "error"
) -> DataFrame:
    """Both phases: candidates from chunks of baskets, then the exact count."""
    weighted = weighted_baskets(rows, support)
    found = son_candidates(rows, support, chunk_baskets, weighted=weighted, low_support=low_support)
    return son_verify(rows, found, support, weighted=weighted)


def apriori_level(rows: DataFrame, prev: DataFrame, size: int, support: int) -> DataFrame:
    """Frequent itemsets of ``size`` items, given those of ``size - 1`` in ``prev`` (items).

    A set of ``prev`` grows by one later item of a basket that holds it, so a
    candidate is formed only where it occurs and is counted as it is formed.
    One with a part that is not in ``prev`` is dropped.
    """
    weighted = weighted_baskets(rows, support)
    if size == 1:
        single = _item_counts(weighted).select(F.array("item").alias("items"), "freq")
        return _shape(single.filter(F.col("freq") >= support))
    prev = settle(prev.select(F.array_sort("items").alias("items")).distinct(), "level-before")
    counted = (
        _counted(weighted, prev, _item_counts(weighted), grow=True)
        .filter(F.col("freq") >= support)
        .select(F.concat("candidate", F.array("next")).alias("items"), "freq")
    )
    parts = counted.select(
        F.col("items").alias("candidate"),
        "freq",
        F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("_left_out"),
    ).select(
        "candidate",
        "freq",
        F.filter("candidate", lambda item, i: i != F.col("_left_out")).alias("items"),
    )
    whole = (
        parts.join(prev, "items", "left_semi")
        .groupBy("candidate", "freq")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == size)
    )
    return _shape(whole.select(F.col("candidate").alias("items"), "freq"))


def itemset_report(itemsets: DataFrame) -> DataFrame:
    """(size, pos, shown): itemsets as ``(a, b)``, by size, sorted as text and numbered from 0.

    Joined by a comma and a space, those of one size are its line. They stay
    rows, so that nothing grows with their number.
    """
    shown = itemsets.select(
        "size", F.format_string("(%s)", F.array_join("items", ", ")).alias("shown")
    )
    numbered = ordered_index(shown, ["size", "shown"], "_index")
    first = numbered.groupBy("size").agg(F.min("_index").alias("_first"))
    # One row per itemset size, which is at most the longest basket.
    return (
        numbered.join(F.broadcast(first), "size")
        .select("size", (F.col("_index") - F.col("_first")).alias("pos"), "shown")
        .orderBy("size", "pos")
    )
