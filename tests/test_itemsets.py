import random
from itertools import combinations

import pytest

from siftmine.operators import itemsets
from siftmine.plans import jobs
from siftmine.sources import readers, writers


def _rows(seed, n=60, items=9):
    dice = random.Random(seed)
    found = []
    for b in range(n):
        size = dice.randint(1, 6)
        found += [(b, str(dice.randint(1, items) ** 2)) for _ in range(size)]
    # A third of the baskets are copies of one another.
    return found + [(1000 + b, item) for b in range(n // 2) for item in ("1", "4", "16", "10")]


def _brute(rows, support):
    baskets = {}
    for basket, item in rows:
        baskets.setdefault(basket, set()).add(item)
    counts = {}
    for items in baskets.values():
        for size in range(1, len(items) + 1):
            for chosen in combinations(sorted(items), size):
                counts[chosen] = counts.get(chosen, 0) + 1
    return {items: n for items, n in counts.items() if n >= support}


def _found(df):
    rows = df.collect()
    assert all(r["size"] == len(r["items"]) for r in rows)
    found = {tuple(r["items"]): r["freq"] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture
def frame(spark):
    return lambda rows, parts=4: spark.createDataFrame(
        rows, "basket long, item string"
    ).repartition(parts)


@pytest.mark.parametrize(("seed", "support"), [(0, 3), (1, 12), (2, 30)])
def test_both_methods_match_brute_force(frame, seed, support):
    rows = _rows(seed)
    expected = _brute(rows, support)
    assert _found(itemsets.frequent_itemsets(frame(rows), support)) == expected
    for chunk in (25, 100_000):
        low = "growth" if support < 30 else "error"
        assert _found(itemsets.son_itemsets(frame(rows, 1), support, chunk, low)) == expected


@pytest.mark.parametrize("bounds", [(1, 1), (3, 2), (20_000, 50_000)])
def test_counts_split_by_baskets_and_by_trees(frame, spark, monkeypatch, bounds):
    """Every item's baskets in splits of any size, every item's sets in trees of any size."""
    monkeypatch.setattr(itemsets, "SPLIT_BASKETS", bounds[0])
    monkeypatch.setattr(itemsets, "TREE_SETS", bounds[1])
    rows = _rows(11)
    every = _brute(rows, 1)
    wanted = spark.createDataFrame([(list(k),) for k in every], "items array<string>")
    assert _found(itemsets.son_verify(frame(rows), wanted, 1)) == every
    level = itemsets.son_verify(frame(rows), wanted, 4).filter("size = 2")
    grown = _found(itemsets.apriori_level(frame(rows), level, 3, 4))
    assert grown == {k: n for k, n in every.items() if len(k) == 3 and n >= 4}


@pytest.mark.parametrize("bound", [0, 40, 16_000_000])
def test_growth_projects_what_a_task_cannot_hold(frame, monkeypatch, bound):
    """All patterns, some or none projected by Spark; null items are in no itemset, a null basket is one."""
    monkeypatch.setattr(itemsets, "GROUP_ITEMS", bound)
    rows = [*_rows(12), (None, "1"), (None, "4"), (2, None), (2, None)]
    expected = _brute([row for row in rows if row[1] is not None], 4)
    assert max(map(len, expected)) > 3
    assert _found(itemsets.frequent_itemsets(frame(rows), 4)) == expected
    assert _found(itemsets.frequent_itemsets(frame(rows), 4, partitions=1)) == expected


def test_equal_baskets_are_mined_once(frame, monkeypatch):
    """Growth reads a row per distinct basket, and baskets that are at hand are not formed again."""
    formed, settle = [], itemsets.settle

    def seen(df, purpose):
        kept = settle(df, purpose)
        if purpose == "baskets":
            formed.append(kept.count())
        return kept

    monkeypatch.setattr(itemsets, "settle", seen)
    rows = [(b, item) for b in range(300) for item in "abc"] + [(b, "a") for b in range(300, 400)]
    found = _found(itemsets.frequent_itemsets(frame(rows), 100))
    assert found == _brute(rows, 100) and formed == [2]
    weighted = itemsets.weighted_baskets(frame(rows), 100)
    assert _found(itemsets.frequent_itemsets(frame(rows), 100, weighted=weighted)) == found
    assert itemsets.son_candidates(frame(rows), 100, 1, weighted=weighted).count() == len(found)
    assert formed == [2, 2]


def test_support_too_low_for_chunks_is_an_error(frame):
    rows = _rows(0)
    with pytest.raises(ValueError, match="larger chunks"):
        itemsets.son_candidates(frame(rows), 3, 7)
    with pytest.raises(ValueError, match="low_support"):
        itemsets.son_candidates(frame(rows), 3, 7, low_support="other")


def test_support_at_and_above_the_largest_count(frame):
    rows = _rows(9)
    top = max(_brute(rows, 1).values())
    assert set(_found(itemsets.frequent_itemsets(frame(rows), top)).values()) == {top}
    assert _found(itemsets.frequent_itemsets(frame(rows), top + 1)) == {}
    assert _found(itemsets.son_itemsets(frame(rows), top + 1)) == {}
    assert itemsets.itemset_report(itemsets.frequent_itemsets(frame(rows), top + 1)).count() == 0


def test_candidates_miss_nothing(frame):
    rows = _rows(4)
    found = {
        tuple(r["items"]) for r in itemsets.son_candidates(frame(rows), 15, 25).collect()
    }
    assert set(_brute(rows, 15)) <= found


def test_levels(frame):
    rows = _rows(5)
    expected = _brute(rows, 6)
    level = itemsets.son_itemsets(frame(rows), 6).filter("size = 1")
    for size in (2, 3):
        level = itemsets.apriori_level(frame(rows), level, size, 6)
        assert _found(level) == {k: n for k, n in expected.items() if len(k) == size}


def test_levels_keep_to_the_level_before(frame, spark):
    rows = _rows(5)
    pairs = [k for k in _brute(rows, 6) if len(k) == 2]
    assert len(pairs) > 3
    some = spark.createDataFrame([(list(k),) for k in pairs[1:]], "items array<string>")
    found = _found(itemsets.apriori_level(frame(rows), some, 3, 6))
    assert found == {
        k: n for k, n in _brute(rows, 6).items() if len(k) == 3 and not set(pairs[0]) <= set(k)
    }


def test_verify_counts_any_candidates(frame, spark):
    rows = _rows(6)
    wanted = spark.createDataFrame(
        [(list(k),) for k in _brute(rows, 3)] + [(["missing", "1"],)], "items array<string>"
    )
    assert _found(itemsets.son_verify(frame(rows), wanted, 5)) == _brute(rows, 5)


def test_low_support_does_not_explode(frame):
    dice = random.Random(8)
    rows = [(b, f"i{dice.randrange(60)}") for b in range(200) for _ in range(10)]
    frequent = itemsets.frequent_itemsets(frame(rows), 3).count()
    candidates = itemsets.son_candidates(frame(rows), 3, 50, low_support="growth").count()
    assert candidates <= 1.2 * frequent


def test_report_layout(spark, frame, rows, tmp_path):
    found = spark.createDataFrame(
        [(["10"], 1), (["1"], 1), (["2"], 1), (["1", "2"], 2), (["1", "10"], 2)],
        "items array<string>, size int",
    )
    report = itemsets.itemset_report(found)
    assert rows(report) == [
        (1, 0, "(1)"), (1, 1, "(10)"), (1, 2, "(2)"), (2, 0, "(1, 10)"), (2, 1, "(1, 2)"),
    ]
    path = tmp_path / "report"
    writers.write_itemset_report(report, str(path))
    lines = {
        folder.name: "".join(f.read_text() for f in sorted(folder.glob("part-*")))
        for folder in path.glob("size=*")
    }
    assert lines == {"size=1": "(1), (10), (2), ", "size=2": "(1, 10), (1, 2), "}
    assert rows(readers.read_itemset_report(spark, str(path)), "size", "shown") == [
        (size, shown) for size, _, shown in rows(report)
    ]


def test_report_of_many_itemsets_stays_rows(spark):
    found = spark.range(12_000).selectExpr("array(cast(id as string)) as items", "1 as size")
    report = itemsets.itemset_report(found)
    assert report.count() == 12_000 and report.agg({"pos": "max"}).first()[0] == 11_999


def test_job_methods_agree_and_sizes_are_anti_monotone(frame, rows):
    data = _rows(7)
    grown = rows(jobs.frequent_itemset_lines(frame(data), 8))
    assert grown == rows(jobs.frequent_itemset_lines(frame(data), 8, "son"))
    assert set(_brute(data, 12)) <= set(_brute(data, 8))


def test_baskets(frame, rows):
    found = rows(itemsets.baskets(frame([(1, "b"), (1, "a"), (1, "b"), (2, "c")]), "basket", "item"), "basket")
    assert found == [(1, ["a", "b"]), (2, ["c"])]
