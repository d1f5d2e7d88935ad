import random
import re

import numpy as np
import pytest

from siftmine.llm import near_dedup
from siftmine.llm.components import components

from .helpers import EDGES, frame


def shingles(text):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_force(rows):
    sets = [shingles(row[1]) for row in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(
        (row[0] is None, row[0] or 0, len(sets[i]), -1 if row[0] is None else least[find(i)]) for i, row in enumerate(rows)
    )


def found(spark, rows):
    result = near_dedup.near_duplicates(frame(spark, rows)).collect()
    for r in result:
        assert r["kept"] == (r["doc_id"] == r["component_id"] or r["doc_id"] is None)
    return sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], -1 if r["component_id"] is None else r["component_id"])
        for r in result
    )


def edited(rng, words, share):
    return [f"w{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def groups(seed, shares, n_groups=8, members=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, members)):
            rows.append((rng.randrange(10**9), " ".join(edited(rng, base, rng.choice(shares)))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shares", [(0.0, 0.01, 0.02), (0.02, 0.03, 0.04)])
def test_components(spark, shares):
    rows = groups(5, shares)
    assert found(spark, rows) == brute_force(rows)


def test_a_large_group_in_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 4)
    rows = groups(6, (0.0, 0.01, 0.03, 0.05), n_groups=2, members=70) + [(5, "a b c d e f g"), (6, "a b c d e f g")]
    assert found(spark, rows) == brute_force(rows)


def test_edges(spark):
    rows = EDGES + [(20, "A b C"), (21, "a B\tc"), (22, "a b"), (23, "x " * 50), (24, "x " * 60), (23, "other words")]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, []) == []


def test_dropping(spark):
    rows = EDGES + groups(7, (0.0, 0.005), n_groups=3)
    docs = frame(spark, rows)
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = [r for r in brute_force(rows) if r[0] or r[1] == r[3]]
    # Id 5 comes twice and is not the smallest of its group.
    assert kept.count() == len(want)


def test_pruning_bounds():
    bounds = near_dedup.least_matches()
    assert list(bounds) == sorted(bounds) and len(bounds) == near_dedup.HASHES // near_dedup.BATCH
    # A pair at the threshold is given up with about the chosen probability at most.
    rng = random.Random(1)
    lost = 0
    for _ in range(20_000):
        matches = 0
        for bound in bounds:
            matches += sum(rng.random() < 0.751 for _ in range(near_dedup.BATCH))
            if matches < bound:
                lost += 1
                break
    assert lost <= 5


def test_bytes_of_unrelated_long_texts_differ(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(2_000))) for i in range(20)]
    described = near_dedup._described(frame(spark, rows), "doc_id", "text").collect()
    signs = [np.frombuffer(r["signature"], np.uint8) for r in described]
    equal = [(signs[i] == signs[j]).mean() for i in range(20) for j in range(i)]
    assert np.mean(equal) < 2 / 256
    assert not any(len(near_dedup.compared(signs[i][None], np.array(signs[:i]))[0]) for i in range(1, 20))


def test_component_graphs(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 600 + i) for i in range(40)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)] + [(7, 7), (100, 101)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
