import hashlib
import math
import random
from collections import Counter

import pytest

from siftmine.llm import mixing, sharding

from .helpers import EDGES, frame


def chance(doc_id):
    bits = int(hashlib.md5(f"{mixing.SEED}|{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16)
    return (bits + 0.5) / 2**52


def poisson(rate, u):
    k, p = 0, math.exp(-rate)
    total = p
    while total < u and k < 1000:
        k += 1
        p *= rate / k
        total += p
    return k


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0, "unknown": 2.0}])
def test_copies_follow_the_rates(spark, weights):
    rows = EDGES + [(100 + i, "x" * (i % 7), "en", "b") for i in range(300)]
    sizes = Counter()
    for row in rows:
        sizes[row[3]] += len((row[1] or "").encode()) + 1
    w = {s: (n**mixing.TEMPERATURE if weights is None else weights.get(s, 0.0)) for s, n in sizes.items()}
    rate = {s: sum(sizes.values()) * w[s] / sum(w.values()) / sizes[s] for s in sizes}
    want = Counter()
    for row in rows:
        if n := poisson(rate[row[3]], chance(row[0])):
            want[row[0]] += n
    found = mixing.mix_order(frame(spark, rows), weights=weights).collect()
    assert Counter(r["doc_id"] for r in found) == want
    assert sorted(r["position"] for r in found) == list(range(len(found)))
    for r in found:
        assert r["rate"] == pytest.approx(rate[r["source"]])
    mixed = mixing.mix(frame(spark, rows), weights=weights)
    assert mixed.columns == frame(spark, rows).columns
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == want


def test_large_rates_and_many_sources(spark, monkeypatch):
    rows = [(i, "x", "en", "rare" if i < 3 else f"s{i % 40}") for i in range(2000)]
    weights = {"rare": 1.0}
    found = mixing.mix_order(frame(spark, rows), weights=weights, epochs=3.0).collect()
    assert abs(len(found) - 6000) < 5 * 6000**0.5
    plain = sorted((r["doc_id"], r["copy"]) for r in found)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    joined = mixing.mix_order(frame(spark, rows), weights=weights, epochs=3.0).collect()
    assert sorted((r["doc_id"], r["copy"]) for r in joined) == plain


def test_empty_mix(spark):
    assert mixing.mix_order(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [])).count() == 0


def test_mixing_plan_is_native(spark):
    plan = mixing.mix(frame(spark, EDGES))._jdf.queryExecution().toString()  # noqa: SLF001
    assert "Python" not in plan and "Arrow" not in plan


def test_matrix_has_its_sums():
    rng = random.Random(5)
    for _ in range(200):
        sent = [rng.randint(0, 50) for _ in range(rng.randint(1, 9))]
        shards = rng.randint(1, 6)
        sizes = sharding.shard_sizes(sum(sent), shards)
        matrix = sharding.communication_matrix(sent, sizes, rng.randint(0, 10**6))
        assert [sum(line) for line in matrix] == sent
        assert [sum(column) for column in zip(*matrix)] == sizes


def test_draws_are_hypergeometric():
    rng = random.Random(11)
    good, bad, draws, n = 7, 9, 6, 40_000
    seen = Counter(sharding.hypergeometric(rng, good, bad, draws) for _ in range(n))
    for k in range(draws + 1):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
        assert abs(seen[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9
    big = [sharding.hypergeometric(rng, 10**10, 7 * 10**10, 10**6) for _ in range(300)]
    assert abs(sum(big) / len(big) - 125_000) < 5 * math.sqrt(10**6 * 7 / 64 / 300)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards(spark, shards):
    rows = EDGES + [(100 + i, "y") for i in range(101)]
    docs = frame(spark, rows).repartition(5)
    found = sharding.uniform_shards(docs, shards).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(row[0] for row in rows)
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes) == set(range(shards)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(size))


def test_shards_are_uniform(spark):
    docs = spark.range(0, 400, numPartitions=4)
    first, seeds = Counter(), 30
    for seed in range(seeds):
        for r in sharding.uniform_shards(docs, 4, seed=seed).collect():
            first[r["id"] // 100, r["shard"]] += 1
    for count in first.values():
        # 100 rows of each quarter in each of 30 runs, a quarter of them in each shard.
        assert abs(count - 750) < 5 * math.sqrt(seeds * 100 * 3 / 16)


def test_shard_sizes_and_empty(spark):
    assert sharding.uniform_shards(frame(spark, []), 8).count() == 0
    found = sharding.uniform_shards(spark.range(10), 2, sizes=[9, 1]).collect()
    assert Counter(r["shard"] for r in found) == {0: 9, 1: 1}
    with pytest.raises(ValueError):
        sharding.uniform_shards(spark.range(10), 2, sizes=[9, 2])
