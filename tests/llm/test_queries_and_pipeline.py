"""The queries and the pipeline on the smallest tables."""

import hashlib
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from siftmine.llm.registry import ORACLE, QUERIES

from .helpers import EDGES, frame

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]
NATIVE = ("op3_exact_dedup", "op6_source_mix", "op8_uniform_shards")


def _rows(table):
    columns = sorted(table.column_names)
    return sorted(map(repr, zip(*(table.column(name).to_pylist() for name in columns))))


def test_all_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, FOLDER).toArrow()
    connection = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = connection.sql(ORACLE[name]).to_arrow_table()
    assert _rows(found) == _rows(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_the_table(spark, name):
    found = QUERIES[name](spark, FOLDER)
    ids = {row[0] for row in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    assert {row[0] for row in found.select("doc_id").collect()} == ids


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_stages(spark, tmp_path):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, docs = {}, documents
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        if n < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == documents.columns
        before[name] = docs.collect(), after.collect()
        docs = after

    rows, kept = before["quality classifier"]
    ids = {r["doc_id"] for r in kept}
    clean = [i for i, r in labels.items() if r["quality"] == 1 and not r["toxic"]]
    assert sum(i in ids for i in clean) >= 0.98 * len(clean)
    assert {tuple(r) for r in kept} <= {tuple(r) for r in rows} and len(ids) == len(kept)

    rows, kept = before["exact dedup"]
    key = lambda r: hashlib.sha256(re.sub("[ \t\n\x0b\x0c\r]+", " ", r["text"] or "").encode()).digest()
    least = {}
    for r in rows:
        least[key(r)] = min(least.get(key(r), r["doc_id"]), r["doc_id"])
    assert {r["doc_id"] for r in kept} == set(least.values()) and len(kept) == len(least)

    from .test_near_dedup import brute_force

    rows, kept = before["near dedup"]
    stay = {i for _, i, _, c in brute_force([(r["doc_id"], r["text"]) for r in rows]) if i == c}
    assert Counter(r["doc_id"] for r in kept) == Counter(stay)

    from .test_mixing_and_sharding import chance, poisson
    from siftmine.llm.mixing import TEMPERATURE

    rows, kept = before["source mixing"]
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len((r["text"] or "").encode()) + 1
    weight = {s: n**TEMPERATURE for s, n in sizes.items()}
    rate = {s: sum(sizes.values()) * weight[s] / sum(weight.values()) / sizes[s] for s in sizes}
    want = Counter({r["doc_id"]: poisson(rate[r["source"]], chance(r["doc_id"])) for r in rows})
    assert Counter(r["doc_id"] for r in kept) == +want

    rows, pieces = before["best-fit packing"]
    taken, places = Counter(), defaultdict(list)
    for p in pieces:
        taken[p["doc_id"]] += p["piece"] == 0
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    assert taken == Counter(r["doc_id"] for r in rows)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024


@pytest.mark.parametrize("rows", [EDGES, []], ids=["edges", "empty"])
@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_awkward_tables(spark, name, stage, rows):
    docs = frame(spark, rows)
    found = stage(spark, docs, FOLDER)
    result = found.collect()
    if name != "best-fit packing":
        assert found.schema == docs.schema
    if name in ("quality classifier", "best-fit packing"):
        # No text here is worse than the trusted ones; each row is packed.
        assert {r["doc_id"] for r in result} >= {r[0] for r in rows if not r[1]}
    assert bool(rows) == bool(result)


@pytest.mark.parametrize("path", sorted((ROOT / "siftmine" / "llm").glob("*.py")), ids=lambda p: p.name)
def test_sources_keep_to_the_rules(path):
    text = path.read_text()
    for word in ("localCheckpoint", "crossJoin", "toPandas", "_jvm", "_jdf", "groupByKey", ".rdd", "except Import"):
        assert word not in text
    # Each of these is of a table whose size is bounded, as said beside it.
    allowed = {"sharding.py": 1, "packing.py": 1, "license_scan.py": 1, "language_id.py": 2, "quality.py": 1, "ranked_search.py": 2, "resampling.py": 1}
    assert len(re.findall(r"\.collect\(\)|\.toArrow\(\)|toLocalIterator", text)) <= allowed.get(path.name, 0)
