"""Every registered query against its SQL, and rules for plans and sources."""

import contextlib
import io
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from siftmine.plans.registry import QUERIES
from siftmine.plans.sql import ORACLE

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(table):
    columns = sorted(table.column_names)
    return sorted(map(repr, zip(*(table.column(name).to_pylist() for name in columns))))


def _types(table):
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    result = QUERIES[name](spark, FOLDER)
    found = result.toArrow()
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        result.explain()
    assert "CartesianProduct" not in plan.getvalue()
    assert "BroadcastNestedLoopJoin" not in plan.getvalue()
    if name not in ORACLE:
        assert found.num_rows > 0
        return
    expected = tables.sql(ORACLE[name]).to_arrow_table()
    assert _types(found) == _types(expected)
    assert _rows(found) == _rows(expected)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 25


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


SOURCES = [p for p in sorted((ROOT / "siftmine").rglob("*.py")) if "llm" not in p.parts]

# Reads to the driver, each of a table whose size is bounded by a parameter or a single row.
TO_DRIVER = {
    "operators/clustering.py": 4,
    "operators/features.py": 1,
    "operators/ids.py": 1,
    "operators/itemsets.py": 1,
    "operators/sampling.py": 1,
    "plans/inputs.py": 3,
    "plans/registry.py": 1,
    "streaming/jobs.py": 4,
}


@pytest.mark.parametrize("path", SOURCES, ids=lambda p: f"{p.parent.name}/{p.name}")
def test_sources_keep_to_the_rules(path):
    text = path.read_text()
    for word in ("localCheckpoint", "crossJoin", "toPandas", "_jvm", "_jdf", "groupByKey", ".rdd", "mkdtemp"):
        assert word not in text
    assert not re.search(r"^MAX_", text, re.M)
    reads = re.findall(r"\.(?:collect|toArrow|first|scalar|toLocalIterator)\(\)", text)
    assert len(reads) <= TO_DRIVER.get(f"{path.parent.name}/{path.name}", 0)
