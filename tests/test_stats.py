import hashlib
from collections import Counter

import pytest

from siftmine.functions.values import INT_MAX, INT_MIN, saturating_int
from siftmine.operators import stats
from siftmine.plans import jobs

SURVEY = [
    ("Chile", "1000", "Monthly"),
    ("Chile", "1,000", "Weekly"),
    ("Chile", "abc", "Yearly"),
    ("Chile", "NA", "Yearly"),
    ("Chile", "0", "Monthly"),
    ("Chile", "0.0", None),
    ("Chile", None, "Monthly"),
    ("Iran, Islamic Republic", "99.9", "NA"),
    ("Iran Islamic Republic", "3e9", "Yearly"),
    (None, "7", "Yearly"),
]


@pytest.fixture
def survey(spark):
    return spark.createDataFrame(SURVEY, "country string, salary string, salary_type string")


def test_sentinel_filter_null_modes(survey):
    assert stats.sentinel_filter(survey, "salary", nulls="keep").count() == 8
    kept = stats.sentinel_filter(survey, "salary", nulls="drop")
    assert kept.count() == 7
    assert kept.filter("salary = '0.0'").count() == 1
    with pytest.raises(ValueError):
        stats.sentinel_filter(survey, "salary", nulls="other")


def test_annualise(survey, rows):
    found = rows(stats.annualise(survey, "salary", "salary_type"))
    assert found[:3] == [("Chile", 12000.0), ("Chile", 52000.0), ("Chile", None)]
    assert found[7] == ("Iran, Islamic Republic", 99.9)
    fifty = rows(stats.annualise(survey, "salary", "salary_type", {"Weekly": 50}))
    assert fifty[0] == ("Chile", 1000.0) and fifty[1] == ("Chile", 50000.0)


def test_group_stats_merges_names_and_ignores_unparsable(survey, rows):
    found = rows(jobs.salary_statistics(survey))
    assert found == [
        (None, 1, 7.0, 7.0, 7.0),
        ("Chile", 3, 0.0, 52000.0, 21333.33),
        ("Iran Islamic Republic", 2, 99.9, 3e9, 1500000049.95),
    ]


def test_group_stats_saturates(survey, rows):
    found = {row[0]: row[2:4] for row in rows(jobs.salary_statistics(survey, int_mode="saturate"))}
    assert found["Iran Islamic Republic"] == (99, INT_MAX)


def test_saturating_int(spark, rows):
    df = spark.createDataFrame([(1.9,), (-1.9,), (-1e12,), (1e12,), (None,)], "x double")
    assert [r[0] for r in rows(df.select(saturating_int(df.x)))] == [1, -1, INT_MIN, INT_MAX, None]


def test_total_is_first_and_null_key_is_no_total(survey, rows):
    found = rows(jobs.salaried_by_country(survey).select("country", "n", "sort_flag"))
    assert found[0] == ("Total", 8, 0)
    assert (None, 1, 1) in found
    # Names are cleaned after grouping here, so both spellings stay apart.
    assert found.count(("Iran Islamic Republic", 1, 1)) == 2
    assert sum(n for _, n, flag in found if flag) == 8


def test_align_metrics_keeps_every_key(spark, rows):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "k string, b int")
    found = rows(stats.align_metrics([a, b], ["k"]), "k")
    assert found == [("x", 1, None), ("y", 2, 3), ("z", None, 4)]


def test_partition_profile_repartitions(spark, rows):
    df = spark.range(100).selectExpr("id % 3 as k")
    found = rows(stats.partition_profile(df, "k", 2))
    assert len(found) <= 2 and sum(n for _, n in found) == 100
    assert jobs.partition_comparison(df, "k", 2).filter("layout = 'partition'").count() <= 2


def test_md5_layout_names_the_partitions(spark, rows):
    keys = ["a", "b", "c", None, "", "a", "é"]
    df = spark.createDataFrame([(key,) for key in keys], "k string")
    found = stats.partition_profile(df, "k", 3, "md5").collect()
    expected = Counter(int(hashlib.md5((key or "").encode()).hexdigest()[:8], 16) % 3 for key in keys)
    assert {r["partition"]: r["rows"] for r in found} == expected
    assert stats.partition_profile(df.limit(0), "k", 3, "md5").count() == 0
    with pytest.raises(ValueError):
        stats.partition_profile(df, layout="md5")


def test_preview(spark, rows):
    assert [r[0] for r in rows(stats.preview(spark.range(50), 3, ["id"]))] == [0, 1, 2]
