import hashlib
import re

import pytest

from siftmine.llm import exact_dedup

from .helpers import EDGES, frame


def digest(text):
    return hashlib.sha256(re.sub("[ \t\n\x0b\x0c\r]+", " ", text or "").encode()).hexdigest()


def expected(rows):
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(digest(row[1]), []).append((row[0] is None, row[0] or 0, i, row[0]))
    out = []
    for h, members in groups.items():
        stays = min(members)
        repeated = {m[2] for m in members if m[3] == stays[3]}
        out.append((h, stays[3], len(members), len(repeated)))
    return sorted(out)


def figures(found):
    by = {}
    for row in found:
        by.setdefault(row["text_sha256"], []).append(row)
    return by


@pytest.mark.parametrize("rows", [EDGES, [(i, f"copy {i % 2 if i < 40 else i}") for i in range(60)]])
def test_groups(spark, rows):
    docs = frame(spark, rows)
    for ranges in (1, 4):
        check_groups(exact_dedup.deduplicate(docs, ranges=ranges).collect(), rows)
    check_groups(exact_dedup.new_index(spark, 10).add(docs, "a").collect(), rows)


def check_groups(found, rows):
    assert len(found) == len(rows)
    by = figures(found)
    for h, keep, size, _ in expected(rows):
        members = by[h]
        assert len(members) == size
        assert {m["keep_id"] for m in members} == {keep}
        assert {m["group_size"] for m in members} == {size}
        kept = [m for m in members if m["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == keep


def test_later_batches_meet_the_index(spark):
    index = exact_dedup.new_index(spark, 10)
    assert {r["doc_id"] for r in index.add(frame(spark, [(7, "a  b"), (8, "c")]), "a").collect() if r["kept"]} == {7, 8}
    again = {r["doc_id"]: r for r in index.add(frame(spark, [(1, "a b"), (2, "d"), (3, "d")]), "b").collect()}
    assert (again[1]["keep_id"], again[1]["kept"]) == (7, False)
    assert (again[2]["keep_id"], again[2]["kept"], again[2]["group_size"]) == (2, True, 2)
    assert not again[3]["kept"]
    assert index.rows().count() == 3


def test_a_whole_table_meets_its_own_index(spark, monkeypatch):
    """Later ranges of ids bring digests that earlier ones have, and the anti-join removes them."""
    rows = [(i, f"text {i % 10}") for i in range(40)]
    seen = []
    real = exact_dedup.settle

    def settled(df, purpose):
        out = real(df, purpose)
        if purpose == "new-digests":
            seen.append(out.count())
        return out

    monkeypatch.setattr(exact_dedup, "settle", settled)
    found = exact_dedup.deduplicate(frame(spark, rows), ranges=4).collect()
    assert len(seen) == 4 and seen[0] == 10 and sum(seen) == 10
    check_groups(found, rows)


def test_a_batch_that_failed_runs_again(spark, monkeypatch):
    """The append is done, the result is lost: the same batch keeps its rows, another does not."""
    index = exact_dedup.new_index(spark, 10)
    docs = frame(spark, [(1, "a"), (2, "b"), (3, "b")])
    real = exact_dedup.settle

    def failing(df, purpose):
        if purpose == "digest-figures":
            raise RuntimeError("lost")
        return real(df, purpose)

    monkeypatch.setattr(exact_dedup, "settle", failing)
    with pytest.raises(RuntimeError, match="lost"):
        index.add(docs, "first")
    monkeypatch.setattr(exact_dedup, "settle", real)
    assert index.rows().count() == 2
    assert {r["doc_id"] for r in index.add(docs, "first").collect() if r["kept"]} == {1, 2}
    assert not [r for r in index.add(docs, "second").collect() if r["kept"]]
    assert index.rows().count() == 2


def test_an_index_is_opened_anew(spark):
    index = exact_dedup.new_index(spark, 10)
    index.add(frame(spark, [(5, "a"), (6, "b")]), "first")
    index.close()
    assert not spark.catalog.tableExists(index.table)
    again = exact_dedup.DigestIndex.open(spark, index.path)
    assert again.buckets == index.buckets and again.rows().count() == 2
    found = {r["doc_id"]: r["keep_id"] for r in again.add(frame(spark, [(1, "a"), (2, "c")]), "second").collect()}
    assert found == {1: 5, 2: 2} and again.rows().count() == 3


def test_anti_join_reads_the_index_in_buckets(spark):
    index = exact_dedup.new_index(spark, 10)
    index.add(frame(spark, [(1, "a")]), "a")
    new = spark.createDataFrame([("x",)], "digest string")
    plan = new.join(index.rows().hint("merge"), "digest", "left_anti")._jdf  # noqa: SLF001
    text = plan.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    # The new side alone is shuffled.
    assert text.count("Exchange") == 1


def test_empty(spark):
    assert exact_dedup.deduplicate(frame(spark, [])).count() == 0
    assert exact_dedup.drop_copies(frame(spark, [])).count() == 0


def test_drop_copies(spark):
    docs = frame(spark, EDGES)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect())
    # 2 and 3 are both empty, 4 and 5 equal; 6 is a single space.
    assert ids == sorted(["1", "2", "None", "4", "6", "7", "8", "9"])
