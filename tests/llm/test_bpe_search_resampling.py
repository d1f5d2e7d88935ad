"""Byte BPE, ranked search and importance resampling against brute force."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftmine.llm import byte_bpe, ranked_search, resampling, words
from siftmine.llm.registry import QUERIES

from .helpers import EDGES, LONG, frame

FOLDER = "/root/testdata/sf0.001"


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def benchmark(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]


def find_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aZ9[`{/:@ \n\x85\xa0é中😀\x00\x7f")))
def test_words(text):
    assert [w.decode() for w in words.words_of(text.encode())] == find_words(text)


# Byte BPE


def own_ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


RANKS = own_ranks()


def merged(match):
    """Ids of one match by the definition: the pair with the lowest rank first, the leftmost of equal ones."""
    parts = [bytes([b]) for b in match.encode()]
    while len(parts) > 1:
        rank, at = min((RANKS.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
        if rank == 1 << 30:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [RANKS[part] for part in parts]


def brute_ids(text):
    return [i for match in regex.findall(public_tokenizers.PATTERN, text or "") for i in merged(match)]


AWKWARD = st.text(st.sampled_from("ab's't're 1２\n\t   \x85\x1cé中😀<|>.!"), max_size=120)


@settings(max_examples=300, deadline=None)
@given(AWKWARD, st.integers(1, 9), st.integers(2, 6))
def test_cutting_changes_nothing(text, piece_chars, long_run):
    found = byte_bpe.encode_text(text, piece_chars=piece_chars, long_run=long_run).tolist()
    assert found == brute_ids(text)
    assert "".join(piece for piece, _ in byte_bpe.pieces(text, piece_chars, long_run)) == text


@pytest.mark.parametrize("text", [" " * 300_000, "a" * 300_000, "x " * 200_000 + " \n" * 100_000 + "y", LONG])
def test_long_texts(text):
    ids = byte_bpe.encode_text(text)
    assert byte_bpe.rank_encoding(byte_bpe.RANKS).decode_bytes(ids.tolist()) == text.encode()
    if text is LONG:
        whole = byte_bpe.rank_encoding(byte_bpe.RANKS).encode_ordinary(text)
        assert ids.tolist() == whole


def test_bpe_columns(spark):
    docs = frame(spark, EDGES).withColumn("ids", F.lit("old"))
    rows = byte_bpe.decode(byte_bpe.encode(docs)).select("text", "ids", "decoded", "lang").collect()
    assert len(rows) == len(EDGES)
    for row in rows:
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
        if row["text"] != LONG:
            assert row["ids"] == brute_ids(row["text"])
    null = spark.createDataFrame([(None,), ([],), ([50255, 220],)], "ids array<int>")
    found = [row["decoded"] for row in byte_bpe.decode(null).collect()]
    by_rank = {v: k for k, v in RANKS.items()}
    assert found[0] is None and bytes(found[1]) == b"" and bytes(found[2]) == by_rank[50255] + by_rank[220]
    empty = byte_bpe.decode(byte_bpe.encode(frame(spark, [])))
    assert empty.count() == 0 and dict(empty.dtypes)["ids"] == "array<int>"


def test_bpe_query(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op12_byte_bpe"](spark, FOLDER).collect()}
    texts = documents(spark)
    assert len(rows) == len(texts)
    for doc, text in texts:
        ids = brute_ids(text) if len(text or "") < 3000 else byte_bpe.rank_encoding(byte_bpe.RANKS).encode_ordinary(text)
        row = rows[doc]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


# Ranked search


def brute_search(docs, items, k):
    held = [(doc, Counter(find_words(text))) for doc, text in docs if doc is not None]
    held = [(doc, terms) for doc, terms in held if terms]
    n_docs, total = len(held), sum(sum(terms.values()) for _, terms in held)
    df = Counter(term for _, terms in held for term in terms)
    out = []
    for item, text in items:
        scored = []
        for doc, terms in held:
            n = sum(terms.values())
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * terms[t]) // (1000 * terms[t] + 20 * m))
                for t in set(find_words(text))
                if t in terms
            )
            if score > 0:
                scored.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, k):
    index = ranked_search.build_index(frame(spark, docs))
    asked = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, item int, term string")
    found = ranked_search.search(index, asked, k=k).drop("item").collect()
    return sorted(map(tuple, found), key=repr)


def test_search_on_awkward_tables(spark):
    items = [(1, "Alpha BETA alpha"), (2, None), (3, ""), (4, "same text"), (None, "lorem 中文"), (5, "unknown"), (6, "id text")]
    assert searched(spark, EDGES, items, 3) == brute_search([r[:2] for r in EDGES], items, 3)
    assert searched(spark, [], items, 3) == searched(spark, EDGES, [], 3) == []
    assert searched(spark, [(1, None), (2, "...")], items, 3) == []


@pytest.mark.parametrize("limits", [(16_000_000, 512, 256), (400, 1, 2), (1500, 3, 4)])
def test_search_with_ties_over_many_shards(spark, monkeypatch, limits):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", limits[0])
    monkeypatch.setattr(ranked_search, "WIDTH", limits[1])
    monkeypatch.setattr(ranked_search, "ITEM_BLOCK", limits[2])
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = [(i * 7 % 101, " ".join(draw.choices(vocabulary, range(40, 0, -1), k=draw.choice([2, 3, 20])))) for i in range(150)]
    docs += [(500 + i, "w1 w39") for i in range(40)]
    items = [(i, " ".join(draw.sample(vocabulary, 5))) for i in range(5)]
    assert searched(spark, docs, items, 10) == brute_search(docs, items, 10)


def test_treap_cells():
    draw = random.Random(1)
    cells = {(draw.randrange(50), draw.randrange(9)): draw.randrange(1, 1000) for _ in range(120)}
    rows, columns = np.array(list(cells), np.int64).T
    values = np.array(list(cells.values()), np.int64)
    height = 6
    treap = ranked_search.Treap(height, *ranked_search.build_treap(rows, columns, values, height))
    none = np.zeros(0, np.int64)
    opened = Counter()
    for row in range(50):
        scores, ids = ranked_search.search_treap(treap, np.array([row]), np.array([1]), np.arange(64), (none, none), 99)
        assert dict(zip(ids.tolist(), scores.tolist())) == {c: v for (r, c), v in cells.items() if r == row}
        assert scores.tolist() == sorted(scores.tolist(), reverse=True)
        opened[row] = len(ids)
    assert sum(opened.values()) == len(cells)


def test_ranges_below_the_kth_score_stay_closed(monkeypatch):
    """One document is far ahead: of the others' ranges only those on its way are opened."""
    columns = np.arange(1024)
    values = np.where(columns == 700, 100_000, 10)
    treap = ranked_search.Treap(10, *ranked_search.build_treap(np.zeros(1024, np.int64), columns, values, 10))
    none, opened = np.zeros(0, np.int64), []
    real = ranked_search._opened
    monkeypatch.setattr(ranked_search, "WIDTH", 1)
    monkeypatch.setattr(ranked_search, "_opened", lambda *a: opened.append(len(a[1].prefix)) or real(*a))
    scores, ids = ranked_search.search_treap(treap, np.array([0]), np.array([3]), columns, (none, none), 1)
    assert (scores.tolist(), ids.tolist()) == ([300_000], [700])
    assert sum(opened) == 10


# Importance resampling


def brute_features(text):
    found = find_words(text)
    return [" ".join(found[i : i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)], len(found)


def brute_resampling(docs, target, percent=5, least_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    features = [brute_features(text) for _, text in docs]
    s = Counter(bucket(f) for found, _ in features for f in found)
    t = Counter(bucket(f) for text in target for f in brute_features(text)[0])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    rows = []
    for (doc, _), (found, n_words) in zip(docs, features):
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None, n_words])
    ranked = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(ranked[: len(ranked) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_resampling_query(spark):
    found = QUERIES["op13_target_resampling"](spark, FOLDER)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {kind for _, kind in found.dtypes} == {"bigint"}
    expected = brute_resampling(documents(spark), [text for _, text in benchmark(spark)])
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    assert sum(row[4] is not None for row in expected) > 5


def test_resampling_on_awkward_tables(spark):
    target = spark.createDataFrame([("alpha beta",), (None,), ("",)], "text string")
    for rows in (EDGES, EDGES * 3, []):
        docs = frame(spark, rows).drop("score")
        model = resampling.gains(docs, target)
        found = resampling.draw(resampling.weigh(docs, model).drop("text"), percent=40, least_words=3)
        names = ["doc_id", "n_features", "weight", "score", "rank"]
        expected = brute_resampling([r[:2] for r in rows], ["alpha beta", None, ""], 40, 3)
        assert sorted(map(tuple, found.select(names).collect()), key=repr) == expected
    none = resampling.gains(frame(spark, EDGES), target.filter("false"))
    assert none.count() == resampling.BUCKETS


def test_resample_keeps_documents_whole(spark):
    docs = frame(spark, EDGES)
    target = spark.createDataFrame([("lorem ipsum dolor",)], "text string")
    drawn = resampling.resample(docs, target, percent=50, least_words=1).collect()
    assert len(drawn) == sum(bool(find_words(r[1])) for r in EDGES) // 2
    assert sorted(r["rank"] for r in drawn) == list(range(1, len(drawn) + 1))
    assert {(r["doc_id"], r["text"], r["lang"], r["source"]) for r in drawn} <= set(EDGES)
    expected = brute_resampling([r[:2] for r in EDGES], ["lorem ipsum dolor"], 50, 1)
    assert {(r["doc_id"], r["score"], r["rank"]) for r in drawn} == {(d, s, r) for d, _, _, s, r in expected if r}


def test_crc_matrices(monkeypatch):
    monkeypatch.setattr(resampling, "LONG_FEATURE", 40)
    monkeypatch.setattr(resampling, "MATRIX_BYTES", 64)
    draw = random.Random(3)
    raw = bytes(draw.randrange(256) for _ in range(3000))
    lengths = np.array([draw.randrange(0, 90) for _ in range(400)])
    starts = np.array([draw.randrange(3000 - n) for n in lengths])
    found = resampling.crc32_of(np.frombuffer(raw, np.uint8), starts, lengths)
    assert found.tolist() == [zlib.crc32(raw[s : s + n]) for s, n in zip(starts, lengths)]


def test_slices_change_nothing(monkeypatch):
    texts = [t.encode() if t else t for t in ("a b c a b c", None, "", "x", "b c d e " * 50)]
    whole = [resampling.feature_buckets(part) for part in resampling._slices(texts)]
    monkeypatch.setattr(resampling, "SLICE_BYTES", 1)
    parts = [resampling.feature_buckets(part) for part in resampling._slices(texts)]
    total = lambda found: Counter(int(b) for part in found for _, buckets in part for b in buckets)
    assert len(whole) == 1 < len(parts) and total(whole) == total(parts)
