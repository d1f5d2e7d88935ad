import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from siftmine.llm import packing, token_counts
from siftmine.llm.vocabulary import BYTE_BPE, plain_encoder

from .helpers import EDGES, frame

POOL = [
    "'s", "'re", "'ll", "'v", "'r", "'", "''", " ", "  ", "\n", "\t\n", "a", "Hello", " world", "123", "%%", "é",
    "中文", "\u0085", "\x1c", "\x00", "<|endoftext|>", "don't", "'l", "s", "😀", "١٢", "aaaaaaaa", "​",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return made + ["a" * 5000, " " * 3000 + "x", "'" * 999, "ab1" * 4000, "'s" * 700, "I'll've"]


def by_library(texts):
    encoder = plain_encoder(BYTE_BPE)
    return [len(e.ids) for e in encoder.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(texts):
    counter = token_counts.TokenCounter(token_counts.VOCABULARY)
    assert counter.count(texts).tolist() == by_library(texts)
    assert counter.count([None, ""]).tolist() == [0, 0]


def test_counts_in_slices_and_small_memos(texts, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 23)
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", 5)
    monkeypatch.setattr(token_counts, "HEAD_CHARS", 2)
    monkeypatch.setattr(token_counts, "MEMO_WORDS", 10)
    monkeypatch.setattr(token_counts, "MEMO_TRANSITIONS", 50)
    some = texts[:400] + texts[-2:]
    counter = token_counts.TokenCounter(token_counts.VOCABULARY)
    assert counter.count(some).tolist() == by_library(some)


def test_scan_composes_maps():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 13, size=(37, 13), dtype=np.uint8)
    scanned = token_counts.compose_scan(maps)
    state = np.arange(13)
    for i, step in enumerate(maps):
        state = step[state]
        assert (scanned[i] == state).all()


def test_borders_are_those_of_the_merges():
    merger = token_counts.token_counter(token_counts.VOCABULARY).merger
    rng = random.Random(9)
    encoder = plain_encoder(BYTE_BPE)
    words = ["".join(rng.choice("theanrsiou") for _ in range(rng.randint(1, 14))) for _ in range(2000)]
    counts = [merger.count(word) for word in words]
    assert counts == [len(encoder.encode(word).ids) for word in words]


def test_token_column(spark):
    docs = frame(spark, EDGES)
    found = token_counts.with_token_counts(docs, limit=6).collect()
    values = [(r["text"] or "") for r in found]
    assert [r["n_tokens"] for r in found] == by_library(values)
    assert [r["n_bytes"] for r in found] == [len(v.encode()) for v in values]
    assert all(r["over_limit"] == (r["n_tokens"] > 6) for r in found)
    assert token_counts.with_token_counts(frame(spark, [])).count() == 0


def best_packing(sizes, capacity):
    """Fewest sequences, by trying everything."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for at, room in enumerate(rooms):
            if room >= sizes[i] and room not in rooms[:at]:
                place(i + 1, (*rooms[:at], room - sizes[i], *rooms[at + 1 :]))
        place(i + 1, (*rooms, capacity - sizes[i]))

    place(0, ())
    return best


def test_plans():
    rng = random.Random(4)
    for _ in range(400):
        capacity = rng.choice([7, 10, 20, 1024])
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 9))), reverse=True)
        counts = Counter(sizes)
        plan = packing.packing_plan(dict(counts), capacity)
        used = Counter()
        for pattern, times in plan:
            assert times > 0 and 0 < sum(pattern) <= capacity
            for size in pattern:
                used[size] += times
        assert used == counts
        fixed = packing._fix_dominant(dict(counts), capacity)
        left = Counter(sizes)
        for pattern, times in fixed:
            for size in pattern:
                left[size] -= times
        rest = sorted(left.elements(), reverse=True)
        # What is fixed belongs to some best packing.
        assert sum(t for _, t in fixed) + best_packing(rest, capacity) == best_packing(sizes, capacity)


def test_plan_is_near_the_bound():
    rng = random.Random(8)
    counts = {size: rng.randint(1, 3000) for size in range(1, 1025)}
    used = sum(times for _, times in packing.packing_plan(counts))
    assert used <= 1.03 * sum(size * n for size, n in counts.items()) / 1024
    assert used <= sum(times for _, times in packing._best_fit(dict(counts), 1024))
    with pytest.raises(ValueError):
        packing.packing_plan({1025: 1})


def test_documents_are_packed_whole(spark):
    rows = EDGES + [(100 + i, "some words " * (i % 150)) for i in range(200)]
    found = packing.pack_documents(frame(spark, rows).repartition(3)).collect()
    places = defaultdict(list)
    for r in found:
        assert len(r["ids"]) == 4 * r["length"] and 1 <= r["length"] <= 1024
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    encoder = plain_encoder(BYTE_BPE)
    pieces = defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["ids"]))
    for doc_id, group in itertools.groupby(sorted(rows, key=lambda row: str(row[0])), key=lambda row: row[0]):
        same = list(group)
        ids = [*encoder.encode(same[0][1] or "", add_special_tokens=False).ids, packing.END_ID]
        want = np.array(ids, "<u4").tobytes()
        for n in {piece for piece, _, _ in pieces[doc_id]}:
            assert sum(piece == n for piece, _, _ in pieces[doc_id]) == len(same)
        got = sorted(set(pieces[doc_id]))
        assert b"".join(part for _, _, part in got) == want
        assert [4 * start for _, start, _ in got] == [
            sum(len(part) for _, _, part in got[:n]) for n in range(len(got))
        ]
        assert all(len(part) == 4096 for _, _, part in got[1:])
    assert packing.pack_documents(frame(spark, [])).count() == 0


def test_long_white_space_has_the_same_ids():
    text = " " * 10_050 + "a"
    assert packing.token_ids(text).tolist() == plain_encoder(BYTE_BPE).encode(text).ids
