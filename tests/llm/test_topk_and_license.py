import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftmine.llm import exact_topk, license_scan

from .helpers import EDGES, LONG, frame


def brute_force(rows, k):
    usable = [
        (i, np.floor(1024 * np.array(v, dtype=np.float64)).astype(np.int64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    width = max([len(v) for _, v in usable], default=0)
    usable = [(i, np.pad(v, (0, width - len(v)))) for i, v in usable]
    out = []
    for q, vector in usable:
        if q % 100:
            continue
        scored = sorted((-int(vector @ other), i) for i, other in usable if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, `block` int, ids int, `index` int, bound int")
    found = exact_topk.top_k(df, F.col("vec_id") % 100 == 0, k)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_search_is_exact(spark, spread, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(exact_topk, "BUNDLE_BLOCKS", 5)
    monkeypatch.setattr(exact_topk, "FIRST_BLOCKS", (1, 2))
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 6))
    rows = [(i, (centres[i // 60] + spread * rng.normal(size=6)).astype(np.float32).tolist()) for i in range(700)]
    full = [(*row, None, None, None, None) for row in rows]
    assert search(spark, full) == brute_force(rows, 10)


def test_search_edges(spark):
    rows = [
        (0, [1.0, -2.0]), (100, [0.5, 0.5]), (100, [0.5, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]), (None, [9.0, 9.0]), (5, [1.0, -2.0]), (6, [1.0, -2.0]), (7, [3.0]), (8, []), (-100, [1e-9, -1e-9]),
    ]
    found = search(spark, [(*row, None, None, None, None) for row in rows], k=4)
    assert found == brute_force(rows, 4)
    assert search(spark, []) == []
    assert search(spark, [(0, [1.0], None, None, None, None)]) == []


def test_large_components(spark):
    rows = [(0, [2.0e6, 1.0]), (1, [-2.0e6, 3.0]), (2, [2.0e6, 2.0]), (3, [3.0e5, 1.0])]
    assert search(spark, [(*row, None, None, None, None) for row in rows]) == brute_force(rows, 10)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    words = WORD.findall(lowered(text))
    places = []
    for phrase, label in license_scan.BASE_PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return words, places


def covered(text, threshold=license_scan.THRESHOLD):
    """Labels of templates that some window contains, by trying all."""
    words = WORD.findall(lowered(text))
    labels, best = set(), 0.0
    every = license_scan.TEMPLATES
    words_by = {label: {w for line in lines for w in line.split()} for label, lines in every.items()}
    for start in range(0, max(len(words), 1), 32):
        if start and start + 32 >= len(words):
            continue
        block = set(words[start : start + 64])
        for label, lines in license_scan.TEMPLATES.items():
            for line in lines:
                own = set(line.split())
                share = len(own & block) / len(own)
                elsewhere = {w for other, ws in words_by.items() if other != label for w in ws}
                if len(own) < license_scan.SHORT and not own - elsewhere <= block:
                    continue
                if block & set(license_scan.EXCLUDED.get(label, ())):
                    continue
                if share >= threshold - 1e-9:
                    labels.add(label)
                    best = max(best, share)
    return labels, best


TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "x CC BY cc-by cc by by mit MIT license, mit\nLicense",
    "This work is licensed under the GNU General Public License, version 3.",
    "the mit licenses and gnu general public; license",
    "permission is hereby granted, free of charge, to any\nperson obtaining a copy of\nsoftware",
    "word " * 90 + "redistribution and use in source and binary forms, with or without modification, are permitted",
    "licence éMIT license MIT licenseé",
    "apache license " * 50,
    LONG + " released under the mit license",
]


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under CC BY 4.0", "cc-by"),
        ("licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"),
        ("released under the Apache License", "apache"),
        ("released under the BSD license", ""),
        ("This work is licensed under Creative Commons Attribution-NonCommercial", "cc-by-nc"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
        ("released under the MIT license", "mit"),
        ("Redistributions of source code must retain the above copyright notice, this list of conditions "
         "and the following disclaimer.", "bsd"),
    ],
)
def test_common_notices(spark, text, labels):
    found = license_scan.scan(frame(spark, [(1, text), (2, f"some words before {text} and after")]))
    shown = found.select(license_scan.label_columns()["labels"].alias("labels")).collect()
    assert [r["labels"] for r in shown] == [labels] * 2


def test_scan_equals_brute_force(spark):
    rng = random.Random(6)
    pool = [w for lines in license_scan.TEMPLATES.values() for line in lines for w in line.split()]
    rows = EDGES + [(100 + i, text) for i, text in enumerate(TEXTS)]
    rows += [(300 + i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 200)))) for i in range(150)]
    for i in range(60):
        line = rng.choice([line for lines in license_scan.TEMPLATES.values() for line in lines]).split()
        for _ in range(rng.randint(0, 4)):
            line[rng.randrange(len(line))] = "zzz"
        rng.shuffle(line)
        rows.append((600 + i, "filler " * rng.randint(0, 70) + " ".join(line) + " filler" * rng.randint(0, 70)))
    names = license_scan.label_columns()
    found = license_scan.scan(frame(spark, rows)).select(
        F.col("text").alias("_t"), "n_words", *[c.alias(n) for n, c in names.items()]
    )
    for r in found.collect():
        words, places = base(r["_t"])
        labels, best = covered(r["_t"])
        assert r["n_words"] == len(words)
        assert r["n_base"] == len(places)
        assert (r["first_word"], r["last_word"]) == (
            (min(places)[0], max(places)[0]) if places else (None, None)
        )
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert r["labels"] == ",".join(sorted({label for _, label in places} | labels))
        assert r["score"] == pytest.approx(1.0 if places else best)
    assert license_scan.scan(frame(spark, [])).count() == 0
