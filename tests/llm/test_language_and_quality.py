import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftmine.llm import language_id, quality

from .helpers import EDGES, LONG, frame

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_held_out_accuracy(spark, documents):
    docs = documents.withColumn("held_out", language_id.held_out())
    model = language_id.fit(docs.filter("not held_out"))
    found = language_id.predict(docs, model).filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)
    sure = [r for r in found if r["accepted"]]
    assert len(sure) >= 0.9 * len(found)
    assert sum(r["lang"] == r["lang_pred"] for r in sure) >= 0.97 * len(sure)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_edges(spark):
    docs = frame(spark, EDGES)
    model = language_id.fit(docs)
    assert sorted(model) == ["de", "en"]
    assert all(len(content) <= language_id.DICTIONARY_BYTES for content in model.values())
    found = {(r["doc_id"], r["text"]): r for r in language_id.predict(docs, model).collect()}
    for (_, text), r in found.items():
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
        else:
            assert r["lang_pred"] in model
    assert found[8, LONG]["lang_pred"] == "en"
    empty = frame(spark, [])
    assert language_id.fit(empty) == {}
    assert language_id.predict(empty, {}).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(docs, {}).collect()} == {"und"}
    one = language_id.predict(docs, {"en": b"x"}).filter("doc_id = 1").first()
    assert (one["lang_pred"], one["score"]) == ("en", 1.0)


def test_rows_with_equal_ids_teach_too(spark):
    rows = [(None, f"text number {i}", "en") for i in range(1500)] + [(i % 2, f"texte numéro {i}", "fr") for i in range(1500)]
    model = language_id.fit(frame(spark, rows))
    assert {lang: content.count(b"\n") + 1 for lang, content in model.items()} == {"en": 256, "fr": 256}


def test_sample_is_bounded(spark):
    docs = frame(spark, [(i, f"text number {i} " * 100, "en") for i in range(400)])
    model = language_id.fit(docs)
    assert len(model["en"]) <= language_id.SAMPLE_DOCS * (language_id.SAMPLE_CHARS + 1)


# Quality


def brute_force(texts):
    """Probabilities of a small model by its definition: {n-gram: p}."""
    grams = Counter()
    for text in texts:
        padded = [0] * (quality.ORDER - 1) + [byte + 1 for byte in text.encode()]
        grams.update(tuple(padded[i : i + quality.ORDER]) for i in range(len(padded) - quality.ORDER + 1))
    counts = {quality.ORDER: grams}
    for n in range(quality.ORDER - 1, 0, -1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])
    cuts = {n: quality.discounts(*[sum(c == k for c in counts[n].values()) for k in (1, 2, 3, 4)]) for n in counts}

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / quality.SYMBOLS
        around = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        if not around:
            return p(gram[1:])
        cut = lambda c: cuts[n][min(c, 3) - 1] if c else 0.0
        own = counts[n].get(gram, 0)
        left = sum(cut(c) for c in around.values())
        return (max(own - cut(own), 0) + left * p(gram[1:])) / sum(around.values())

    return p


def grams_of(text):
    padded = [0] * (quality.ORDER - 1) + [byte + 1 for byte in text.encode()]
    return [tuple(padded[i : i + quality.ORDER]) for i in range(len(padded) - quality.ORDER + 1)]


def test_probabilities(spark):
    """Of n-grams that the trusted text has, and of those that only other text has."""
    texts = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "thé ça"]
    model = quality.train(quality.ngram_counts(frame(spark, [(i, t, "en") for i, t in enumerate(texts)]), "text"))
    assert model.grams[quality.ORDER].count() == len({g for t in texts for g in grams_of(t)})
    asked = frame(spark, [(i, t, "en") for i, t in enumerate([*texts, "the zebra", "中文中文", "zzzz qqqq", "Ω"])])
    wanted = quality.ngram_counts(asked, "text")
    found = {row["gram"]: row["cost"] for row in quality.gram_costs(wanted, model).collect()}
    assert len(found) == wanted.count()
    p = brute_force(texts)
    sent = quality._SentModel(model).costs(np.array(list(found), np.int64))
    for (number, cost), other in zip(found.items(), sent):
        gram = tuple(number >> 9 * (quality.ORDER - 1 - i) & 511 for i in range(quality.ORDER))
        assert cost == pytest.approx(-math.log(p(gram)), rel=1e-9)
        assert other == pytest.approx(cost, rel=1e-9)
    # All that may follow a context adds up to one.
    assert sum(p((0, 0, 0, 0, s)) for s in range(quality.SYMBOLS)) == pytest.approx(1.0)


@pytest.mark.parametrize("most_sent", [10**9, 0])
def test_decisions_by_brute_force(spark, most_sent):
    """Perplexity, language-specific quantile and decision, also of documents that the model never saw."""
    rng = random.Random(6)
    words = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(40)] for lang, letters in
             (("en", "aeioulmnrst"), ("de", "äeiouchnrst"))}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(1, 12))), lang) for i in range(700) for lang in [rng.choice(["en", "de"])]]
    rows += [(700 + i, " ".join(rng.choices(words["en"], k=6)), "fr") for i in range(20)]
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    out = {r[0] for r in docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).select("doc_id").collect()}
    p = brute_force([text for i, text, _ in rows if i not in out])
    known = {}

    def cost(text):
        total = 0.0
        for gram in grams_of(text):
            known[gram] = known[gram] if gram in known else -math.log(p(gram))
            total += known[gram]
        return total / max(1, len(text.encode()))

    quantile = lambda values, share: sorted(values)[max(0, math.ceil(share * len(values)) - 1)]

    def limits(held):
        costs = [cost(text) for text in held]
        middle = quantile(costs, 0.5)
        excess = [(c - middle) * math.sqrt(len(t.encode())) for c, t in zip(costs, held)]
        return middle, quantile(excess, 1 - 0.1)

    by_lang = {lang: [t for i, t, l in rows if i in out and l == lang] for lang in ("en", "de", "fr")}
    own = {lang: limits(held) for lang, held in by_lang.items() if len(held) >= quality.MIN_DOCUMENTS}
    assert set(own) == {"en", "de"}
    rest = limits([t for held in by_lang.values() for t in held])

    model = quality.fit(docs, labels, rejected=0.1, most_sent=most_sent)
    assert model.sent == bool(most_sent)
    new = [(9000, "中文中文", "en"), (9001, "zzzz qqqq", "de"), (9002, "", "en"), (9003, None, None), (9004, "x", "xx"), (9005, rows[0][1], "en")]
    asked = rows[::7] + rows[700:] + new
    found = {r["doc_id"]: r for r in quality.score(frame(spark, asked), model).collect()}
    assert len(found) == len({r[0] for r in asked})
    for i, text, lang in asked:
        middle, excess = own.get(lang, rest)
        size = max(1, len((text or "").encode()))
        most, mine = middle + excess / math.sqrt(size), cost(text or "")
        assert found[i]["perplexity"] == pytest.approx(math.exp(mine), rel=1e-9)
        assert found[i]["max_perplexity"] == pytest.approx(math.exp(most), rel=1e-9)
        assert found[i]["kept"] == (mine <= most + quality.ROUNDING)
    assert not found[9000]["kept"] and not found[9001]["kept"] and found[9002]["kept"] and found[9003]["kept"]


def test_ngrams_of_slices(monkeypatch):
    text = "abcdefghij é" * 7
    whole = quality.ngrams(text.encode())
    monkeypatch.setattr(quality, "SLICE_BYTES", 10)
    parts = [grams for _, grams in quality._slices(iter([text]))]
    assert (np.concatenate(parts) == whole).all()


def test_junk_is_rejected_and_clean_text_stays(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = quality.judge(documents, labels).join(labels, "doc_id").collect()
    good = [r["kept"] for r in found if r["quality"] == 1 and not r["toxic"]]
    bad = [r["kept"] for r in found if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.25 * len(bad)


def test_toxic_documents_are_caught(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id").collect()
    clean = [r["kept"] for r in found if r["quality"] == 1 and not r["toxic"]]
    toxic = [r["kept"] for r in found if r["quality"] == 1 and r["toxic"]]
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(toxic) <= 0.8 * len(toxic)


def test_short_texts_are_judged_by_their_own_bytes(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    usual = lambda n: " ".join(rng.choice(words) for _ in range(n))
    # Long texts hold some numbers, which sets the quantile.
    rows = [(i, usual(5), "en") for i in range(600)]
    rows += [(1000 + i, f"{usual(300)} {rng.randrange(10**500)} {usual(300)}", "en") for i in range(300)]
    rows += [(2000 + i, text, "en") for i, text in enumerate(["?QZ#", "J&X%", "{<}$@"])]
    labels = spark.createDataFrame([(row[0], 1, 0) for row in rows if row[0] < 2000], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(frame(spark, rows), labels).collect()}
    assert not any(kept[2000 + i] for i in range(3))
    assert sum(kept[i] for i in range(600)) >= 0.99 * 600


def test_joins_give_the_same(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    some = documents.filter("doc_id < 150")
    ways = []
    for most in (10**9, 0):
        judged = quality.judge(some, labels, most_sent=most)
        ways.append({r["doc_id"]: (r["perplexity"], r["kept"]) for r in judged.collect()})
    assert ways[0].keys() == ways[1].keys()
    for key, (perplexity, kept) in ways[0].items():
        assert ways[1][key] == (pytest.approx(perplexity), kept)


def test_quality_edges(spark):
    docs = frame(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = quality.judge(docs, none).collect()
    assert len(judged) == len(EDGES) and all(r["kept"] for r in judged)
    labels = spark.createDataFrame(
        [(1, 1, 0), (4, 1, None), (8, 1, 0), (8, None, 1), (None, 1, 0), (99, 1, 0)], none.schema
    )
    judged = quality.judge(docs, labels).collect()
    assert len(judged) == len(EDGES)
    assert all(r["kept"] for r in judged if not r["text"])
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema
    assert quality.judge(frame(spark, []), labels).count() == 0


def test_discounts_are_in_range():
    for n in [(0, 0, 0, 0), (5, 0, 0, 0), (100, 40, 20, 10), (1, 9, 9, 9), (10**6, 10, 5, 100)]:
        for k, d in enumerate(quality.discounts(*n), 1):
            assert 0 < d < k and math.isfinite(d)
