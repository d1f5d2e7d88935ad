"""Quality classifier: perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model over the bytes of the
text, five at a time. A fifth of the trusted documents is kept out of the
counts. A document's excess is what its cross-entropy is above the median of
those of its language, times the square root of its length, as the mean of many
bytes varies less than that of few; so a few insults count in a long text too.
The excesses of those kept out, by language, give the quantile that a document
must not exceed.

N-grams are whole numbers. Tasks count those of the trusted text batch by
batch, so what is shuffled are distinct n-grams and their counts. Joins on
n-grams, contexts and shorter n-grams (sharded by hash) give the model order by
order: the cost of every n-gram that the trusted text has, and what it costs to
go on to the next shorter one where a context has not been followed by a
symbol. So any text can be scored, and the model grows with the trusted text
alone.

A document's perplexity is the sum of the costs of its n-grams. Where the model
is small (checked), it goes to every task; else the distinct n-grams of the
documents get their costs by joins with the sharded model, and are joined with
each document's counts. Both ways give the same figures.

Defined cases: trusted are documents that all labels call of good quality and
none toxic; a null or empty text has nothing against it and is kept; without
trusted text nothing is judged and all is kept; a null language is a language
of its own, and languages with few trusted documents use the threshold of all;
short texts are judged by their own bytes alone, with the room that their
length gives; texts are read whole, whatever their length; rows that repeat are
judged one by one; further columns are passed on, and columns that the result
adds replace columns of that name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import settle, small_batches, uncommon

ORDER = 5
#: A symbol is a byte and one, or 0 before the text begins.
SYMBOL_BITS = 9
SYMBOLS = 257
#: Bytes whose n-grams are counted at once.
SLICE_BYTES = 500_000
#: A model of so many n-grams and contexts (16 bytes each) is sent to every task; a larger one is joined.
BROADCAST_NGRAMS = 4_000_000
BROADCAST_IDS = 1_000_000
BROADCAST_LANGUAGES = 10_000
#: By how much sums in another order may differ.
ROUNDING = 1e-9
#: Share of the trusted documents of a language that may be rejected.
REJECTED = 0.005
#: Trusted documents that a language needs for a threshold of its own.
MIN_DOCUMENTS = 50


def ngrams(text: bytes) -> np.ndarray:
    """The n-gram that ends at each byte; the last symbol is in the lowest bits."""
    symbols = np.zeros(len(text) + ORDER - 1, dtype=np.int64)
    symbols[ORDER - 1 :] = np.frombuffer(text, np.uint8)
    symbols[ORDER - 1 :] += 1
    found = symbols[: len(text)].copy()
    for place in range(1, ORDER):
        found <<= SYMBOL_BITS
        found |= symbols[place : place + len(text)]
    return found


def _slices(texts: Iterator[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the text, its n-grams), long texts in several pieces."""
    for number, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if len(raw) <= SLICE_BYTES:
            yield number, ngrams(raw)
            continue
        for at in range(0, len(raw), SLICE_BYTES):
            before = max(0, at - ORDER + 1)
            yield number, ngrams(raw[before : at + SLICE_BYTES])[at - before :]


def ngram_counts(docs: DataFrame, text: str) -> DataFrame:
    """(gram, n): every n-gram of the texts of ``docs`` and how often it is there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n)], ["gram", "n"])

        for batch in batches:
            for _, grams in _slices(value.as_py() for value in batch.column(0)):
                held.append(grams)
                size += len(grams)
                if size >= SLICE_BYTES:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    small_batches(docs.sparkSession)
    return docs.select(text).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2, and 3 or more, from how many n-grams have each count."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    def discount(k: int, own: int, next_: int) -> float:
        value = k - (k + 1) * y * next_ / own if own and next_ else k * 0.5
        return min(max(value, 0.05), k - 0.05)

    return discount(1, n1, n2), discount(2, n2, n3), discount(3, n3, n4)


def _low(order: int, gram: str = "gram") -> Column:
    """The last ``order`` symbols of a gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << SYMBOL_BITS * order) - 1))


@dataclass
class NgramModel:
    """Costs (-log p) by order, from trusted text alone; what no order knows costs ``unknown`` more."""

    grams: dict[int, DataFrame]  # gram, cost
    backoffs: dict[int, DataFrame]  # context, cost: from order 2 on
    first_backoff: float  # of order 1, whose context is empty
    unknown: float = math.log(SYMBOLS)

    def size(self) -> int:
        return sum(table.count() for part in (self.grams, self.backoffs) for table in part.values())


def train(counts: DataFrame) -> NgramModel:
    """The interpolated model of the n-grams of ``counts`` (gram, n), which hold the highest order."""
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        # Below the highest order, an n-gram counts once for each symbol seen before it.
        shorter = tables[order + 1].groupBy(_low(order).alias("gram"))
        tables[order] = settle(shorter.agg(F.count(F.lit(1)).alias("n")), f"grams-{order}")
    grams, backoffs = {}, {}
    first_backoff = 0.0
    for order in range(1, ORDER + 1):
        seen = [F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]
        d1, d2, d3 = discounts(*tables[order].agg(*seen).first())
        n = F.col("n")
        discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        keyed = tables[order].withColumn("context", F.shiftright("gram", SYMBOL_BITS))
        contexts = settle(
            keyed.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount).alias("left")),
            f"contexts-{order}",
        )
        share = F.col("left") / F.col("total")
        # Contexts of the first two orders are a few hundred; all are at most as many as n-grams.
        joined = keyed.join(contexts, "context")
        if order == 1:
            joined = joined.withColumn("low_cost", F.lit(math.log(SYMBOLS)))
            only = contexts.select(-F.log(share)).first()
            first_backoff = only[0] if only else 0.0
        else:
            lower = grams[order - 1].toDF("low", "low_cost")
            joined = joined.withColumn("low", _low(order - 1)).join(lower, "low")
            backoffs[order] = contexts.select("context", (-F.log(share)).alias("cost"))
        p = (n - discount) / F.col("total") + share * F.exp(-F.col("low_cost"))
        grams[order] = settle(joined.select("gram", (-F.log(p)).alias("cost")), f"gram-costs-{order}")
    return NgramModel(grams, backoffs, first_backoff)


def gram_costs(wanted: DataFrame, model: NgramModel) -> DataFrame:
    """(gram, cost) of any n-grams (gram), each given once, by joins with the sharded model."""
    now = wanted.select("gram", F.lit(0.0).alias("cost"), F.lit(False).alias("known"))
    for order in range(ORDER, 0, -1):
        own = model.grams[order].toDF("low", "own_cost")
        now = now.withColumn("low", _low(order)).join(own, "low", "left")
        if order > 1:
            further = model.backoffs[order].toDF("context", "more")
            now = now.withColumn("context", F.shiftright("low", SYMBOL_BITS)).join(further, "context", "left")
            more = F.coalesce("more", F.lit(0.0))
        else:
            more = F.lit(model.first_backoff + model.unknown)
        found = F.col("own_cost").isNotNull()
        now = now.select(
            "gram",
            F.when(F.col("known"), F.col("cost")).otherwise(F.col("cost") + F.when(found, F.col("own_cost")).otherwise(more)).alias("cost"),
            (F.col("known") | found).alias("known"),
        )
    return now.select("gram", "cost")


class _SentModel:
    """The model as sorted arrays."""

    def __init__(self, model: NgramModel):
        self.grams = {order: self._arrays(table, "gram") for order, table in model.grams.items()}
        self.backoffs = {order: self._arrays(table, "context") for order, table in model.backoffs.items()}
        self.last = model.first_backoff + model.unknown

    @staticmethod
    def _arrays(table: DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
        found = table.orderBy(key).toArrow()
        return found.column(0).to_numpy(), found.column(1).to_numpy()

    @staticmethod
    def _look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where the table has the key, costs there)"""
        known, costs = table
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(0)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        there = known[at] == keys
        return there, costs[at[there]]

    def costs(self, grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            low = grams[todo] & ((1 << SYMBOL_BITS * order) - 1)
            there, costs = self._look_up(self.grams[order], low)
            out[todo[there]] += costs
            todo, low = todo[~there], low[~there]
            if not len(todo):
                return out
            if order > 1:
                there, costs = self._look_up(self.backoffs[order], low >> SYMBOL_BITS)
                out[todo[there]] += costs
        out[todo] += self.last
        return out


@dataclass
class QualityModel:
    """The n-gram model, and the middle cost of a byte and the largest excess by language."""

    ngrams: NgramModel
    limits: DataFrame  # lang, middle, max_excess
    middle: float  # of languages without one
    max_excess: float
    sent: bool = True


def _is_trusted(docs: DataFrame, labels: DataFrame, id_col: str, name: str) -> DataFrame:
    """``docs`` with the column ``name``: whether all labels call the document good and none toxic."""
    judged = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    key = uncommon("trusted_id", docs)
    good = settle(
        judged.filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias(key), F.lit(True).alias(name)),
        "trusted",
    )
    good = F.broadcast(good) if good.count() <= BROADCAST_IDS else good
    return docs.join(good, F.col(id_col) == F.col(key), "left").drop(key)


def _sums(docs: DataFrame, model: NgramModel, sent: bool, text: str, cost: str) -> DataFrame:
    """``docs`` with the sum of the costs of the text's n-grams in ``cost``."""
    small_batches(docs.sparkSession)
    if sent:
        shared = docs.sparkSession.sparkContext.broadcast(_SentModel(model))

        @F.arrow_udf("double")
        def total(texts: pa.Array) -> pa.Array:
            out = np.zeros(len(texts))
            numbers: list[int] = []
            parts: list[np.ndarray] = []

            def add() -> None:
                if parts:
                    each = np.repeat(numbers, [len(part) for part in parts])
                    out[:] += np.bincount(each, shared.value.costs(np.concatenate(parts)), len(out))

            size = 0
            for number, found in _slices(value.as_py() for value in texts):
                numbers.append(number)
                parts.append(found)
                size += len(found)
                if size >= SLICE_BYTES:
                    add()
                    numbers.clear()
                    parts.clear()
                    size = 0
            add()
            return pa.array(out)

        return docs.withColumn(cost, total(text))

    row = uncommon("row", docs)
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()), "rows-to-score")

    def own_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, found in _slices(value.as_py() for value in batch.column(1)):
                grams, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(len(grams), number))), pa.array(grams), pa.array(n)],
                    [row, "gram", "n"],
                )

    counted = rows.select(row, text).mapInArrow(own_counts, f"`{row}` long, gram long, n long")
    costs = settle(gram_costs(ngram_counts(rows, text).select("gram"), model), "costs-to-look-up")
    summed = counted.join(costs, "gram").groupBy(row).agg(F.sum(F.col("n") * F.col("cost")).alias(cost))
    return rows.join(summed, row, "left").withColumn(cost, F.coalesce(cost, F.lit(0.0))).drop(row)


def _bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rejected: float = REJECTED,
    most_sent: int = BROADCAST_NGRAMS,
) -> QualityModel:
    """A model of the trusted documents among ``docs``, for scoring any documents."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    flagged = _is_trusted(plain, labels, "doc_id", "trusted")
    kept_out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    learnt = flagged.filter(F.col("trusted") & ~kept_out)
    costs = train(settle(ngram_counts(learnt, "text"), "grams"))
    sent = costs.size() <= most_sent
    checked = flagged.filter(F.col("trusted") & kept_out & (_bytes("text") > 0))
    scored = settle(
        _sums(checked, costs, sent, "text", "cost").select(
            "lang", (F.col("cost") / _bytes("text")).alias("cost"), _weight("text").alias("weight")
        ),
        "calibration",
    )
    median = F.percentile_approx("cost", 0.5, 10_000)
    middles = settle(
        scored.groupBy("lang")
        .agg(median.alias("middle"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= MIN_DOCUMENTS)
        .select(F.col("lang").alias("own"), "middle"),
        "middles",
    )
    middles = F.broadcast(middles) if middles.count() <= BROADCAST_LANGUAGES else middles

    def quantile(middle: Column) -> Column:
        return F.percentile_approx((F.col("cost") - middle) * F.col("weight"), 1 - rejected, 10_000)

    limits = settle(
        scored.join(middles, F.col("lang").eqNullSafe(F.col("own")))
        .groupBy("lang", "middle")
        .agg(quantile(F.col("middle")).alias("max_excess")),
        "limits",
    )
    middle = scored.agg(median).first()[0]
    if middle is None:
        return QualityModel(costs, limits, 0.0, math.inf, sent)
    max_excess = scored.agg(quantile(F.lit(middle))).first()[0]
    return QualityModel(costs, limits, middle, max_excess, sent)


def _weight(text: str) -> Column:
    return F.sqrt(F.greatest(_bytes(text), F.lit(1)))


def score(docs: DataFrame, model: QualityModel, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with perplexity (per byte), max_perplexity and kept."""
    key, limit, excess, cost = (uncommon(name, docs) for name in ("limit_lang", "limit", "excess", "cost"))
    limits = model.limits.select(
        F.col("lang").alias(key), F.col("middle").alias(limit), F.col("max_excess").alias(excess)
    )
    limits = F.broadcast(limits) if limits.count() <= BROADCAST_LANGUAGES else limits
    limited = docs.join(limits, F.col(lang).eqNullSafe(F.col(key)), "left").drop(key)
    summed = _sums(limited, model.ngrams, model.sent, text, cost)
    most = F.coalesce(limit, F.lit(model.middle)) + F.coalesce(excess, F.lit(model.max_excess)) / _weight(text)
    return (
        summed.withColumn(cost, F.col(cost) / F.greatest(_bytes(text), F.lit(1)))
        .withColumn(limit, most)
        .withColumn("kept", F.col(cost) <= F.col(limit) + ROUNDING)
        .withColumn("perplexity", F.exp(cost))
        .withColumn("max_perplexity", F.exp(limit))
        .drop(cost, limit, excess)
    )


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """``docs`` with perplexity, max_perplexity and kept, by a model of their own trusted part."""
    return score(docs, fit(docs, labels, id_col, text, lang, **options), text, lang)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rejected documents."""
    plain = docs.select(*[F.col(f"`{name}`").alias(f"in_{i}") for i, name in enumerate(docs.columns)])
    inner = dict(zip(docs.columns, plain.columns))
    judged = judge(plain, labels, inner[id_col], inner[text], inner[lang]).filter("kept")
    return judged.select(*[F.col(inner[name]).alias(name) for name in docs.columns])
