"""Language identification by compression with a dictionary for each language.

A language's dictionary is raw text of that language. A text is compressed, in
blocks, with every dictionary in turn; the language whose dictionary gives the
smallest size is chosen. Where the runner-up is nearly as small, the margin is
narrow and the choice is not accepted.

The dictionaries are fitted on a bounded sample: of each language the
``SAMPLE_DOCS`` documents with the smallest hash of their id, ``SAMPLE_CHARS``
characters from the middle of each, cut at ``DICTIONARY_BYTES``: of scripts with
two or three bytes a character these are about 128 or 85 full pieces. All dictionaries together take at most
``MODEL_BYTES``, whatever the number of languages, and go to every task.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
rows without language or text teach nothing; if nothing can be learned, all is
``und``; with a single language the score is 1; of equal sizes the
language with more documents to learn from wins, then the alphabet; texts are read whole, whatever their length;
repeated rows, nulls and further columns are passed on, and columns that the
result adds replace columns of that name.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siftmine.llm.common import settle, small_batches, uncommon

SAMPLE_DOCS = 256
SAMPLE_CHARS = 512
MODEL_BYTES = 32 << 20
DICTIONARY_BYTES = 128 << 10
#: Bytes that are compressed at a time, so that a long text cannot become its own dictionary.
BLOCK_BYTES = 4096
#: Matches of four bytes are searched with some care, within the dictionary and the block.
MATCHING = {"window_log": 18, "chain_log": 17, "hash_log": 17, "search_log": 4, "min_match": 4}
#: The runner-up must be larger by this share for a choice to be accepted.
MARGIN = 0.01
UNKNOWN = "und"
#: Counts of so many languages are sent to every task; more are joined.
BROADCAST_LANGUAGES = 10_000


def fit(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang"
) -> dict[str, bytes]:
    """Dictionaries by language, learned from rows that have a language and a text."""
    rows = docs.select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("rank"),
    ).filter("lang is not null and length(trim(text)) > 0")
    counts = settle(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    languages = counts.count()
    few = languages <= BROADCAST_LANGUAGES
    # With very many languages each gets fewer documents, so that all fit the model.
    sample_docs = max(1, min(SAMPLE_DOCS, MODEL_BYTES // (SAMPLE_CHARS * max(1, languages))))
    # Ranks are evenly spread, so the smallest lie below a share of them; the rest need not be compared.
    place = F.conv(F.substring("rank", 1, 13), 16, 10).cast("double") / float(1 << 52)
    counted = rows.join(F.broadcast(counts) if few else counts, "lang")
    # The middle of the text, so that what many texts begin or end with counts less.
    start = F.greatest(F.lit(1), F.floor((F.length("text") - SAMPLE_CHARS) / 2).cast("int"))
    piece = F.substr("text", start, F.lit(SAMPLE_CHARS))
    best = F.row_number().over(W.partitionBy("lang").orderBy("rank", "text"))

    def smallest(some: DataFrame) -> DataFrame:
        pieces = some.select("lang", "rank", "n", piece.alias("text"))
        return pieces.withColumn("place", best).filter(F.col("place") <= sample_docs)

    near = settle(smallest(counted.filter(place <= 4.0 * SAMPLE_DOCS / F.col("n"))), "language-sample")
    # Where many rows have one id, ranks are not spread; such languages are looked at whole.
    got = near.groupBy("lang").agg(F.count(F.lit(1)).alias("got"))
    lacking = settle(
        counts.join(got, "lang", "left")
        .filter(F.coalesce("got", F.lit(0)) < F.least("n", F.lit(sample_docs)))
        .select("lang"),
        "lacking-languages",
    )
    n_lacking = lacking.count()
    if n_lacking:
        whole = F.broadcast(lacking) if n_lacking <= BROADCAST_LANGUAGES else lacking
        near = near.join(whole, "lang", "left_anti").unionByName(smallest(counted.join(whole, "lang", "left_semi")))
    sample = near.orderBy("lang", "place").toArrow()
    pieces: dict[str, list[str]] = {}
    learned: dict[str, int] = {}
    for name, n, value in zip(*(sample.column(c).to_pylist() for c in ("lang", "n", "text"))):
        pieces.setdefault(name, []).append(value)
        learned[name] = n
    room = min(DICTIONARY_BYTES, MODEL_BYTES // max(1, len(pieces)))
    return {
        name: "\n".join(pieces[name]).encode("utf-8", "surrogatepass")[:room]
        for name in sorted(pieces, key=lambda name: (-learned[name], name))
    }


class Compressors:
    """One compressor for each language."""

    def __init__(self, model: dict[str, bytes]):
        import regex
        import zstandard

        self.letter = regex.compile(r"\p{L}")
        self.names = list(model)
        self.compress = []
        matching = zstandard.ZstdCompressionParameters(
            **MATCHING,
            strategy=zstandard.STRATEGY_LAZY,
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
        )
        for content in model.values():
            # Eight bytes are the least that the library takes as a dictionary.
            dictionary = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=matching)
            compressor = zstandard.ZstdCompressor(compression_params=matching, dict_data=dictionary)
            self.compress.append(compressor.compress)

    def sizes(self, text: str) -> list[int]:
        raw = text.encode("utf-8", "surrogatepass")
        blocks = [raw[at : at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)]
        return [sum(len(compress(block)) for block in blocks) for compress in self.compress]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, share by which the runner-up is larger, accepted)."""
        if not self.names or not text or not self.letter.search(text):
            return UNKNOWN, 0.0, False
        sizes = self.sizes(text)
        if len(sizes) == 1:
            return self.names[0], 1.0, True
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min(size for i, size in enumerate(sizes) if i != best)
        score = 1 - sizes[best] / second
        return self.names[best], score, score >= MARGIN


def predict(docs: DataFrame, model: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and accepted."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    ready: list[Compressors] = []

    @F.arrow_udf("lang_pred string, score double, accepted boolean")
    def choose(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Compressors(sent.value))
        names, scores, sure = [], [], []
        for value in texts:
            name, score, accepted = ready[0].predict(value.as_py())
            names.append(name)
            scores.append(score)
            sure.append(accepted)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.bool_())],
            ["lang_pred", "score", "accepted"],
        )

    found = uncommon("found", docs)
    return (
        docs.withColumn(found, choose(text))
        .withColumns({name: F.col(f"{found}.{name}") for name in ("lang_pred", "score", "accepted")})
        .drop(found)
    )


def held_out(id_col: str = "doc_id") -> Column:
    """A fixed quarter of the documents, by their id; those without one are not in it."""
    part = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
    return F.coalesce(part, F.lit(False))
