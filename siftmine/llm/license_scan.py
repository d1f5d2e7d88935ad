"""License scan: base phrases, and an exact set-similarity join of text blocks with license templates.

A block is a window of words; windows overlap by half, so a notice of up to
half a window lies in one of them wherever lines break. A block matches a
template if it contains at least ``threshold`` of the template's distinct words.

The join orders template words by their frequency over all texts, rare ones
first. A block that may miss at most k words of a template must have one of
the template's k + 1 rarest (prefix filter), as many distinct words as must
match (length filter), and counting stops as soon as the rest of the template
cannot make up for what is missing (positional filter). All three are exact.
A short template is matched only by a block that has all words which tell its
label from the others (``mit``, ``nc``), and one of a licence with stricter
variants by no block that names such a variant. Templates are a fixed small
list and go to every task; texts stay where they
are, and only the counts of template words are gathered.

Defined cases: null text counts as empty: no words, places, or labels, and a
score of 0; words are runs of ASCII letters and digits and of any other
characters beyond ASCII, A-Z lower-cased; texts of any length are read whole;
repeated rows and nulls in other columns are passed on; columns that the result
adds replace columns of that name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import small_batches

# Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

TEMPLATES = {
    "apache": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
        "distributed on an as is basis without warranties or conditions of any kind",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    ),
    "cc-by": (
        "this work is licensed under a creative commons attribution 4 0 international license",
        "licensed under creative commons attribution",
    ),
    "cc-by-nc": (
        "licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        "licensed under creative commons attribution noncommercial",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
        "you should have received a copy of the gnu general public license along with this program",
    ),
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "to deal in the software without restriction including the rights to use copy modify merge publish distribute sublicense",
        "the above copyright notice and this permission notice shall be included in all copies of the software",
    ),
}
#: Words of stricter variants: a block that has one is not a notice of the label.
EXCLUDED = {"cc-by": ("nc", "noncommercial", "nd", "noderivatives", "sa", "sharealike")}
#: Templates of fewer distinct words are short.
SHORT = 15
THRESHOLD = 0.8
BLOCK_WORDS = 64

# Bytes that belong to words, lower-cased; all others become spaces.
_WORD_BYTES = bytes(
    byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in bytes(range(256)).lower()
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def phrase_places(words: list[bytes], phrases: Mapping[str, str] = BASE_PHRASES) -> list[tuple[str, int]]:
    """(label, number of the first word) of every place where a phrase's words stand one after the other."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        sought = f" {phrase} ".encode()
        at = line.find(sought)
        word, counted = 0, 0
        while at >= 0:
            word += line.count(b" ", counted, at)
            counted = at
            found.append((label, word))
            at = line.find(sought, at + 1)
    return found


class Template:
    """Distinct words of a template, rare ones first, and how many a block must have."""

    def __init__(
        self,
        label: str,
        text: str,
        frequency: Mapping[bytes, int],
        threshold: float,
        required: frozenset[bytes] = frozenset(),
        excluded: frozenset[bytes] = frozenset(),
    ):
        self.label, self.text, self.required, self.excluded = label, text, required, excluded
        distinct = set(words_of(text))
        self.words = sorted(distinct, key=lambda word: (frequency.get(word, 0), word))
        self.needed = max(1, -int(-(threshold * len(distinct) - 1e-9) // 1))
        self.prefix = self.words[: len(distinct) - self.needed + 1]

    def containment(self, block: set[bytes]) -> float:
        """Share of the words that the block has; 0 below the threshold, or for another label's block."""
        if len(block) < self.needed or not self.required <= block or self.excluded & block:
            return 0.0
        misses = len(self.words) - self.needed
        for word in self.words:
            if word not in block:
                misses -= 1
                if misses < 0:
                    return 0.0
        return (self.needed + misses) / len(self.words)


def distinguishing(templates: Mapping[str, Sequence[str]], short: int = SHORT) -> dict[str, frozenset[bytes]]:
    """By short template: its words that no template of another label has."""
    by_label = {label: {word for line in lines for word in words_of(line)} for label, lines in templates.items()}
    found = {}
    for label, lines in templates.items():
        others = set().union(*[words for other, words in by_label.items() if other != label])
        for line in lines:
            own = set(words_of(line))
            if len(own) < short:
                found[line] = frozenset(own - others)
    return found


def template_matches(
    words: list[bytes], templates: Sequence[Template], by_prefix: Mapping[bytes, list[int]], block_words: int
) -> list[tuple[str, str, int, float]]:
    """(label, template, first word of the block, containment) of every block that matches."""
    hits = by_prefix.keys() & set(words)
    if not hits:
        return []
    step = block_words // 2
    candidates: dict[int, set[int]] = {}
    for place, word in enumerate(words):
        if word in hits:
            last = place // step
            for number in (last - 1, last):
                if number >= 0 and (number == 0 or number * step + step < len(words)):
                    candidates.setdefault(number * step, set()).update(by_prefix[word])
    found = []
    for start in sorted(candidates):
        block = set(words[start : start + block_words])
        for number in sorted(candidates[start]):
            template = templates[number]
            if share := template.containment(block):
                found.append((template.label, template.text, start, share))
    return found


def word_frequencies(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> DataFrame:
    """(word, n): number of texts that have each word of a fixed vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                total.update(vocabulary.intersection(words_of(value.as_py())))
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())}
        )

    counted = docs.select(text).mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def scan(
    docs: DataFrame,
    text: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with n_words, places (label, word) of base phrases and matches with templates.

    A match has the label, the template, the block's first word and the containment.
    """
    if block_words < 2 or not 0 < threshold <= 1:
        raise ValueError("blocks need two words at least, and a threshold above 0 and up to 1")
    small_batches(docs.sparkSession)
    listed = [(label, line) for label, lines in templates.items() for line in lines]
    vocabulary = {word for _, line in listed for word in words_of(line)}
    # At most one row for each word of the templates.
    counted = word_frequencies(docs, vocabulary, text).toArrow()
    frequency = dict(zip(counted.column("word").to_pylist(), counted.column("n").to_pylist()))
    required = distinguishing(templates)
    ordered = [
        Template(
            label,
            line,
            frequency,
            threshold,
            required.get(line, frozenset()),
            frozenset(word.encode() for word in EXCLUDED.get(label, ())),
        )
        for label, line in listed
    ]
    by_prefix: dict[bytes, list[int]] = {}
    for number, template in enumerate(ordered):
        for word in template.prefix:
            by_prefix.setdefault(word, []).append(number)

    place = pa.struct([("label", pa.string()), ("word", pa.int64())])
    match = pa.struct(
        [("label", pa.string()), ("template", pa.string()), ("first_word", pa.int64()), ("containment", pa.float64())]
    )

    @F.arrow_udf(
        "n_words long, places array<struct<label: string, word: long>>, "
        "matches array<struct<label: string, template: string, first_word: long, containment: double>>"
    )
    def found(texts: pa.Array) -> pa.Array:
        sizes, places, matches = [], [], []
        for value in texts:
            words = words_of(value.as_py())
            sizes.append(len(words))
            places.append([dict(zip(("label", "word"), x)) for x in phrase_places(words)])
            matches.append(
                [
                    dict(zip(("label", "template", "first_word", "containment"), x))
                    for x in template_matches(words, ordered, by_prefix, block_words)
                ]
            )
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(places, pa.list_(place)), pa.array(matches, pa.list_(match))],
            ["n_words", "places", "matches"],
        )

    scanned = docs.withColumn("matches", found(text))
    return scanned.withColumns(
        {
            "n_words": F.col("matches.n_words"),
            "places": F.col("matches.places"),
            "matches": F.col("matches.matches"),
        }
    )


def _listed(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def label_columns() -> dict[str, Column]:
    """Figures of a scan: counts and places of base phrases, labels, and a score from 0 to 1.

    The score is the largest containment that reached the threshold; a base phrase scores 1.
    """
    base, best = F.col("places.label"), F.array_max("matches.containment")
    return {
        "n_base": F.size("places").cast("long"),
        "first_word": F.array_min("places.word"),
        "last_word": F.array_max("places.word"),
        "base_labels": _listed(base),
        "labels": _listed(F.concat(base, F.col("matches.label"))),
        "score": F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))),
    }
