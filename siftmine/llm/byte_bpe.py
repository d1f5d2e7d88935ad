"""Byte-level BPE encoding and decoding through the tiktoken library and a local rank file.

A text is encoded match by match of the splitting pattern. Long texts are cut
first, at places where a match ends whatever stands around it, so the library
sees bounded pieces and their ids one after another are those of the whole:

* a match never runs from a character that is no white space into white space;
* a run of white space is one match but for its last character if text follows,
  and one match if none does. The library overflows its stack in very long
  runs, so these are handed to its merging alone, without its splitting.

Where a long text has no such place (a word of millions of letters), the piece
is as long as that word. Ids are decoded to raw bytes, which need not be valid
UTF-8 by themselves.

Defined cases: a null text counts as empty and has no ids; null ids decode to
null, no ids to no bytes; ids that the vocabulary lacks, and null ids within a
list, are errors; special tokens do not exist, their strings are ordinary text;
rows that repeat are encoded one by one; a column that the result adds replaces
one of that name, all others are passed on.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import small_batches
from siftmine.llm.vocabulary import BYTE_BPE, vocabulary_path

RANKS = f"{BYTE_BPE}.tiktoken"
#: Characters after which a text is cut at the next safe place.
PIECE_CHARS = 50_000
#: Runs of white space from this length on are merged without splitting.
LONG_RUN = 500

_SAFE = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})")


@lru_cache(maxsize=4)
def rank_encoding(name: str):
    """The encoding of a rank file (a path, or a name among the public tokenizers), read once in each worker."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(name), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _runs_of(length: int) -> regex.Pattern:
    return regex.compile(r"\p{White_Space}{%d,}" % length)


def pieces(text: str, piece_chars: int = PIECE_CHARS, long_run: int = LONG_RUN) -> Iterator[tuple[str, bool]]:
    """(piece, whether it is a single match): the text cut at safe places."""
    at = 0
    for run in _runs_of(long_run).finditer(text):
        yield from _cut(text, at, run.start(), piece_chars)
        # The last character belongs to what follows, if anything does.
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : at], True
    yield from _cut(text, at, len(text), piece_chars)


def _cut(text: str, start: int, end: int, piece_chars: int) -> Iterator[tuple[str, bool]]:
    while start < end:
        safe = _SAFE.search(text, start + piece_chars, end) if end - start > piece_chars else None
        stop = safe.start() if safe else end
        yield text[start:stop], False
        start = stop


def encode_text(text: str | None, ranks: str = RANKS, piece_chars: int = PIECE_CHARS, long_run: int = LONG_RUN) -> np.ndarray:
    """Ids of one text."""
    encoding = rank_encoding(ranks)
    found = [
        np.array(encoding._encode_single_piece(piece), np.uint32)
        if whole
        else encoding.encode_to_numpy(piece, disallowed_special=())
        for piece, whole in pieces(text or "", piece_chars, long_run)
    ]
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", ranks: str = RANKS) -> DataFrame:
    """``docs`` with the ids of each whole text as an array in ``ids``."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        found = [encode_text(value.as_py(), ranks) for value in texts]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        flat = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return docs.withColumn(ids, encoded(F.col(text)))


def decode(rows: DataFrame, ids: str = "ids", decoded: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """``rows`` with the raw bytes of the ids in ``decoded``."""
    small_batches(rows.sparkSession)

    @F.arrow_udf("binary")
    def raw(lists: pa.Array) -> pa.Array:
        encoding = rank_encoding(ranks)
        return pa.array(
            [encoding.decode_bytes(value.as_py()) if value.is_valid else None for value in lists], pa.binary()
        )

    return rows.withColumn(decoded, raw(F.col(ids)))
