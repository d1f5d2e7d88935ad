"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

Two deterministic transducers run one after the other.

The splitter reads character classes and marks where a word (a piece that the
merges never cross) starts. It has 13 states, so a chunk of text is a map from
the state before it to the state after it. Chunks of all texts advance in
step; their maps are composed by a parallel prefix scan, which gives every
chunk the state it starts in. The maps of nearly all chunks are constant after
a few characters, whatever the text, so the marks are made on the way.

The merger reads the bytes of a word; each of its transitions is annotated
with the change in the number of tokens. Its states hold, for each suffix of
what was read that may yet become part of a longer token, the token that ends
before that suffix and the tokens counted there: a token can only follow
another one if the merges leave that pair as it is, and there is just one such
last token for every prefix. States are compiled when first reached and
forgotten when there are too many; so is the memo of words.

Defined cases: null text counts as empty and has 0 tokens; special tokens
inside a text count as one token each; a text of any length is read whole, in
slices that begin where a word begins; repeated rows, nulls and any further
columns are left as they are.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmine.llm.common import small_batches
from siftmine.llm.vocabulary import BYTE_BPE, byte_letters, read_json, special_tokens

VOCABULARY = f"{BYTE_BPE}.json"
LIMIT = 1024
#: Characters that are split at once, and in one chunk of them.
SLICE_CHARS = 2_000_000
CHUNK_CHARS = 1024
#: Characters after which the map of a chunk is expected to be constant.
HEAD_CHARS = 16
#: Words and transitions kept before they are forgotten.
MEMO_WORDS = 1_000_000
MEMO_TRANSITIONS = 500_000

# Character classes: the letters that contractions are made of stand alone.
_LETTER, _STMD, _R, _V, _L, _E, _NUMBER, _SPACE, _WHITE, _APOSTROPHE, _OTHER, _PAD = range(12)
_LETTERS = (_LETTER, _STMD, _R, _V, _L, _E)
# States: in a run of letters, numbers or others; in white space of one or more characters that
# ends with a space or not; after an apostrophe that begins a word; after its r, v or l; done.
(
    _START, _WORD, _DIGITS, _MARKS, _SPACE1, _SPACES, _WHITE1, _WHITES, _QUOTE, _QUOTE_R, _QUOTE_V,
    _QUOTE_L, _DONE,
) = range(13)
_STATES, _CLASSES = 13, 12
_HERE, _BEFORE = 1, 2  # a word starts at this character, or at the one before


def _fresh(kind: int) -> int:
    """The state after the first character of a word."""
    if kind in _LETTERS:
        return _WORD
    return {_NUMBER: _DIGITS, _SPACE: _SPACE1, _WHITE: _WHITE1, _APOSTROPHE: _QUOTE, _OTHER: _MARKS}[kind]


def _split_step(state: int, kind: int) -> tuple[int, int]:
    """(next state, marks) of the splitter."""
    white, mark = kind in (_SPACE, _WHITE), kind in (_APOSTROPHE, _OTHER)
    if kind == _PAD:
        return state, 0
    if state == _START:
        return _fresh(kind), 0
    if state == _WORD and kind in _LETTERS or state == _DIGITS and kind == _NUMBER:
        return state, 0
    if state == _MARKS and mark:
        return state, 0
    if state in (_SPACE1, _SPACES, _WHITE1, _WHITES):
        if white:
            return (_SPACES if kind == _SPACE else _WHITES), 0
        # The last white space of a run belongs to what follows if it is a space, else it stands alone.
        marks = _BEFORE if state in (_SPACES, _WHITES) else 0
        if state in (_SPACE1, _SPACES):
            return (_MARKS if mark else _fresh(kind)), marks
        return _fresh(kind), marks | _HERE
    if state == _QUOTE:
        if kind == _STMD:
            return _DONE, 0
        if kind in (_R, _V, _L):
            return {_R: _QUOTE_R, _V: _QUOTE_V, _L: _QUOTE_L}[kind], 0
        if mark:
            return _MARKS, 0
        return _fresh(kind), _HERE
    if state in (_QUOTE_R, _QUOTE_V, _QUOTE_L):
        if kind == (_L if state == _QUOTE_L else _E):
            return _DONE, 0
        after, marks = _split_step(_WORD, kind)
        return after, marks | _BEFORE
    return _fresh(kind), _HERE


def _split_table() -> tuple[np.ndarray, np.ndarray]:
    steps = [_split_step(state, kind) for state in range(_STATES) for kind in range(_CLASSES)]
    table = np.array(steps, dtype=np.uint8)
    # States are kept multiplied by the number of classes: the row's start in the flat tables.
    return table[:, 0] * np.uint8(_CLASSES), table[:, 1].copy()


_NEXT, _MARKED = _split_table()


@lru_cache(maxsize=1)
def _class_of() -> np.ndarray:
    """The class of each code point."""
    import regex

    kinds = np.full(0x110000, _OTHER, dtype=np.uint8)
    every = "".join(map(chr, range(0xD800))) + "\ud800" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _WHITE)):
        for found in regex.finditer(pattern, every):
            kinds[found.start() : found.end()] = kind
    for letters, kind in (("stmd", _STMD), ("r", _R), ("v", _V), ("l", _L), ("e", _E), (" ", _SPACE), ("'", _APOSTROPHE)):
        kinds[[ord(letter) for letter in letters]] = kind
    return kinds


def _advance(states: np.ndarray, columns: np.ndarray, marks: np.ndarray | None = None) -> np.ndarray:
    """States after all ``columns`` (position x chunk); ``marks`` gets what is emitted."""
    for j, kinds in enumerate(columns):
        at = states + kinds
        if marks is not None:
            marks[j] = _MARKED[at]
        states = _NEXT[at]
    return states


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan: row i is the map of chunks 0 to i, one after the other."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
        step *= 2
    return maps


def word_starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """(all texts joined, where words start in it, where texts start in it). Empty texts are not allowed."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = np.append(_class_of()[codes], np.uint8(_PAD))
    n = len(codes)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    begins = ends - lengths
    chunks = -(-lengths // CHUNK_CHARS)
    first = np.cumsum(chunks) - chunks
    inner = np.arange(chunks.sum()) - np.repeat(first, chunks)
    at = np.repeat(begins, chunks) + inner * CHUNK_CHARS
    until = np.minimum(at + CHUNK_CHARS, np.repeat(ends, chunks))
    width = int((until - at).max())
    places = at + np.arange(width)[:, None]
    places[places >= until] = n
    columns = kinds[places]

    # Map of every chunk: all states at once, then a single one where they have met.
    head = min(HEAD_CHARS, width)
    lanes = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None] * np.uint8(_CLASSES), len(at), axis=1)
    lanes = _advance(lanes, columns[:head])
    met = (lanes == lanes[0]).all(axis=0)
    marks = np.zeros((width, len(at)), dtype=np.uint8)
    out = np.empty_like(lanes)
    out[:] = _advance(lanes[0], columns[head:], marks[head:])
    if not met.all():
        out[:, ~met] = _advance(lanes[:, ~met], columns[head:][:, ~met])
    maps = (out // _CLASSES).T
    maps[first] = maps[first][:, :1]  # a text begins in the first state whatever came before
    scanned = compose_scan(maps)
    entry = np.zeros(len(at), dtype=np.uint8)
    entry[1:] = scanned[:-1, _START]
    entry[first] = _START
    entry *= np.uint8(_CLASSES)
    again = marks[:head].copy()
    after = _advance(entry, columns[:head], again)
    marks[:head] = again
    if not met.all():
        rest = np.zeros((width - head, int((~met).sum())), dtype=np.uint8)
        after[~met] = _advance(after[~met], columns[head:][:, ~met], rest)
        marks[head:, ~met] = rest

    starts = np.zeros(n + 1, dtype=bool)
    here, before = places[(marks & _HERE) > 0], places[(marks & _BEFORE) > 0] - 1
    starts[here] = True
    starts[before] = True
    starts[begins] = True
    # A contraction that the end of the text cuts short is an apostrophe and a letter.
    final = scanned[first + chunks - 1, _START]
    starts[ends[np.isin(final, (_QUOTE_R, _QUOTE_V, _QUOTE_L))] - 1] = True
    return joined, np.flatnonzero(starts[:n]), begins


class Merger:
    """Transducer over the bytes of a word, annotated with emitted-token counts.

    Tokens are nodes of the trie of the vocabulary.
    """

    def __init__(self, vocabulary: dict):
        letters = byte_letters()
        model = vocabulary["model"]
        if model["type"] != "BPE" or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE vocabulary is needed")
        special = {token["content"] for token in vocabulary["added_tokens"]}
        self.children: dict[int, int] = {}  # node and byte: node; the root is 0
        self.inner, self.tokens = {0}, set()
        nodes: dict[str, int] = {}
        for token in model["vocab"]:
            if token in special:
                continue
            node = 0
            for letter in token:
                self.inner.add(node)
                node = self.children.setdefault(node << 8 | letters[letter], len(self.children) + 1)
            nodes[token] = node
            self.tokens.add(node)
        # What each token is merged from and when; single bytes are there from the start.
        self.ranks: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[nodes[left], nodes[right]] = rank
            if self.halves.setdefault(nodes[left + right], (nodes[left], nodes[right], rank))[2] != rank:
                raise ValueError("a token that several merges make is not supported")
        if any(node not in self.halves for token, node in nodes.items() if len(token) > 1):
            raise ValueError("a token that no merge makes is not supported")
        self.borders: tuple[dict, dict] = ({}, {})
        self.stays: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        start = ((0, -1, 0),)
        self.states, self.keys, self.steps = {start: 0}, [start], {}

    def border(self, token: int, side: int) -> list[tuple[int, int]]:
        """Pieces at the left (0) or right (1) end of a token while it is merged: (piece, absorbed at)."""
        found = self.borders[side].get(token)
        if found is None:
            piece, absorbed, found = token, len(self.ranks), []
            while True:
                found.append((piece, absorbed))
                if piece not in self.halves:
                    break
                half = self.halves[piece]
                piece, absorbed = half[side], half[2]
            self.borders[side][token] = found
        return found

    def may_follow(self, last: int, token: int) -> bool:
        """Whether the merges leave the two tokens apart.

        They don't if two pieces that meet at the border are merged before
        either is absorbed; of equal merges the left one comes first.
        """
        if last < 0:
            return True
        key = last << 20 | token
        if (known := self.stays.get(key)) is None:
            rank = self.ranks.get
            never = len(self.ranks) + 1
            known = self.stays[key] = not any(
                (at := rank((left, right), never)) < left_until and at <= right_until
                for left, left_until in self.border(last, 1)
                for right, right_until in self.border(token, 0)
            )
        return known

    def compiled(self, state: int, byte: int) -> int:
        """Next state and change in the number of tokens."""
        children, tokens, inner = self.children, self.tokens, self.inner
        read = [
            (child, last, count)
            for node, last, count in self.keys[state]
            if (child := children.get(node << 8 | byte)) is not None
        ]
        token, gained = next(
            (node, count + 1)
            for node, last, count in read
            if node in tokens and self.may_follow(last, node)
        )
        key = (*[(node, last, count - gained) for node, last, count in read if node in inner], (0, token, 0))
        after = self.states.get(key)
        if after is None:
            after = self.states[key] = len(self.keys)
            self.keys.append(key)
        step = self.steps[state << 8 | byte] = after << 16 | gained + 32768
        return step

    def count(self, word: str) -> int:
        if len(self.steps) > MEMO_TRANSITIONS:
            self.forget()
        if len(self.stays) > MEMO_TRANSITIONS:
            self.stays = {}
        read = word.encode("utf-8", "surrogatepass")
        steps, state, total = self.steps, 0, 0
        for byte in read:
            step = steps.get(state << 8 | byte) or self.compiled(state, byte)
            state = step >> 16
            total += step & 65535
        return total - 32768 * len(read)


class TokenCounter:
    def __init__(self, name: str):
        vocabulary = read_json(name)
        before = vocabulary["pre_tokenizer"]
        if before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"] or vocabulary["normalizer"]:
            raise ValueError("only the byte-level splitting of words is supported")
        self.merger = Merger(vocabulary)
        self.special = sorted(special_tokens(name), key=len, reverse=True)
        self.memo: dict[str, int] = {}

    def counts_of(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        found = list(map(memo.get, words))
        if None in found:
            count = self.merger.count
            for i, n in enumerate(found):
                if n is None:
                    word = words[i]
                    if (n := memo.get(word)) is None:
                        n = count(word)
                        if len(word) < 64:
                            memo[word] = n
                    found[i] = n
        return np.array(found, dtype=np.int64)

    def segments(self, text: str) -> tuple[list[str], int]:
        """What is between special tokens, and how many of those there are."""
        parts, n = [text], 0
        for token in self.special:
            if token in text:
                pieces = [part.split(token) for part in parts]
                n += sum(len(piece) - 1 for piece in pieces)
                parts = [part for piece in pieces for part in piece]
        return [part for part in parts if part], n

    def long_text(self, text: str) -> int:
        """Slice by slice; what may still change at the end of a slice is read again with the next."""
        total, carry, at, size = 0, "", 0, SLICE_CHARS
        while True:
            at_end = at + size >= len(text)
            joined, starts, _ = word_starts([carry + text[at : at + size]])
            bounds = starts.tolist()
            at += size
            if at_end:
                words = [joined[a:b] for a, b in zip(bounds, [*bounds[1:], len(joined)])]
                return total + int(self.counts_of(words).sum())
            # The last two characters may yet belong together otherwise.
            cut = max((b for b in bounds[-4:] if b <= len(joined) - 3), default=0)
            words = [joined[a:b] for a, b in zip(bounds, bounds[1:]) if b <= cut]
            total += int(self.counts_of(words).sum())
            carry = joined[cut:]
            size = max(SLICE_CHARS, len(carry))

    def count_batch(self, texts: list[str]) -> np.ndarray:
        joined, starts, begins = word_starts(texts)
        bounds = starts.tolist()
        bounds.append(len(joined))
        words = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        return np.add.reduceat(self.counts_of(words), np.searchsorted(starts, begins))

    def count(self, texts: list[str | None]) -> np.ndarray:
        total = np.zeros(len(texts), dtype=np.int64)
        waiting: list[tuple[int, str]] = []
        chars = 0

        def flush() -> None:
            nonlocal chars
            if waiting:
                owners, parts = zip(*waiting)
                np.add.at(total, np.array(owners), self.count_batch(list(parts)))
                waiting.clear()
            chars = 0

        for i, text in enumerate(texts):
            if not text:
                continue
            parts, total[i] = self.segments(text)
            for part in parts:
                if len(part) > SLICE_CHARS:
                    total[i] += self.long_text(part)
                    continue
                if chars + len(part) > SLICE_CHARS:
                    flush()
                waiting.append((i, part))
                chars += len(part)
        flush()
        return total


@lru_cache(maxsize=2)
def token_counter(name: str) -> TokenCounter:
    """One for each Python worker."""
    return TokenCounter(name)


def token_count(column: str, vocabulary: str = VOCABULARY):
    """Column with the number of tokens of the text in ``column``."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(token_counter(vocabulary).count(texts.to_pylist()), pa.int64())

    return count(column)


def with_token_counts(
    docs: DataFrame, text: str = "text", limit: int = LIMIT, vocabulary: str = VOCABULARY
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit; columns of these names are replaced."""
    small_batches(docs.sparkSession)
    counted = docs.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
            "n_tokens": token_count(text, vocabulary),
        }
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
