"""Public tokenizer files, read once in each Python worker."""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

BYTE_BPE = "byte_bpe_50k"


def vocabulary_path(name: str) -> str:
    """``name`` if it is a path, else the place of that file among the public tokenizers."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def read_json(name: str) -> dict:
    with open(vocabulary_path(name), encoding="utf-8") as file:
        return json.load(file)


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shifted = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + n): byte for n, byte in enumerate(shifted)}


def special_tokens(name: str) -> dict[str, int]:
    """Added tokens, which are found inside texts as they stand."""
    added = read_json(name)["added_tokens"]
    if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens with rules of their own are not supported")
    return {token["content"]: token["id"] for token in added}


@lru_cache(maxsize=4)
def fast_encoder(name: str):
    """Encoder with the ids of ``name``.json, from the same vocabulary as ranks in ``name``.tiktoken."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(f"{name}.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(
        name,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens=special_tokens(f"{name}.json"),
    )


@lru_cache(maxsize=4)
def plain_encoder(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(f"{name}.json"))
