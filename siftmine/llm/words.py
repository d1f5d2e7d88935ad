"""Words of raw UTF-8 bytes: runs of digits, ASCII letters (A-Z as a-z) and bytes from 0x80 on.

All bytes of a character beyond ASCII are from 0x80 on, so these are the words of the text itself.
"""

from __future__ import annotations

import pyarrow as pa

_KEPT = {*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)}
_TO_WORDS = bytes(
    byte + 32 if ord("A") <= byte <= ord("Z") else byte if byte in _KEPT else ord(" ") for byte in range(256)
)


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_TO_WORDS).split() if raw else []


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as bytes."""
    return column.cast(pa.binary()).to_pylist()
