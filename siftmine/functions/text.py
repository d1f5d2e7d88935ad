"""Column expressions on text: tokens, tags and string hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = 4294967296  # 2 to the 32
_HALF_WORD = 2147483648


def split_tokens(text: Column, sep: str = " ", keep_empty: bool = True) -> Column:
    """Split at every single ``sep``.

    Empty tokens inside the text stay, those at its end go; the empty text is
    one empty token. ``keep_empty=False`` leaves out all empty tokens.
    """
    parts = F.split(text, f"\\Q{sep}\\E", -1)
    if not keep_empty:
        return F.filter(parts, lambda token: token != "")
    body = F.regexp_replace(text, f"(?:\\Q{sep}\\E)+$", "")
    none = F.array().cast("array<string>")
    return F.when((body == "") & (text != ""), none).otherwise(
        F.split(body, f"\\Q{sep}\\E", -1)
    )


def tag_array(text: Column, prefix: str = "#") -> Column:
    """Tokens that begin with ``prefix``, with every ``prefix`` in them deleted.

    A line break counts as a space.
    """
    tokens = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ", -1)
    tags = F.filter(tokens, lambda token: token.startswith(prefix))
    return F.transform(tags, lambda token: F.replace(token, F.lit(prefix), F.lit("")))


def _characters(text: Column) -> Column:
    # Splitting the empty string gives one empty string, which is no character.
    return F.filter(F.split(text, ""), lambda c: c != "")


def _utf16_units(text: Column) -> Column:
    """The 16-bit units of the text; a character beyond the basic plane has two."""

    def units(c: Column) -> Column:
        code = F.ascii(c).cast("long")
        beyond = code - 65536
        pair = F.array(F.floor(beyond / 1024) + 55296, beyond % 1024 + 56320)
        return F.when(code > 65535, pair).otherwise(F.array(code))

    return F.flatten(F.transform(_characters(text), units))


def java_string_hash(text: Column) -> Column:
    """The JVM's 32-bit string hash."""
    zero = F.lit(0).cast("long")
    unsigned = F.aggregate(_utf16_units(text), zero, lambda h, c: (h * 31 + c) % _WORD)
    return F.when(unsigned >= _HALF_WORD, unsigned - _WORD).otherwise(unsigned)


# Fixed value: weight of a character in the second legacy hash.
CHARACTER_WEIGHT = 67


def character_sum(text: Column, weight: int = CHARACTER_WEIGHT) -> Column:
    """Sum of ``weight`` times the code of every 16-bit unit."""
    zero = F.lit(0).cast("long")
    return F.aggregate(_utf16_units(text), zero, lambda total, c: total + c * weight)


def digest_word(text: Column, which: int) -> Column:
    """The first, second, … 32-bit word of the MD5 digest, as a number."""
    word = F.substring(F.md5(text), 1 + 8 * which, 8)
    return F.conv(word, 16, 10).cast("long")


def bit_positions(tag: Column, m: int = 1024, legacy: bool = False) -> list[Column]:
    """The two bit positions of ``tag`` among ``m`` bits.

    ``legacy=True`` uses the JVM string hash and the weighted character sum,
    which gives anagrams the same second position.
    """
    if legacy:
        pair = [F.abs(java_string_hash(tag)), character_sum(tag)]
    else:
        pair = [digest_word(tag, 0), digest_word(tag, 1)]
    return [(value % m).cast("int") for value in pair]
