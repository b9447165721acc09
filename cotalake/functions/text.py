"""Text and key expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() treats as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

KEY_SPACE = 1_000_000


def strip_blanks(value: Column) -> Column:
    """Unicode-aware strip. ``F.trim`` alone would leave tabs and no-break spaces."""
    return F.btrim(value, F.lit(BLANKS))


def normalize_cnpj(value: Column) -> Column:
    """Digits only, leading zeros kept."""
    return F.regexp_replace(value.cast("string"), "[^0-9]", "")


def hash_key(value: Column, space: int = KEY_SPACE) -> Column:
    """md5 of the text, read as one 128-bit integer, modulo ``space``.

    The digest is folded from the left in 32-bit words, so the number never
    leaves a long: word by word, remainder * 2^32 + next word, modulo ``space``.
    """
    digest = F.md5(value)
    radix = (1 << 32) % space
    remainder = F.lit(0).cast("long")
    for start in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        remainder = (remainder * F.lit(radix) + word) % F.lit(space)
    return remainder


def wide_key(value: Column) -> Column:
    """The first 60 bits of the md5 of the text as a non-negative long: a million texts collide once in two million cases."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def row_order(*parts: str) -> Column:
    """A stable 32-bit order number for rows that share a key and a day.

    It depends on the row's values only, so a recomputed task orders the rows
    the same way.
    """
    return F.shiftrightunsigned(F.xxhash64(*parts), 32)


def number_order(*parts: str) -> Column:
    """The same from non-negative whole numbers by plain arithmetic, which any engine can repeat."""
    mixed = F.lit(0).cast("long")
    for part in parts:
        mixed = (mixed * F.lit(1_000_003) + F.col(part).cast("long") % F.lit(1 << 31)) % F.lit(1 << 31)
    return (mixed * F.lit(2_654_435_761)) % F.lit(1 << 32)


def business_id(number: Column, prefix: str = "CLI_", width: int = 7) -> Column:
    """``CLI_0000042``; longer numbers are kept whole, as C-style padding does."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def last_path_segment(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)
