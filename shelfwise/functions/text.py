"""String and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.rules import KEY_UNIT_SUFFIXES

WHITESPACE = " \t\n\r\x0b\x0c"
# Fixed value: the other characters that count as blanks in text patterns; web pages are full of U+00A0.
OTHER_BLANKS = "\x1c\x1d\x1e\x1f\x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def plain_blanks(c: Column) -> Column:
    """Text with every blank outside ASCII as a space, so that patterns see one kind of blank.

    Only texts that may hold one are read character by character; the one-element array computes `c` once.
    """
    def spaced(text: Column) -> Column:
        odd = F.length(text) != F.octet_length(text)
        for separator in OTHER_BLANKS[:4]:
            odd = odd | F.contains(text, F.lit(separator))
        return F.when(odd, F.translate(text, OTHER_BLANKS, " " * len(OTHER_BLANKS))).otherwise(text)

    return F.transform(F.array(c), spaced)[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE + OTHER_BLANKS))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def contains_any(c: Column, words) -> Column:
    """Does the text hold one of the words?

    A substring test over a constant array: cheaper than an alternation, and unlike a chain of
    conditions it keeps the generated code small. The one-element array computes `c` once.
    """
    listed = F.array(*[F.lit(w) for w in words])
    return F.transform(F.array(c), lambda text: F.exists(listed, lambda w: F.contains(text, w)))[0]


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """Captured text, or null where the pattern does not match or captures nothing."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def normalize_label(label: Column, drop: str = ":") -> Column:
    """`Max. Load (kg):` -> `max_load_kg`."""
    for char in drop:
        label = F.replace(label, F.lit(char), F.lit(""))
    return F.btrim(F.regexp_replace(F.lower(label), "[^a-z0-9]+", "_"), F.lit("_"))


def bare_key(key: Column) -> Column:
    """Key without case and separators."""
    return F.translate(F.lower(key), "_- ", "")


def comparable_key(key: Column) -> Column:
    """Like `bare_key`, after dropping one trailing unit word that follows a separator."""
    unit = r"[_\- ](?:" + "|".join(KEY_UNIT_SUFFIXES) + r")$"
    return F.translate(F.regexp_replace(F.lower(key), unit, ""), "_- ", "")


def plain_number_text(number: Column) -> Column:
    """Decimal text of a double without exponent notation."""
    small_or_big = (F.abs(number) >= 1e7) | ((F.abs(number) < 1e-3) & (number != 0))
    decimal_text = F.regexp_replace(number.cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    return F.when(small_or_big, decimal_text).otherwise(number.cast("string"))


def whole_or_decimal_text(number: Column) -> Column:
    """`63.0` -> `63`, `62.5` -> `62.5`. The one-element array computes `number` once."""
    def text(n: Column) -> Column:
        return F.when(n == F.floor(n), n.cast("decimal(38,0)").cast("string")).otherwise(plain_number_text(n))

    return F.transform(F.array(number), text)[0]


def clean_number_text(value: Column) -> Column:
    """Decimal comma between digits becomes a point; long dashes become hyphens."""
    return strip(F.translate(F.regexp_replace(value, r"(\d),(\d)", "$1.$2"), "–—", "--"))


def is_numeric_text(value: Column) -> Column:
    return value.rlike(r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$")


def one_decimal(x: Column) -> Column:
    return F.round(x, 1).cast("string")
