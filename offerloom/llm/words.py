"""Words, lines and row keys as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, a word, and the letters that are folded.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words; empty for null."""
    return F.array_remove(F.split(text_or_empty(text), f"{SPACE}+"), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lines(text: Column) -> Column:
    """Array of the lines between newlines; null and empty texts are one empty line."""
    return F.split(text_or_empty(text), "\n")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; the slow general path runs on non-ASCII text only."""
    return F.when(text.rlike("[^\\x00-\\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def line_key(line: Column) -> Column:
    return ascii_lower(strip(line))


def fingerprint(*parts: Column) -> tuple[Column, Column]:
    """128 bits as two longs; nulls count as a value of their own."""
    flat = [c for p in parts for c in (p, p.isNull())]
    return F.xxhash64(*flat), F.xxhash64(F.lit(7), *flat)
