"""Text normalising and small value helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The signs of Unicode's White_Space; ``trim`` alone only strips blanks.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(value: Column) -> Column:
    """Remove white space of any kind at both ends; what lies between is not searched."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def normalise(value: Column) -> Column:
    """P10: stripped, lower case, NULL when nothing is left."""
    return blank_to_null(F.lower(strip(value)))


def first_filled(*values: Column, default: str) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[blank_to_null(v) for v in values], F.lit(default))


def year_of(day: Column) -> Column:
    """P9"""
    return F.year(day)


def drop_blanks(values: Column) -> Column:
    """Stripped elements of a string array without the blank ones."""
    return F.filter(F.transform(values, strip), lambda v: v != "")


def count_where(condition: Column) -> Column:
    """Rows where ``condition`` is true, as bigint."""
    return F.count_if(condition)


def alternation(terms: Iterable[str]) -> str:
    """Pattern for any of ``terms`` as whole words, longest first."""
    ordered = sorted(set(terms), key=lambda t: (-len(t), t))
    names = "|".join(_quote(t) for t in ordered)
    return rf"(?<![\p{{L}}\p{{N}}_])({names})(?![\p{{L}}\p{{N}}_])"


def _quote(term: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in term)


def literal_map(entries: dict[str, str]) -> Column:
    """A constant map column."""
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
