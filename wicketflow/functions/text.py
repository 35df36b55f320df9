"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(col: Column) -> Column:
    """Hyphens to spaces."""
    return F.translate(col, "-", " ")


def first_piece(col: Column, separator: str) -> Column:
    """The text before the first separator."""
    return F.substring_index(col, separator, 1)


def whole_numbers(col: Column) -> Column:
    """Every whitespace-separated token made of digits, as integers; null beyond their range."""
    tokens = F.filter(F.split(col, r"\s+"), lambda t: t.rlike("^[0-9]+$"))
    return F.transform(tokens, lambda t: t.try_cast("int"))


def url_segment(col: Column, index: int) -> Column:
    """Piece `index` (from 0) of a URL split at slashes, null when there is none."""
    return F.get(F.split(col, "/"), F.lit(index))


def canonical(col: Column, aliases: dict[str, tuple[str, ...]]) -> Column:
    """Replace each alias by its canonical value; other values stay."""
    out = col
    for value, spellings in aliases.items():
        out = F.when(col.isin(list(spellings)), value).otherwise(out)
    return out
