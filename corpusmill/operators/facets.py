"""Faceted filters over the catalog's digest: every parameter is optional, all that are given must hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parameter(value: str | list[str] | None) -> str | None:
    """The first value, trimmed and in lower case; None where nothing is left."""
    first = value[0] if isinstance(value, list) and value else value
    text = first.strip().lower() if isinstance(first, str) else ""
    return text or None


def equals(column: str, wanted: str) -> Column:
    return F.lower(F.coalesce(F.col(column), F.lit(""))) == wanted


def flag(column: str, wanted: str) -> Column:
    """true, 1 and yes ask for true, any other value for false."""
    return F.coalesce(F.col(column), F.lit(False)) == F.lit(wanted in ("true", "1", "yes"))


def text(columns: list[str], wanted: str) -> Column:
    """The wanted text stands literally in the columns; a null reads as the word null."""
    return F.contains(F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("null")) for c in columns])), F.lit(wanted))


def filtered(digest: DataFrame, facets: dict[str, str], equal: dict[str, str], flags: dict[str, str], texts: dict[str, list[str]]) -> DataFrame:
    """digest where all given facets hold; equal, flags and texts map a facet's name to its column or columns."""
    for name, value in facets.items():
        wanted = parameter(value)
        if wanted is None:
            continue
        if name in equal:
            digest = digest.where(equals(equal[name], wanted))
        elif name in flags:
            digest = digest.where(flag(flags[name], wanted))
        elif name in texts:
            digest = digest.where(text(texts[name], wanted))
    return digest
