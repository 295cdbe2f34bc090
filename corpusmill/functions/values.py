"""Functions on dates and numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date formats that texts of the trade use, after ISO's.
DATE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy", "MM/dd/yyyy", "M/d/yyyy", "yyyy/MM/dd")


def iso_date(text: Column) -> Column:
    """A date as yyyy-MM-dd: an ISO date at the start counts as it stands, else the first format that fits; null if none does."""
    iso = F.nullif(F.regexp_extract(text, r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit(""))
    tidy = F.regexp_replace(F.trim(text), r"\s+", " ")
    return F.coalesce(iso, *[F.date_format(F.try_to_date(tidy, f), "yyyy-MM-dd") for f in DATE_FORMATS])


def us_date(text: Column) -> Column:
    """mm/dd/yyyy as yyyy-mm-dd, without a look at the calendar."""
    return F.regexp_replace(text, r"^([0-9]+)/([0-9]+)/([0-9]+)$", "$3-$1-$2")


def latest_us_date(text: Column) -> Column:
    """The latest mm/dd/yyyy in a text, as yyyy-mm-dd."""
    return F.array_max(F.transform(F.regexp_extract_all(text, F.lit(r"\b([0-9]{2}/[0-9]{2}/[0-9]{4})\b"), F.lit(1)), us_date))


def comma_number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("bigint")


def leading_number(text: Column) -> Column:
    """The whole number that a text starts with."""
    return F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint")


def rounded(value: Column, places: int = 2) -> Column:
    """Half up on the binary value."""
    scale = float(10**places)
    return F.floor(value * scale + 0.5) / scale


def date_or(*dates: Column) -> Column:
    """The first date that is there, in order of trust."""
    return F.coalesce(*dates)


def size_band(n: Column) -> Column:
    return F.when(n <= 1, "solo").when(n <= 30, "small").when(n <= 300, "mid").when(n.isNotNull(), "large")


def grouped_number(n: Column) -> Column:
    return F.coalesce(F.format_number(n, 0), F.lit("?"))
