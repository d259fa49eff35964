from __future__ import annotations

from pyspark.sql import Column, functions as F

# ISO formats written at a text sink.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def timestamp_or_null(c: Column) -> Column:
    return F.try_to_timestamp(c)


def year_of(c: Column) -> Column:
    """Year of a date text ("2021", "2021-01-01", ...), NULL if not a date."""
    return F.year(F.try_to_timestamp(c))


def iso_text(c: Column, micros: bool = False) -> Column:
    return F.date_format(c, ISO_MICROS if micros else ISO_SECONDS)
