"""Dates that arrive as text in more than one format."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import trimmed


# Year, month, day; then nothing, or a time of day with an optional zone.
ISO = (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
       r"([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?( ?(Z|UTC|[+-][0-9]{2}(:?[0-9]{2})?))?)?$")


def iso_date(c: Column) -> Column:
    """Year, month and day, with an optional time part.

    A bare cast also takes "2024" and "2024-01", completing a day the source never named,
    years of other lengths, and any text after the day. So the whole text has to fit.
    """
    text = trimmed(c)
    return F.when(text.rlike(ISO), text.try_cast("date"))


def parsed_date(c: Column, formats: Iterable[str]) -> Column:
    """ISO first, then each alternative format; NULL when none fits."""
    text = trimmed(c)
    return F.coalesce(iso_date(c), *[F.try_to_date(text, f) for f in formats])


def reformatted(c: Column) -> Column:
    return iso_date(c).isNull()
