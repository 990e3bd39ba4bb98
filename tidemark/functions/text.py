"""Canonical text and value maps."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode space separator (category Zs); all lie below U+3001.
SPACES = "".join(c for c in map(chr, range(0x3001)) if unicodedata.category(c) == "Zs")


def trimmed(c: Column) -> Column:
    """Strip every Unicode space separator (not tabs or line ends) from both ends.

    Pure ASCII text, the usual case, can only hold the plain space.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.trim(c)).otherwise(F.trim(c, F.lit(SPACES)))


def canonical(c: Column) -> Column:
    return F.upper(trimmed(c))


def optional(c: Column) -> Column:
    """Canonical text, with the empty string read as absent."""
    return F.nullif(canonical(c), F.lit(""))


def mapped(c: Column, mapping: Iterable[tuple[str, str]]) -> Column:
    """Canonical value of ``c`` under ``mapping``; NULL when it has none."""
    text, out = canonical(c), None
    for value, target in mapping:
        hit = text == F.lit(value)
        out = F.when(hit, F.lit(target)) if out is None else out.when(hit, F.lit(target))
    return out


def recoded(c: Column, mapping: Iterable[tuple[str, str]]) -> Column:
    """True where the value is not already one of the canonical targets."""
    targets = list(dict.fromkeys(target for _, target in mapping))
    return ~canonical(c).isin(*targets)


def has_text(c: Column) -> Column:
    """Neither NULL nor empty; never NULL itself."""
    return F.coalesce(c != F.lit(""), F.lit(False))
