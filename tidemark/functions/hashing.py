"""Identity, change and content hashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.model import HASH_SEPARATOR, NULL_MARK, OCCURRENCE_MARK


def key_hash(columns: Iterable[str]) -> Column:
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[F.col(c).cast("string") for c in columns]))


def attribute_hash(columns: Iterable[str]) -> Column:
    """NULL is spelled out, so that it differs from '' and keeps its place."""
    return F.md5(F.concat_ws(
        HASH_SEPARATOR,
        *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]))


def occurrence_hash(key: Column, occurrence: Column) -> Column:
    return F.md5(F.concat(key, F.lit(OCCURRENCE_MARK), occurrence.cast("string")))


def version_hash(key: Column, valid_from: Column) -> Column:
    """Version identity. A key opens at most one version per date, so the pair is unique."""
    return F.md5(F.concat(key, F.lit(OCCURRENCE_MARK), valid_from.cast("string")))


def multiset_checksum(row_hash: Column) -> Column:
    """Checksum of a set of rows, as text, from the md5 of each: its four 32-bit parts added up
    apart. Neither the order of the rows nor how they are dealt out matters, every repeated
    row does, and any engine with md5 can compute it."""
    # halves of 16 bits add up in long integers, which no number of rows below 2^47 fills
    values = [F.conv(F.substring(row_hash, 1 + 8 * k, 8), 16, 10).cast("bigint")
              for k in range(4)]

    def added(half: Column) -> Column:
        return F.coalesce(F.sum(half), F.lit(0)).cast("decimal(19,0)")

    return F.concat_ws(":", *[
        (added(F.shiftright(v, 16)) * F.lit(1 << 16) + added(v.bitwiseAND(F.lit((1 << 16) - 1))))
        .cast("string") for v in values])
