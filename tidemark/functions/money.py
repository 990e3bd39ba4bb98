"""Sums of double amounts that do not depend on row order and can be taken back.

An amount counts with its shortest decimal form, split into a whole and a fractional part
that are summed as decimals. Amounts of at most two decimals below 1e9, nearly all, are added
as whole hundredths in two long integers instead, without a decimal or a text on the way.
Amounts without such a form (at or above 1e24, or finer than 1e-18) are summed as doubles
beside it; NaN and infinities are counted. No amount is rounded or left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE, FRACTION = "decimal(34,0)", "decimal(34,18)"
# Hundredths are added in two parts, so that neither sum runs over before 2^43 rows.
LOW_BITS = 20
_PARTS = {"high": "bigint", "low": "bigint", "whole": WHOLE, "fraction": FRACTION, "n": "bigint", "odd": "double",
          "n_odd": "bigint", "n_nan": "bigint", "n_up": "bigint", "n_down": "bigint"}


def sum_parts(c: Column, sign: Column | None = None) -> Column:
    """The state of a sum, as a struct. ``sign`` (+1, -1) adds a row or takes it away."""
    sign = F.lit(1) if sign is None else sign
    # fewer than 15 digits, so the hundredths are the shortest form if they give the amount
    rounded = F.rint(c * 100.0)
    plain = (F.abs(c) < 1e9) & (rounded / 100.0 == c)
    hundredths = F.when(plain, rounded.try_cast("bigint"))
    other = F.when(plain, None).otherwise(c)
    fine, large = other.try_cast("decimal(36,18)"), other.try_cast("decimal(24,0)")
    is_fine, is_large = fine.cast("double") == other, large.cast("double") == other
    floor = F.floor(fine)
    whole = F.when(is_fine, floor.cast("decimal(24,0)")).when(is_large, large)
    fraction = F.when(is_fine, (fine - floor).cast("decimal(24,18)"))
    infinite = F.abs(c) == float("inf")
    odd = F.when(whole.isNull() & ~F.isnan(other) & ~infinite, other)

    def signed(value: Column) -> Column:
        return F.when(sign < 0, -value).otherwise(value)

    def count(hit: Column) -> Column:
        return F.sum(F.when(hit, sign).otherwise(0)).cast("bigint")

    return F.struct(
        F.sum(signed(F.shiftright(hundredths, LOW_BITS))).alias("high"),
        F.sum(signed(hundredths.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))).alias("low"),
        F.sum(signed(whole)).cast(WHOLE).alias("whole"),
        F.sum(signed(fraction)).cast(FRACTION).alias("fraction"),
        count(c.isNotNull()).alias("n"),
        F.sum(signed(odd)).alias("odd"), count(odd.isNotNull()).alias("n_odd"),
        count(F.isnan(c)).alias("n_nan"), count(c == float("inf")).alias("n_up"),
        count(c == float("-inf")).alias("n_down"))


def add_parts(state: str) -> Column:
    """The states of a struct column added up."""
    return F.struct(*[F.sum(F.col(f"{state}.{p}")).cast(kind).alias(p)
                      for p, kind in _PARTS.items()])


def total(state: Column) -> Column:
    """The sum a state stands for; NULL when it has no terms. A total below 1e18 is rounded
    to a double once."""
    high, low = [F.coalesce(state[p], F.lit(0)).cast("decimal(19,0)") for p in ("high", "low")]
    plain = (high * F.lit(1 << LOW_BITS) + low) / F.lit(100)
    units = F.floor(plain)
    whole = F.coalesce(state["whole"], F.lit(0).cast(WHOLE)) + units
    fraction = (F.coalesce(state["fraction"], F.lit(0).cast(FRACTION)) + (plain - units)).cast(
        FRACTION)
    exact = F.coalesce((whole.try_cast("decimal(18,0)") + fraction).cast("double"),
                       whole.cast("double") + fraction.cast("double"))
    return (F.when(state["n"] == 0, None)
            .when((state["n_nan"] > 0) | ((state["n_up"] > 0) & (state["n_down"] > 0)),
                  float("nan"))
            .when(state["n_up"] > 0, float("inf"))
            .when(state["n_down"] > 0, float("-inf"))
            .when(state["n_odd"] > 0, exact + state["odd"])
            .otherwise(exact))


def exact_sum(c: Column) -> Column:
    return total(sum_parts(c))
