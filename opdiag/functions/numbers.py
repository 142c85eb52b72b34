"""Ratios and rounding that do not depend on the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """Floating division; NULL when the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_half_up(value: Column, digits: int) -> Column:
    """Round through a decimal so that ties such as 0.285 always go up."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_half_up(ratio(part, whole), digits)


def rank_bucket(value: Column, bits: int = 11) -> Column:
    """Order-preserving bucket of a bigint: its sign, magnitude and leading ``bits`` bits.

    Numbers below ``2**bits`` keep a bucket of their own; larger ones share it with neighbours
    within a relative distance of ``2**(1 - bits)``. There are at most ``2 * 64 * 2**bits`` buckets.
    The logarithm may be off by one next to a power of two, which moves a bucket limit but keeps
    the order: equal numbers share a bucket and a larger number never gets a lower one.
    """
    size = F.abs(value)
    magnitude = F.floor(F.log2(F.greatest(size, F.lit(1).cast("bigint")))).cast("int")
    shift = F.greatest(magnitude - (bits - 1), F.lit(0))
    lead = F.call_function("shiftright", size, shift) + shift * (1 << bits)
    return F.when(value < 0, -lead).otherwise(lead)


def middle_of(values: Column) -> Column:
    """Median of a sorted array."""
    low = F.floor((F.size(values) - 1) / 2).cast("int")
    high = F.floor(F.size(values) / 2).cast("int")
    return F.get(values, low) / 2 + F.get(values, high) / 2
