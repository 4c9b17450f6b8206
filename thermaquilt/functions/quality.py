"""Observation rules and encodings as columns: no UDFs, so they stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermaquilt import constants as K


def qa_clear(qa: Column) -> Column:
    return qa.bitwiseAND(F.lit(K.EXCLUDED_MASK)) == 0


def qa_water(qa: Column) -> Column:
    return qa.bitwiseAND(F.lit(1 << K.WATER_BIT)) != 0


def qa_bit(qa: Column, bit: int) -> Column:
    return qa.bitwiseAND(F.lit(1 << bit)) != 0


def not_fill(dn: Column) -> Column:
    return dn != K.FILL


def to_celsius(dn: Column) -> Column:
    return dn * F.lit(K.SCALE) + F.lit(K.OFFSET) - F.lit(K.KELVIN)


def in_trusted_range(c: Column) -> Column:
    return c.between(*K.OBSERVED_RANGE)


def valid_observation(dn: Column, qa: Column, c: Column) -> Column:
    return not_fill(dn) & qa_clear(qa) & in_trusted_range(c)


def masked_celsius(dn: Column, qa: Column) -> Column:
    c = to_celsius(dn)
    return F.when(valid_observation(dn, qa, c), c)


def legacy_masked_celsius(dn: Column, qa: Column) -> Column:
    """The superseded rule: cloud and shadow bits only, no range."""
    return F.when(not_fill(dn) & (qa.bitwiseAND(F.lit(K.LEGACY_MASK)) == 0), to_celsius(dn))


def encoded_dn(c: Column) -> Column:
    return F.rint((c - F.lit(K.ENCODE_ZERO)) / F.lit(K.ENCODE_STEP))


def encodable_dn(dn: Column) -> Column:
    return dn.between(K.FIRST_DN, K.LAST_DN)


def encode_celsius(c: Column) -> Column:
    dn = encoded_dn(c)
    return F.when(encodable_dn(dn), dn).otherwise(F.lit(float(K.NODATA))).cast("int")


def legacy_encode(c: Column) -> Column:
    """The superseded encoder, with numbers from 1 on."""
    dn = encoded_dn(c)
    return F.when(dn.between(1, K.LAST_DN), dn).otherwise(F.lit(0.0)).cast("int")


def decode(dn: Column) -> Column:
    return dn * F.lit(K.ENCODE_STEP) + F.lit(K.ENCODE_ZERO)


def hot_dn(celsius: float) -> int:
    """A threshold as a stored number, so the integers are compared."""
    return round((celsius - K.ENCODE_ZERO) / K.ENCODE_STEP)


def supported_output(c: Column, total: Column) -> Column:
    return (total >= K.MIN_OBSERVATIONS) & c.between(*K.OUTPUT_RANGE)


def observed_water(water: Column, clear: Column, c: Column) -> Column:
    """At least five clear looks, nine tenths of them water, and not too hot; a missing percentile keeps the class."""
    return (clear >= K.WATER_FLOOR) & (water >= F.lit(K.WATER_SHARE) * clear) & ~F.coalesce(c > K.WATER_CEILING, F.lit(False))


def keep_mask(offset: Column, n_valid: Column, floor: int = K.MIN_SAMPLES, cap: float = K.MAX_OFFSET) -> Column:
    return F.coalesce(offset.isNotNull() & (n_valid >= floor) & (F.abs(offset) <= cap), F.lit(False))


def share_of(part: Column, whole: Column) -> Column:
    """A ratio, null where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def saturated(n: Column) -> Column:
    return F.least(n, F.lit(K.SATURATED))


def month_counts(month: Column) -> list[Column]:
    """Aggregates: one saturated count for each calendar month."""
    return [saturated(F.count_if(month == m)).alias(f"m{m:02d}") for m in range(1, 13)]


def month_total() -> Column:
    return reduce(lambda a, b: a + b, [F.col(f"m{m:02d}") for m in range(1, 13)])
