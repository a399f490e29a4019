"""Column expressions over detector words and pixel values (one row per pixel)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanforge.config import ANALOG_MASK, DIGITAL_MASK, DIGITAL_SHIFT, GAIN_SHIFT, OffsetRule


def analog(word: Column) -> Column:
    return word.bitwiseAND(F.lit(ANALOG_MASK))


def digital(word: Column) -> Column:
    return F.shiftright(word, DIGITAL_SHIFT).bitwiseAND(F.lit(DIGITAL_MASK))


def gain(word: Column) -> Column:
    return F.shiftright(word, GAIN_SHIFT).bitwiseAND(F.lit(1))


def decoded(word: Column, g1: Column, g2: Column, off: Column) -> Column:
    """Pixel value of a word: analog count, scaled in the high-gain state, plus the digital count."""
    count = analog(word).cast("double")
    high = g1.cast("double") * (count - off.cast("double"))
    low_part = F.when(gain(word) == 1, high).otherwise(count)
    return low_part + g2.cast("double") * digital(word).cast("double")


def bin_of(value: Column, rule: OffsetRule) -> Column:
    """Histogram bin of a value, -1 outside the histogram (and for NaN)."""
    inside = (value >= rule.low) & (value < rule.high)
    # The last edge can be reached by rounding alone.
    index = F.least(F.floor((value - rule.low) / rule.step), F.lit(rule.n_bins - 1).cast("bigint"))
    return F.when(inside, index).otherwise(F.lit(-1).cast("bigint"))


def paired_frames(n_frames: Column) -> Column:
    """Number of frames that have a partner of the other parity."""
    return F.lit(2) * F.floor(n_frames / 2)
