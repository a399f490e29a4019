"""The correction steps one by one on frames with an array of pixels.

The production plan does them in one kernel; these forms are for looking at a single step. All run as
built-in array functions, row by row, with the same lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.config import ACQUISITION
from scanforge.functions.words import paired_frames
from scanforge.operators import matrix
from scanforge.plans.joins import lookup_join, rows_within


def _without(frames: DataFrame, *columns: str) -> list[str]:
    return [c for c in frames.columns if c not in columns]


def subtract_background(frames: DataFrame, means: DataFrame) -> DataFrame:
    """Subtract the mean frame of the same experiment and parity; ``means`` holds one noise per experiment."""
    n = F.size("mean")
    mean = means.select("experiment", "parity", F.col("pixels").alias("mean"))
    width = mean.select(F.max(n)).first()[0] or 1
    joined = lookup_join(
        frames, mean, ["experiment", "parity"], salt=F.col("frame_no"), max_rows=rows_within(8 * width)
    )
    value = matrix.subtract(F.col("pixels"), F.col("mean"))
    return joined.select(*_without(frames, "pixels"), value.alias("pixels"))


def remove_offsets(frames: DataFrame, offsets: DataFrame) -> DataFrame:
    """Subtract each frame's own offset. Offsets are one row per frame, so their number decides the join."""
    key = [*ACQUISITION, "frame_no"]
    joined = lookup_join(frames, offsets.select(*key, "offset"), key, salt=F.col("frame_no"))
    value = F.expr("transform(pixels, v -> v - offset)")
    return joined.select(*_without(frames, "pixels"), value.alias("pixels"))


def apply_flat_field(frames: DataFrame, calibration: DataFrame, facts: DataFrame) -> DataFrame:
    """Multiply by the flat field of the parity and narrow; a last frame without partner is only narrowed."""
    flat = calibration.select("parity", "flat")
    joined = lookup_join(frames, flat, ["parity"], salt=F.col("frame_no"), max_rows=2)
    joined = lookup_join(
        joined, facts.select(*ACQUISITION, "n_frames"), ACQUISITION, salt=F.col("frame_no")
    )
    paired = F.col("frame_no") < paired_frames(F.col("n_frames"))
    value = F.when(paired, matrix.hadamard(F.col("pixels"), F.col("flat"))).otherwise(F.col("pixels"))
    return joined.select(*_without(frames, "pixels"), matrix.to_float(value).alias("pixels"))
