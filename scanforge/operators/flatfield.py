"""Flat-field multiplication and narrowing to the output precision, long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.config import ACQUISITION
from scanforge.functions.words import paired_frames
from scanforge.plans.joins import lookup_join


def apply_flat_field(pixels: DataFrame, calibration: DataFrame, facts: DataFrame) -> DataFrame:
    """Multiply by the flat field of the same parity; a last frame without partner stays as it is."""
    rest = [c for c in pixels.columns if c != "value"]
    flat = calibration.select("parity", "pos", "flat")
    n_frames = facts.select(*ACQUISITION, "n_frames")
    paired = F.col("frame_no") < paired_frames(F.col("n_frames"))
    value = F.when(paired, F.col("value") * F.col("flat").cast("double")).otherwise(F.col("value"))
    joined = lookup_join(pixels, flat, ["parity", "pos"], salt=F.col("frame_no"))
    return lookup_join(joined, n_frames, ACQUISITION, salt=F.col("pos")).select(*rest, value.alias("value"))


def narrow(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("value", F.col("value").cast("float"))
