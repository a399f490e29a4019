"""Mean of the noise frames by parity, and its subtraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanforge.config import ACQUISITION, Geometry
from scanforge.functions import kernels
from scanforge.functions.words import paired_frames
from scanforge.operators.decode import word_masks
from scanforge.plans.joins import lookup_join

# Pixels of a block: one column of sums for each, so that a hash aggregate adds them.
SUM_WIDTH = 64
SUMS_SCHEMA = "experiment string, noise_subdir string, n_frames bigint, parity int, block int, " + ", ".join(f"s{i} double" for i in range(SUM_WIDTH))


def _mean(total: Column, n_frames: Column) -> Column:
    """Mean over the paired frames of one parity; a lone frame leaves an undefined even mean, a zero odd one."""
    pairs = F.floor(n_frames / 2)
    undefined = F.when(F.col("parity") == 0, F.lit(float("nan"))).otherwise(F.lit(0.0))
    return F.when(pairs > 0, total / F.greatest(pairs, F.lit(1).cast("bigint"))).otherwise(undefined)


def noise_means(chunks: DataFrame, calibration: dict, geometry: Geometry) -> DataFrame:
    """Array form: noise chunks (with ``frame_start``, ``n_frames``) to one mean frame per noise and parity.

    Each task sums its own frames first, so the shuffle carries two frames per task and noise, 8 bytes a pixel. They go in blocks of
    SUM_WIDTH pixels whose sums merge like any aggregate, and their key holds the block, so even a single huge noise is reduced by many tasks.
    """
    sums = chunks.select(*ACQUISITION, "chunk_i", "frame_start", "n_frames", "data").mapInArrow(
        kernels.noise_sums(geometry.pixels, calibration, word_masks(), SUM_WIDTH), SUMS_SCHEMA
    )
    keys = ["experiment", "noise_subdir", "n_frames", "parity"]
    columns = [f"s{i}" for i in range(SUM_WIDTH)]
    blocks = sums.groupBy(*keys, "block").agg(*[F.sum(c).alias(c) for c in columns])
    means = blocks.select(*keys, "block", F.array(*[_mean(F.col(c), F.col("n_frames")) for c in columns]).alias("m"))
    # One entry per block of the sensor, so the list is bounded by the geometry.
    ordered = F.array_sort(F.collect_list(F.struct("block", "m")))
    pixels = F.slice(F.flatten(F.transform(ordered, lambda b: b.m)), 1, geometry.pixels)
    return means.groupBy(*keys).agg(pixels.alias("pixels")).select(
        "experiment", "noise_subdir", "parity", "n_frames", "pixels"
    )


def means_by_noise(means: DataFrame) -> DataFrame:
    """Both mean frames of a noise in one row, ``mean_0`` and ``mean_1``."""

    def of(parity: int) -> Column:
        return F.first(F.when(F.col("parity") == parity, F.col("pixels")), ignorenulls=True)

    return means.groupBy("experiment", "noise_subdir").agg(of(0).alias("mean_0"), of(1).alias("mean_1"))


def noise_pixel_means(pixels: DataFrame, facts: DataFrame) -> DataFrame:
    """Long form of ``noise_means``; ``facts`` gives ``n_frames`` per acquisition."""
    n_frames = facts.select(*ACQUISITION, "n_frames")
    paired = lookup_join(pixels, n_frames, ACQUISITION, salt=F.col("pos")).filter(
        F.col("frame_no") < paired_frames(F.col("n_frames"))
    )
    return paired.groupBy("experiment", F.col("subdir_str").alias("noise_subdir"), "parity", "pos").agg(
        F.avg("value").alias("mean")
    )


def subtract_background(pixels: DataFrame, means: DataFrame, n_means: int | None = None) -> DataFrame:
    """Long form: subtract the mean of the same experiment, parity and position.

    ``n_means`` is a known bound for the rows of ``means``, so that they need not be counted.
    """
    rest = [c for c in pixels.columns if c != "value"]
    keys = ["experiment", "parity", "pos"]
    joined = lookup_join(pixels, means.select(*keys, "mean"), keys, salt=F.col("frame_no"), small_rows=n_means)
    return joined.select(*rest, (F.col("value") - F.col("mean")).alias("value"))
