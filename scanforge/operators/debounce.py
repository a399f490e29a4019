"""Per-frame histogram, its mode, the offset fitted around it, and the removal of that offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanforge.config import OffsetRule
from scanforge.functions.words import bin_of

RULE = OffsetRule()


def _all_bins(pixels: DataFrame, frame: list[str], rule: OffsetRule) -> DataFrame:
    """Counts per bin, plus bin -1 for values outside, so that no frame gets lost."""
    return pixels.groupBy(*frame, bin_of(F.col("value"), rule).alias("bin")).agg(F.count("*").alias("n"))


def frame_histogram(pixels: DataFrame, frame: list[str], rule: OffsetRule = RULE) -> DataFrame:
    """Non-empty bins of each frame. Counting starts before the shuffle: at most one row per bin moves."""
    return _all_bins(pixels, frame, rule).filter(F.col("bin") >= 0)


def _score(rule: OffsetRule) -> Column:
    """Larger for a larger count, then for a smaller bin; values outside count nothing."""
    inside = F.col("bin") >= 0
    count = F.when(inside, F.col("n")).otherwise(F.lit(0).cast("bigint"))
    first = F.lit(rule.n_bins - 1) - F.when(inside, F.col("bin")).otherwise(F.lit(0).cast("bigint"))
    return count * rule.n_bins + first


def _peak(score: Column, rule: OffsetRule) -> Column:
    return F.floor(score / rule.n_bins)


def _peak_bin(score: Column, rule: OffsetRule) -> Column:
    return F.lit(rule.n_bins - 1) - F.pmod(score, F.lit(rule.n_bins))


def histogram_mode(pixels: DataFrame, frame: list[str], rule: OffsetRule = RULE) -> DataFrame:
    """Peak count and first bin (1-based) that has it; (0, 1) for a frame with no value inside."""
    best = _all_bins(pixels, frame, rule).groupBy(*frame).agg(F.max(_score(rule)).alias("s"))
    return best.select(
        *frame,
        _peak(F.col("s"), rule).alias("hist_max"),
        (_peak_bin(F.col("s"), rule) + 1).cast("int").alias("hist_arg"),
    )


def _by_width(width: Column, sums: list[int]) -> Column:
    """Sum of weight powers for a window of that many bins."""
    return F.element_at(F.array(*[F.lit(float(s)) for s in sums]), width.cast("int"))


def frame_offsets(pixels: DataFrame, frame: list[str], rule: OffsetRule = RULE) -> DataFrame:
    """Peak count, peak bin (1-based) and offset of each frame.

    After the histogram one shuffle on the frame remains: the window finds the peak, and the sums around
    it use the same partitioning. A parabola through the counts near the peak gives its sub-bin position.
    """
    best = F.max(_score(rule)).over(Window.partitionBy(*frame))
    bins = _all_bins(pixels, frame, rule).withColumn("s", best)
    start = F.greatest(F.col("peak_bin") - rule.half_width, F.lit(0).cast("bigint"))
    stop = F.least(F.col("peak_bin") + rule.half_width + 1, F.lit(rule.n_bins).cast("bigint"))
    bins = (
        bins.withColumn("peak", _peak(F.col("s"), rule))
        .withColumn("peak_bin", _peak_bin(F.col("s"), rule))
        .withColumn("start", start)
        .withColumn("width", stop - start)
    )
    near = (F.col("bin") >= F.col("start")) & (F.col("bin") < F.col("start") + F.col("width"))
    n = F.when(near, F.col("n")).otherwise(F.lit(0).cast("bigint"))
    # Near a border the window is cut, yet its weights still begin at -half_width.
    w = F.col("bin") - F.col("start") - rule.half_width
    sums = bins.groupBy(*frame, "peak", "peak_bin", "width").agg(
        F.sum(n).cast("double").alias("s_y"),
        F.sum(w * n).cast("double").alias("s_wy"),
        F.sum(w * w * n).cast("double").alias("s_w2y"),
    )
    sums = sums.withColumn("s_w2", _by_width(F.col("width"), rule.weight_sums(2))).withColumn(
        "s_w4", _by_width(F.col("width"), rule.weight_sums(4))
    )
    points = F.lit(float(rule.n_points))
    curvature = (points * F.col("s_w2y") - F.col("s_w2") * F.col("s_y")) / (
        points * F.col("s_w4") - F.col("s_w2") * F.col("s_w2")
    )
    fitted = sums.withColumn("slope", F.col("s_wy") / F.col("s_w2")).withColumn("curvature", curvature)
    curved = F.abs("curvature") > rule.min_curvature
    shift = F.when(curved, -F.col("slope") / (2 * F.col("curvature"))).otherwise(0.0)
    centre = F.lit(rule.low) + F.lit(rule.step) * F.col("peak_bin") + F.lit(rule.step / 2)
    fitted = fitted.withColumn("o", centre + shift * rule.step)
    none = (F.col("peak") <= rule.min_peak) | (F.abs("o") > rule.max_offset)
    return fitted.select(
        *frame,
        F.col("peak").alias("hist_max"),
        (F.col("peak_bin") + 1).cast("int").alias("hist_arg"),
        F.when(none, 0.0).otherwise(F.col("o")).alias("offset"),
    )


def remove_offsets(pixels: DataFrame, offsets: DataFrame, frame: list[str]) -> DataFrame:
    """Subtract each frame's offset from all its values."""
    rest = [c for c in pixels.columns if c != "value"]
    return pixels.join(offsets.select(*frame, "offset"), frame).select(
        *rest, (F.col("value") - F.col("offset")).alias("value")
    )
