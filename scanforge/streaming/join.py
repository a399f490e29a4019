"""The raw × operation-file join on an unbounded stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.config import RAW_SCAN_NAME
from scanforge.operators.select import _joined_columns, is_operation_file, is_raw_scan


def raw_operation_stream_join(
    packets: DataFrame,
    raw_name: str = RAW_SCAN_NAME,
    time_column: str | None = None,
    delay: str | None = None,
    max_gap: str | None = None,
) -> DataFrame:
    """Inner stream-stream join on the directory.

    Without ``time_column`` both sides stay in state for ever, as an unbounded join must. With it, ``delay`` and ``max_gap`` must be
    given: rows later than ``delay`` are dropped, and packets further apart than ``max_gap`` don't meet. Copies of an
    operation file are remembered for the sum of both, so a late copy can't match a raw packet again.
    """
    raw = packets.filter(is_raw_scan(raw_name))
    operations = packets.filter(is_operation_file(raw_name)).select(
        "subdir_str", F.col("filename").alias("opr_filename"), *([time_column] if time_column else [])
    )
    if time_column is None:
        operations = operations.dropDuplicates(["subdir_str", "opr_filename"])
        return raw.join(operations, "subdir_str").select(*_joined_columns(raw))
    if not (delay and max_gap):
        raise ValueError("with a time column, delay and max_gap must be given: they decide which pairs are lost")
    raw = raw.withWatermark(time_column, delay)
    operations = (
        operations.withColumnRenamed(time_column, "opr_time")
        # A copy matters while raw packets within max_gap on either side of it may still come.
        .withWatermark("opr_time", f"{delay} {max_gap} {max_gap}")
        .dropDuplicatesWithinWatermark(["subdir_str", "opr_filename"])
        .withColumnRenamed("subdir_str", "opr_subdir")
    )
    near = F.expr(
        f"opr_subdir = subdir_str AND opr_time BETWEEN {time_column} - INTERVAL {max_gap} "
        f"AND {time_column} + INTERVAL {max_gap}"
    )
    return raw.join(operations, near).select(*_joined_columns(raw))
