"""Filters, projections and the join of raw scans with their operation files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanforge.config import (
    ANCILLARY_MARKS,
    NOISE_MARK,
    OPERATION_SUFFIX_LENGTH,
    RAW_SCAN_NAME,
)
from scanforge.plans.joins import lookup_join


def with_experiment(df: DataFrame, experiment: str) -> DataFrame:
    return df.withColumn("experiment", F.lit(experiment))


def register_packets(packets: DataFrame, view: str = "packets") -> DataFrame:
    """Make packets available to ``spark.sql`` under a name."""
    packets.createOrReplaceTempView(view)
    return packets


def is_raw_scan(raw_name: str = RAW_SCAN_NAME) -> Column:
    return F.col("filename") == raw_name


def is_operation_file(raw_name: str = RAW_SCAN_NAME) -> Column:
    """True where the file name without its last four characters is the directory name.

    A raw scan is never its own operation file, whatever its directory is called.
    """
    stem = F.expr(f"substring(filename, 1, char_length(filename) - {OPERATION_SUFFIX_LENGTH})")
    return (stem == F.col("subdir_str")) & ~is_raw_scan(raw_name)


def exclude_ancillary(df: DataFrame, column: str = "filename") -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [~F.col(column).contains(m) for m in ANCILLARY_MARKS]))


def kind(column: str = "subdir_str") -> Column:
    return F.when(F.col(column).contains(NOISE_MARK), "noise").otherwise("signal")


def pairing_key(column: str = "subdir_str") -> Column:
    """Lower-cased directory name without its noise suffix, equal for a noise and its signal."""
    return F.regexp_replace(F.lower(column), f"_?{NOISE_MARK}$", "")


def raw_scans(packets: DataFrame, raw_name: str = RAW_SCAN_NAME) -> DataFrame:
    return packets.filter(is_raw_scan(raw_name))


def operation_files(packets: DataFrame, raw_name: str = RAW_SCAN_NAME) -> DataFrame:
    """One row per directory and operation file, however many chunks or copies the file came in."""
    return packets.filter(is_operation_file(raw_name)).select("subdir_str", "filename").distinct()


def _joined_columns(raw: DataFrame) -> list[Column]:
    return [
        F.col("chunk_i").alias("raw_chunk_i"),
        F.col("n_total_chunks").alias("raw_n_total_chunks"),
        F.col("subdir_str").alias("raw_subdir_str"),
        F.col("filename").alias("raw_filename"),
        F.col("data").alias("raw_data"),
        F.col("opr_filename"),
        F.col("subdir_str").alias("opr_subdir_str"),
        F.col("experiment").alias("my_experiment"),
    ]


def raw_operation_join(packets: DataFrame, raw_name: str = RAW_SCAN_NAME) -> DataFrame:
    """Every raw chunk whose directory also holds an operation file.

    The operation side is names only and is broadcast after a check of its size, so the payload of the
    raw side stays where it was read.
    """
    operations = operation_files(packets, raw_name).withColumnRenamed("filename", "opr_filename")
    raw = raw_scans(packets, raw_name)
    joined = lookup_join(raw, operations, ["subdir_str"], salt=F.col("chunk_i"))
    return joined.select(*_joined_columns(raw))
