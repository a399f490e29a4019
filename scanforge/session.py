"""Session settings that suit rows of 64 KiB to a few MiB."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # A batch of chunks or frames stays within tens of MiB on both sides of a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # Parquet readers decode this many payload rows at a time; the default of 4096 assumes small rows.
    "spark.sql.parquet.columnarReaderBatchSize": "64",
    # One task writes a few acquisitions side by side instead of sorting its frames by acquisition.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
