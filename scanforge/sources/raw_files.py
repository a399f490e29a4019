"""Raw scan files: cutting them into packets, and reading exported frames back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.config import Geometry
from scanforge.functions import kernels
from scanforge.operators.decode import FRAME_COLUMNS
from scanforge.operators.select import kind
from scanforge.plans.joins import lookup_join


def chunk_bytes(size: Column, n_chunks: int) -> Column:
    """Chunk length that cuts ``size`` bytes into ``n_chunks`` equal chunks plus a rest, at least 1."""
    return F.greatest(F.floor(size / n_chunks), F.lit(1).cast("bigint"))


def cut_into_chunks(files: DataFrame, n_chunks: int = 1024, content: str = "content") -> DataFrame:
    """Rows with a BINARY ``content`` to one row per chunk, numbered from 1, the last one possibly short.

    Empty content is one empty chunk, so that no file vanishes.
    """
    rest = [c for c in files.columns if c != content]
    size = F.octet_length(content).cast("bigint")
    sized = files.withColumn("_size", size).withColumn("_step", chunk_bytes(F.col("_size"), n_chunks))
    total = F.greatest(F.ceil(F.col("_size") / F.col("_step")), F.lit(1)).cast("bigint")
    numbered = sized.withColumn("n_total_chunks", total).filter("_size is not null")
    numbered = numbered.withColumn("chunk_i", F.explode(F.sequence(F.lit(1).cast("bigint"), "n_total_chunks")))
    start = ((F.col("chunk_i") - 1) * F.col("_step") + 1).cast("int")
    return numbered.select(
        *rest,
        "chunk_i",
        "n_total_chunks",
        F.substring(F.col(content), start, F.col("_step").cast("int")).alias("data"),
    )


def files_to_packets(
    spark: SparkSession, path: str, experiment: str, n_chunks: int = 1024, raw_name: str | None = None
) -> DataFrame:
    """Raw files below ``path`` to packets; the parent folder is the acquisition.

    Files above Spark's 2 GiB limit for one binary value are refused by the reader; use
    ``read_scan_records`` for those.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    parts = F.split("path", "/")
    named = files.select(
        F.lit(experiment).alias("experiment"),
        F.element_at(parts, -2).alias("subdir_str"),
        (F.lit(raw_name) if raw_name else F.element_at(parts, -1)).alias("filename"),
        F.lit("").alias("filename_append"),
        F.col("content"),
    )
    chunks = cut_into_chunks(named, n_chunks)
    return chunks.withColumn("chunk_hash", F.unhex(F.sha2("data", 512))).withColumn("kind", kind())


def read_scan_records(spark: SparkSession, path: str, frame_bytes: int) -> DataFrame:
    """One raw file of any size as (frame_no, data), read in parallel at record boundaries.

    This is the one place where an RDD is used: Spark SQL has no splittable reader for headerless
    fixed-length records.
    """
    records = spark.sparkContext.newAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.input.FixedLengthInputFormat",
        "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.BytesWritable",
        conf={"fixedlengthinputformat.record.length": str(frame_bytes)},
    )
    rows = records.map(lambda kv: (kv[0] // frame_bytes, bytes(kv[1])))
    return spark.createDataFrame(rows, "frame_no bigint, data binary")


def read_float_parts(parts: DataFrame, geometry: Geometry, byte_order: str = "<") -> DataFrame:
    """Parts (experiment, subdir_str, chunk_i, frame_start, data) of float32 bytes to frames.

    ``byte_order`` is ``<`` for little-endian and ``>`` for big-endian files.
    """
    columns = parts.select("experiment", "subdir_str", "chunk_i", "frame_start", "data")
    return columns.mapInArrow(
        kernels.unpack_parts(geometry.pixels, byte_order), FRAME_COLUMNS + ", pixels array<float>"
    )


def read_exported(spark: SparkSession, root: str, geometry: Geometry, byte_order: str = "<") -> DataFrame:
    """Frames of an export written by ``sinks.raw.export_raw``: of the files that its list names, and no others."""
    return read_listed(spark.read.parquet(f"{root}.files"), root, geometry, byte_order)


def read_listed(listed: DataFrame, root: str, geometry: Geometry, byte_order: str = "<") -> DataFrame:
    """Frames of the float32 files below ``root`` that ``listed`` (experiment, subdir_str, path) names."""
    files = listed.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    parts = F.split("path", "/")
    name = lambda: F.element_at(F.split("path", "/"), -1)
    listed = listed.select("experiment", "subdir_str", name().alias("name"))
    files = lookup_join(files.withColumn("name", name()).withColumn("experiment", F.element_at(parts, -3)).withColumn(
        "subdir_str", F.regexp_extract(F.element_at(parts, -2), r"^out_(.*)\.raw$", 1)), listed, ["experiment", "subdir_str", "name"], None, "left_semi")
    first = F.regexp_extract("path", r"part-(\d+)-\w+$", 1).cast("bigint")
    named = files.select(
        "experiment",
        "subdir_str",
        F.lit(None).cast("bigint").alias("chunk_i"),
        first.alias("frame_start"),
        F.col("content").alias("data"),
    )
    return read_float_parts(named, geometry, byte_order)
