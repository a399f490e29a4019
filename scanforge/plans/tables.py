"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a folder of one
    machine would be unreadable for the others, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="scanforge-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/scanforge/{uuid.uuid4().hex}"


def save(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back, which cuts its lineage and gives exact statistics."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return load(df.sparkSession, path, df.schema)


def load(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a table with its declared schema, so partition values keep their types; of a table that grows, what its list names."""
    if exists(spark, f"{path}/_lists"):
        from scanforge.plans.ledger import Ledger

        return Ledger(spark, path, schema).load()
    return spark.read.schema(schema).parquet(path)


def _on_filesystem(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _on_filesystem(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _on_filesystem(spark, path)
    fs.delete(hadoop_path, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it doesn't exist."""
    fs, hadoop_path = _on_filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def size_of(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _on_filesystem(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _on_filesystem(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under another name first, then renamed, so that no reader sees half of it."""
    fs, final = _on_filesystem(spark, path)
    _, draft = _on_filesystem(spark, f"{path}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(final, False)
    if not fs.rename(draft, final):
        raise OSError(f"can't write {path}")


def load_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    if exists(spark, path):
        return load(spark, path, schema)
    return spark.createDataFrame([], schema)
