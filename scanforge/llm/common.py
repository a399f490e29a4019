"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanforge.operators.scan import running_sum
from scanforge.plans import tables

WORD = r"[^\x20\x09-\x0D]+"
# Some hundred whole texts at a time: a batch stays within a few MiB, and one of the longest texts is a batch of its own size.
TEXT_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}

# Bytes of a text that are split into words at a time.
SLICE = 1 << 20
# Tasks that the rows of one key are dealt over.
SALTS = 16


def text_batches(spark: SparkSession) -> None:
    """Settings for Python workers that read whole texts."""
    for key, value in TEXT_BATCH.items():
        spark.conf.set(key, value)


def give_back() -> None:
    """Returns memory that is free to the system. A worker outlives its task, and what its allocators hold counts beside the stages that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Scratch:
    """Intermediate tables of one run in the cluster's shared folder, dropped as soon as nothing reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = tables.shared_dir(spark)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        return tables.save(df, f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            tables.remove(self.spark, f"{self.root}/{name}")

    def release(self) -> None:
        """Lets go of broadcasts and shuffle files of finished steps, here and on executors.

        Spark does that when the driver collects its garbage, which a roomy heap puts off: of its own accord every half hour. Meant for
        operators of many small jobs, between their steps.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(data: bytes) -> Iterator[bytes]:
    """Parts of a text in order, cut at blanks."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + SLICE)
        end = len(data) if end < 0 else end
        yield data[start:end]
        start = end


def salted(rows: DataFrame, table: DataFrame, on: list[str], by: str) -> DataFrame:
    """Join with a table of unique keys, a key's rows dealt over SALTS tasks by the column ``by``."""
    salt = fresh_name(rows, "_salt")
    many = rows.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return many.join(table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*on, salt]).drop(salt)


def least_hashes(keyed: DataFrame, group: str, n: int, scratch: Scratch, name: str = "hashes") -> DataFrame:
    """(group, h) of the ``n`` least different values of the long ``h`` in each group that isn't null.

    Only hashes are shuffled. Counts in 2^20 cells of the hash's range tell the cell in which the n-th lies, so the last sort holds about
    n + rows / 2^20 hashes of a group.
    """
    different = scratch.save(keyed.where(F.col(group).isNotNull()).select(group, "h").distinct(), name)
    cells = different.groupBy(group, F.shiftright("h", 44).alias("cell")).count()
    # Cells are summed in blocks, so no task sorts all cells of a group; one level covers 2^20.
    counted = running_sum(cells, [group], "cell", "count", "before", levels=1)
    last = counted.where(F.col("before") < n).groupBy(group).agg(F.max("cell").alias("last"))
    near = salted(different, last, [group], "h").where(F.shiftright("h", 44) <= F.col("last"))
    return near.withColumn("k", F.row_number().over(Window.partitionBy(group).orderBy("h"))).where(F.col("k") <= n).select(group, "h")


def sample_by_hash(rows: DataFrame, group: str, value: str, n: int, scratch: Scratch, name: str = "hashes") -> DataFrame:
    """(group, h, value) of the ``n`` different strings of least hash in each group, each of them once.

    Two scans: the first moves hashes only, the second keeps what lies below each group's last hash. One row per group is broadcast.
    """
    hashed = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(F.col(group).alias("g"), F.xxhash64(value).alias("h"), F.col(value).alias("v"))
    last = least_hashes(hashed.select("g", "h"), "g", n, scratch, name).groupBy("g").agg(F.max("h").alias("last"))
    chosen = hashed.join(F.broadcast(scratch.save(last, f"{name}_last")), "g").where(F.col("h") <= F.col("last"))
    return chosen.groupBy("g", "h").agg(F.min("v").alias("v")).select(F.col("g").alias(group), "h", F.col("v").alias(value))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sizes: dict[int, int], scratch: Scratch) -> DataFrame:
    """(label, h, text) of the different texts of least hash, ``sizes`` many of each label; texts stay where they are.

    ``docs``: doc_id and text; ``labels``: doc_id and the label. The join of both is on ids and hashes. A text that stands in several documents is
    represented by the least id; at most sum(sizes) ids are broadcast to fetch the texts.
    """
    known = labels.where(F.col(label).isin(*sizes)).select("doc_id", label).distinct()
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("h"), "text")
    keyed = scratch.save(texts.select("doc_id", "h").join(known, "doc_id").groupBy(label, "h").agg(F.min("doc_id").alias("doc_id")), "keyed")
    least = None
    for value, n in sizes.items():
        own = least_hashes(keyed.where(F.col(label) == value), label, n, scratch, f"hashes_{value}")
        least = own if least is None else least.union(own)
    chosen = scratch.save(keyed.join(F.broadcast(least), [label, "h"]), "chosen")
    return texts.join(F.broadcast(chosen), ["doc_id", "h"]).groupBy(label, "h").agg(F.min("text").alias("text"))
