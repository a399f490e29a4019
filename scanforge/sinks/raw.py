"""Headerless float32 files of corrected frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from scanforge.functions import kernels
from scanforge.plans import tables
from scanforge.plans.ledger import Ledger
from scanforge.plans.tables import exists

# Frames per file; at 128 x 128 pixels 256 MiB, well below the 2 GiB a reader may load as one value.
FRAMES_PER_FILE = 4096
FILES_SCHEMA = "experiment string, subdir_str string, path string, first_frame bigint, n_frames bigint"


def export_raw(
    frames: DataFrame,
    root: str,
    byte_order: str = "<",
    frames_per_file: int = FRAMES_PER_FILE,
    merge_runs: bool = False,
) -> DataFrame:
    """Write ``{root}/{experiment}/out_{subdir_str}.raw/part-{first frame}-{attempt}`` and return the list of files.

    The list, kept in ``{root}.files``, says which files count; a failed or speculative attempt may leave others. The listed parts of a
    folder, joined in name order, are the frames of that acquisition in order. Each task
    writes the runs of frames it holds, at least a chunk each, without a shuffle. ``merge_runs`` first
    range-partitions the frames, for frames in arbitrary order or for fewer and longer files; a long
    acquisition is still written by several tasks. ``root`` is a folder that all executors can write to
    and must not exist yet.
    """
    spark = frames.sparkSession
    if exists(spark, root):
        raise ValueError(f"{root} exists; export into a new folder")
    ordered = ["experiment", "subdir_str", "frame_no"]
    runs = frames.select(*ordered, "pixels")
    if merge_runs:
        runs = runs.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    uri = root if "://" in root or root.startswith("/") else root.replace("file:", "file://", 1)
    report = runs.mapInArrow(
        kernels.write_runs(uri, byte_order, frames_per_file),
        FILES_SCHEMA,
    )
    # The report is what runs the export; it is kept beside the files so nothing is written twice.
    report.write.mode("overwrite").parquet(f"{root}.files")
    return spark.read.parquet(f"{root}.files")


class RawTable(Ledger):
    """Raw files of all batches of a run: a table of the files that count, which lie below ``{path}/files/{batch}-{attempt}``."""

    @property
    def files_path(self) -> str:
        return f"{self.path}/files"

    def write_batch(self, frames: list[DataFrame], batch_id: int, byte_order: str = "<") -> None:
        """Export a batch's frames. A batch that runs again writes other files, and the list then names only those."""
        attempt = self.folder(batch_id)
        listed = [export_raw(some, f"{self.files_path}/{attempt}/{i}", byte_order) for i, some in enumerate(frames)]
        rows = reduce(DataFrame.unionByName, listed) if listed else self.spark.createDataFrame([], FILES_SCHEMA)
        self.append(rows.coalesce(8), batch_id)
        for name in tables.names_in(self.spark, self.files_path):
            if name != attempt and name.startswith(f"{batch_id:012d}-"):
                tables.remove(self.spark, f"{self.files_path}/{name}")


def raw_table(spark: SparkSession, root: str) -> RawTable:
    return RawTable(spark, f"{root}/raw", FILES_SCHEMA)
