"""The histogram log: one line per frame, in frame order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.config import ACQUISITION
from scanforge.operators.scan import running_sum
from scanforge.plans.ledger import Ledger, Part

LOG_SCHEMA = "experiment string, log_name string, frame_no bigint, line string"
# A task may write a log in several files, numbered after its own number.
FILES_OF_TASK = 1024


def log_lines(stats: DataFrame) -> DataFrame:
    line = F.format_string("%d : %d", "hist_max", "hist_arg")
    return stats.select(
        *ACQUISITION, F.concat(F.lit("hist_"), "subdir_str", F.lit(".txt")).alias("log_name"), "frame_no", line.alias("line")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    # Never null, so that the writer accepts this order as it is and does not sort by folder again.
    folders = {c: F.coalesce(c, F.lit("unknown")) for c in ("experiment", "log_name")}
    ordered = [*folders, "frame_no"]
    lines = lines.withColumns(folders).repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    lines = lines.select(*folders, F.col("line").alias("value"))
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).text(path)


def write_log(stats: DataFrame, path: str) -> None:
    """A folder per log. Its files, read in name order, hold the lines in frame order. Logs of other signals stay.

    Rows are range-partitioned on acquisition and frame, so a long acquisition is written by several tasks.
    """
    write_lines(log_lines(stats), path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the logs below a folder with their frame: a line's place in the log's files, in name order.

    A file is one task's share of a log. Only the files' line counts meet, in a running sum by file.
    """
    files = spark.read.schema("value string, experiment string, log_name string").text(path, wholetext=True)
    number = lambda pattern: F.coalesce(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    place = number(r"^part-(\d+)") * FILES_OF_TASK + number(r"-c(\d+)\.txt")
    split = files.select("experiment", "log_name", place.alias("place"), F.split(F.regexp_replace("value", r"\n\z", ""), "\n").alias("lines"))
    counted = split.select("experiment", "log_name", "place", F.size("lines").cast("bigint").alias("n"))
    first = running_sum(counted, ["experiment", "log_name"], "place", "n", "first").drop("n")
    lines = split.select("experiment", "log_name", "place", F.posexplode("lines").alias("at", "line")).join(first, ["experiment", "log_name", "place"])
    return lines.select("experiment", "log_name", (F.col("first") + F.col("at")).alias("frame_no"), "line")


class LogTable(Ledger):
    """Logs of all batches of a run; each batch's files count once, however often it was tried."""

    def write(self, df: DataFrame, folder: str) -> None:
        write_lines(df, self.path_of(folder))

    def _load(self, parts: list[Part]) -> DataFrame:
        # A log is written by one batch, so its lines are in one part.
        read = [read_log(self.spark, self.path_of(p.folder)) for p in parts]
        return reduce(DataFrame.unionByName, read) if read else self.spark.createDataFrame([], LOG_SCHEMA)

    def _spread(self, rows: DataFrame, n_files: int) -> DataFrame:
        return rows

    def write_batch(self, stats: list[DataFrame], batch_id: int) -> None:
        folders = []
        for some in stats:
            folders.append(self.folder(batch_id))
            self.write(log_lines(some), folders[-1])
        self.commit(batch_id, folders)


def log_table(spark: SparkSession, root: str) -> LogTable:
    return LogTable(spark, f"{root}/logs", LOG_SCHEMA)
