"""Batch run: from a landed packets table to stored means, corrected frames and processed list."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.config import RAW_SCAN_NAME, Geometry, OffsetRule
from scanforge.operators.decode import unpack_pixels
from scanforge.plans.correction import Ready, compute_means, correct_signals, find_ready, frame_stats
from scanforge.plans.joins import rows_within
from scanforge.plans.ledger import Ledger
from scanforge.schema import PROCESSED_SCHEMA, STORED_SCHEMA
from scanforge.sinks.histogram_log import log_table
from scanforge.sinks.raw import raw_table
from scanforge.sinks.tables import noise_means_table, store_noise_means

# Waves are filled by a hash, so they are planned a little below the bound they must keep.
FILL = 0.8


@dataclass(frozen=True)
class Outputs:
    """Files that a run writes beside its tables: histogram logs, and float32 files in a byte order (``<`` or ``>``)."""

    log: bool = False
    raw: str | None = None


def corrected_table(spark: SparkSession, root: str, partition_by: list[str] | None = None) -> Ledger:
    return Ledger(spark, f"{root}/corrected", STORED_SCHEMA, tuple(partition_by or ()))


def processed_table(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/processed", PROCESSED_SCHEMA)


def wave_count(n_noises: int, geometry: Geometry) -> int:
    """Number of passes such that the means of one pass fit the broadcast budget."""
    return max(1, math.ceil(n_noises / (FILL * rows_within(2 * 8 * geometry.pixels))))


def store_corrections(
    packets: DataFrame,
    ready: Ready,
    calibration: dict,
    geometry: Geometry,
    root: str,
    batch_id: int,
    partition_by: list[str] | None = None,
    rule: OffsetRule = OffsetRule(),
    raw_name: str = RAW_SCAN_NAME,
    outputs: Outputs = Outputs(),
) -> None:
    """Store the missing noise means, correct and store the ready signals, write the output files, then list the signals as processed.

    Signals are taken in waves by their noise, so that the means of a wave can be broadcast and the
    payload is never shuffled. A wave reads only its own acquisitions where the packets table is
    partitioned by them. Each table and each kind of file has a list of what counts; a batch that is run again
    replaces its own entries, so that each frame counts once. Files are written from the stored frames.
    """
    spark = packets.sparkSession
    if not ready.noises.isEmpty():
        means = compute_means(packets, ready, calibration, geometry, raw_name)
        store_noise_means(means, f"{root}/noise_means", batch_id)
    n_noises = ready.signals.select("experiment", "noise_subdir").distinct().count()
    corrected = corrected_table(spark, root, partition_by)
    folders = []
    if n_noises:
        means = noise_means_table(spark, f"{root}/noise_means").load()
        waves = wave_count(n_noises, geometry)
        wave = F.pmod(F.xxhash64("experiment", "noise_subdir"), F.lit(waves))
        for w in range(waves):
            signals = ready.signals.filter(wave == w) if waves > 1 else ready.signals
            frames = correct_signals(packets, signals, means, calibration, geometry, rule, raw_name, packed=True)
            folders.append(corrected.folder(batch_id))
            corrected.write(frames, folders[-1])
    written = [spark.read.schema(STORED_SCHEMA).parquet(corrected.path_of(f)) for f in folders]
    if outputs.log:
        log_table(spark, root).write_batch([frame_stats(w) for w in written], batch_id)
    if outputs.raw:
        raw_table(spark, root).write_batch(written, batch_id, outputs.raw)
    corrected.commit(batch_id, folders)
    done = ready.signals.select("experiment", "subdir_str", "noise_subdir")
    processed_table(spark, root).append(done, batch_id)


def load_processed(spark: SparkSession, root: str) -> DataFrame:
    return processed_table(spark, root).load()


def correct_packets(
    packets: DataFrame,
    calibration: dict,
    geometry: Geometry,
    root: str,
    processed: DataFrame | None = None,
    noise_subdir: str | None = None,
    treat_extra_noise_as_signal: bool = False,
    partition_by: list[str] | None = None,
    rule: OffsetRule = OffsetRule(),
    raw_name: str = RAW_SCAN_NAME,
    outputs: Outputs = Outputs(),
) -> Ready:
    """Everything a table of landed packets allows and earlier runs on ``root`` have not done.

    Tables go to ``{root}/noise_means``, ``{root}/corrected`` and ``{root}/processed``, files that ``outputs`` asks for to
    ``{root}/logs`` and ``{root}/raw``. ``processed`` names further acquisitions to leave out.
    """
    spark = packets.sparkSession
    listed = processed_table(spark, root)
    batch_id = max(listed.versions(), default=-1) + 1
    done = listed.load().select("experiment", "subdir_str")
    if processed is not None:
        done = done.unionByName(processed.select("experiment", "subdir_str"))
    ready = find_ready(
        packets,
        geometry,
        f"{root}/gate/batch_id={batch_id}",
        stored_means=noise_means_table(spark, f"{root}/noise_means").load(),
        processed=done,
        noise_subdir=noise_subdir,
        treat_extra_noise_as_signal=treat_extra_noise_as_signal,
        raw_name=raw_name,
    )
    store_corrections(packets, ready, calibration, geometry, root, batch_id, partition_by, rule, raw_name, outputs)
    return ready


def read_corrected(spark: SparkSession, path: str, geometry: Geometry) -> DataFrame:
    """Stored frames with their pixels as arrays. For statistics alone load the table itself, whose pixels parquet then skips."""
    return unpack_pixels(Ledger(spark, path, STORED_SCHEMA).load(), geometry)
