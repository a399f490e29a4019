"""Which acquisitions are complete, who is their noise, and where each chunk's frames start.

Everything here reads packet metadata only. Payload columns never enter these plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.config import ACQUISITION, RAW_SCAN_NAME
from scanforge.operators.integrity import copy_rank
from scanforge.operators.scan import running_sum
from scanforge.operators.select import kind, operation_files, raw_scans


def chunk_facts(packets: DataFrame, raw_name: str = RAW_SCAN_NAME) -> DataFrame:
    """One row per raw chunk, with its number of copies, and rank and length of the copy that counts."""
    return (
        raw_scans(packets, raw_name)
        .groupBy(*ACQUISITION, "chunk_i")
        .agg(
            F.count("*").alias("n_copies"),
            F.max("n_total_chunks").alias("n_total_chunks"),
            F.max(copy_rank()).alias("best"),
            F.min("arrival_order").alias("first_arrival"),
        )
        .withColumn("n_bytes", F.when(F.col("best.n_bytes") >= 0, F.col("best.n_bytes")))
    )


def acquisition_facts(chunks: DataFrame, frame_bytes: int) -> DataFrame:
    """One row per acquisition: counts, completeness gate, exact frame total, and chunk layout.

    ``body_frames`` is the frame count that all chunks before the last share, or null where they
    differ; with it a chunk's first frame follows from its index alone. ``clean`` says that no chunk
    came more than once. A chunk that isn't a whole number of frames counts in ``n_broken``, and its acquisition is
    not complete.
    """
    body = F.when(F.col("chunk_i") < F.col("n_total_chunks"), F.col("n_bytes"))
    facts = chunks.groupBy(*ACQUISITION).agg(
        F.sum("n_copies").alias("n_received"),
        F.count("*").alias("n_chunks"),
        F.max("n_total_chunks").alias("n_total_chunks"),
        F.sum("n_bytes").alias("n_bytes"),
        F.min("first_arrival").alias("first_arrival"),
        F.min("chunk_i").alias("_first"),
        F.max("chunk_i").alias("_last"),
        F.min(body).alias("_short"),
        F.max(body).alias("_long"),
        F.count_if(F.coalesce("n_bytes", F.lit(-1)) % frame_bytes != 0).alias("n_broken"),
    )
    return facts_of_sums(facts, frame_bytes)


def facts_of_sums(sums: DataFrame, frame_bytes: int) -> DataFrame:
    """``acquisition_facts`` from counts, lengths and extreme chunks of each acquisition."""
    regular = (
        (F.col("_first") == 1)
        & (F.col("_last") == F.col("n_total_chunks"))
        & (F.coalesce("_short", F.lit(0)) == F.coalesce("_long", F.lit(0)))
        & (F.coalesce("_short", F.lit(0)) % frame_bytes == 0)
    )
    body_frames = F.coalesce("_short", F.lit(0)) / frame_bytes
    return sums.select(
        *ACQUISITION,
        kind().alias("kind"),
        "n_received",
        "n_chunks",
        "n_total_chunks",
        ((F.col("n_chunks") == F.col("n_total_chunks")) & (F.col("n_broken") == 0)).alias("complete"),
        "n_broken",
        F.floor(F.col("n_bytes") / frame_bytes).alias("n_frames"),
        F.when(regular, F.floor(body_frames)).alias("body_frames"),
        (F.col("n_received") == F.col("n_chunks")).alias("clean"),
        "first_arrival",
    )


def malformed(facts: DataFrame) -> DataFrame:
    """Acquisitions with chunks of broken length; they are left out of the correction until good copies arrive."""
    return facts.filter("n_broken > 0").select(*ACQUISITION, "n_broken", "n_chunks", "n_total_chunks")


def with_operation_file(facts: DataFrame, packets: DataFrame, raw_name: str = RAW_SCAN_NAME) -> DataFrame:
    """Only acquisitions whose directory holds an operation file."""
    directories = operation_files(packets, raw_name).select("subdir_str").distinct()
    return facts.join(directories, "subdir_str", "left_semi")


def active_noise(
    facts: DataFrame, stored_means: DataFrame | None = None, noise_subdir: str | None = None
) -> DataFrame:
    """The noise of each experiment and whether a mean is stored for it.

    The first noise to arrive wins; a noise with a stored mean overrides it, the latest to arrive if
    there are several; an explicit name overrides both.
    """
    noises = facts.filter(F.col("kind") == "noise")
    if noise_subdir is not None:
        noises = noises.filter(F.col("subdir_str") == noise_subdir)
    if stored_means is None:
        noises = noises.withColumn("stored", F.lit(False))
    else:
        names = stored_means.select(
            "experiment", F.col("noise_subdir").alias("subdir_str"), F.lit(True).alias("stored")
        ).distinct()
        noises = noises.join(names, ACQUISITION, "left").withColumn(
            "stored", F.coalesce("stored", F.lit(False))
        )
    order = F.when(F.col("stored"), -F.col("first_arrival")).otherwise(F.col("first_arrival"))
    pick = F.struct((~F.col("stored")).alias("fresh"), order.alias("o"), "subdir_str", "complete")
    return (
        noises.groupBy("experiment")
        .agg(F.min(pick).alias("p"))
        .select(
            "experiment",
            F.col("p.subdir_str").alias("noise_subdir"),
            (~F.col("p.fresh")).alias("stored"),
            (F.col("p.complete") | ~F.col("p.fresh")).alias("usable"),
        )
    )


def unprocessed(facts: DataFrame, processed: DataFrame | None) -> DataFrame:
    if processed is None:
        return facts
    return facts.join(processed.select(*ACQUISITION).distinct(), ACQUISITION, "left_anti")


def ready_signals(
    facts: DataFrame,
    noise: DataFrame,
    processed: DataFrame | None = None,
    treat_extra_noise_as_signal: bool = False,
) -> DataFrame:
    """Complete, not yet processed signals of experiments whose noise is complete or stored."""
    wanted = F.col("complete")
    if treat_extra_noise_as_signal:
        wanted = wanted & (F.col("subdir_str") != F.col("noise_subdir"))
    else:
        wanted = wanted & (F.col("kind") == "signal")
    usable = noise.filter("usable").select("experiment", "noise_subdir")
    return unprocessed(facts.filter("complete"), processed).join(usable, "experiment").filter(wanted)


def frame_offsets(chunks: DataFrame, frame_bytes: int, block: int = 1024) -> DataFrame:
    """First frame number of every chunk, for chunks of any length: a running sum in blocks of ``block`` chunks."""
    keyed = chunks.select(*ACQUISITION, "chunk_i", "n_copies", "best", F.floor(F.col("n_bytes") / frame_bytes).alias("n_frames"))
    return running_sum(keyed, ACQUISITION, "chunk_i", "n_frames", "frame_start", block)
