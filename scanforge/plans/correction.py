"""The whole correction as one plan over a landed packets table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.config import ACQUISITION, RAW_SCAN_NAME, Geometry, OffsetRule
from scanforge.functions import kernels
from scanforge.operators import assemble
from scanforge.operators.background import means_by_noise, noise_means
from scanforge.operators.decode import word_masks
from scanforge.operators.integrity import RANK_FIELDS, copy_rank
from scanforge.operators.select import raw_scans
from scanforge.plans.joins import lookup_join, rows_within
from scanforge.plans.tables import save, shared_dir
from scanforge.schema import CORRECTED_SCHEMA, STATS_SCHEMA, STORED_SCHEMA


@dataclass
class Ready:
    """Small tables (one row per acquisition) that say what can be computed now."""

    facts: DataFrame
    noises: DataFrame
    signals: DataFrame


def find_ready(
    packets: DataFrame,
    geometry: Geometry,
    folder: str,
    stored_means: DataFrame | None = None,
    processed: DataFrame | None = None,
    noise_subdir: str | None = None,
    treat_extra_noise_as_signal: bool = False,
    raw_name: str = RAW_SCAN_NAME,
) -> Ready:
    """Gate: active noises whose mean is still to be computed, and signals that can be corrected.

    Reads packet metadata only. Facts and result are written to ``folder``, because several later steps
    use them and need their true sizes.
    """
    chunks = assemble.chunk_facts(packets, raw_name)
    facts = assemble.with_operation_file(
        assemble.acquisition_facts(chunks, geometry.frame_bytes), packets, raw_name
    )
    facts = save(facts, f"{folder}/facts")
    return choose_ready(facts, folder, stored_means, processed, noise_subdir, treat_extra_noise_as_signal)


def choose_ready(
    facts: DataFrame,
    folder: str,
    stored_means: DataFrame | None = None,
    processed: DataFrame | None = None,
    noise_subdir: str | None = None,
    treat_extra_noise_as_signal: bool = False,
) -> Ready:
    """``find_ready`` from stored facts of the acquisitions."""
    noise = assemble.active_noise(facts, stored_means, noise_subdir)
    signals = assemble.ready_signals(facts, noise, processed, treat_extra_noise_as_signal)
    fresh = noise.filter(F.col("usable") & ~F.col("stored")).select(
        "experiment", F.col("noise_subdir").alias("subdir_str")
    )
    noises = facts.join(fresh, ACQUISITION, "left_semi")
    roles = signals.withColumn("role", F.lit("signal")).unionByName(
        noises.withColumn("noise_subdir", F.col("subdir_str")).withColumn("role", F.lit("noise"))
    )
    roles = save(roles, f"{folder}/ready")
    save(assemble.malformed(facts), f"{folder}/malformed")
    return Ready(facts, roles.filter("role = 'noise'"), roles.filter("role = 'signal'"))


def _chunk_places(
    packets: DataFrame, acquisitions: DataFrame, n: int, frame_bytes: int, raw_name: str
) -> DataFrame:
    """First frame, number of copies and the copy that counts of each chunk, from metadata; stored for its several uses."""
    metadata = raw_scans(packets, raw_name).select(
        *ACQUISITION, "filename", "chunk_i", "n_total_chunks", *RANK_FIELDS
    )
    names = acquisitions.select(*ACQUISITION, F.col("body_frames").isNull().alias("irregular"))
    salt = F.struct("chunk_i", "arrival_order")
    kept = lookup_join(metadata, names.select(*ACQUISITION), ACQUISITION, salt, "left_semi", small_rows=n)
    places = assemble.frame_offsets(assemble.chunk_facts(kept, raw_name), frame_bytes)
    places = lookup_join(places, names, ACQUISITION, salt=F.col("chunk_i"), small_rows=n)
    # Copies that are equal in every field of the rank have equal payloads; how many there are decides if any must be dropped.
    key = [*ACQUISITION, "chunk_i"]
    ranked = kept.select(*key, copy_rank().alias("rank")).join(places.where("n_copies > 1").select(*key, "best"), key)
    equal = ranked.where("rank = best").groupBy(*key).agg(F.count("*").alias("n_best"))
    return save(places.join(equal, key, "left"), f"{shared_dir(packets.sparkSession)}/chunk_places")


def select_chunks(
    packets: DataFrame, acquisitions: DataFrame, frame_bytes: int, raw_name: str = RAW_SCAN_NAME
) -> DataFrame:
    """Payload of the given acquisitions, one row per chunk, with ``frame_start`` and ``n_frames``.

    Where all chunks but the last have equal lengths, the normal case, a chunk's first frame follows from
    its index and the payload is not shuffled. Other acquisitions look the first frame up. Of chunks that came more than once
    the copy is chosen by metadata, and the payload only filtered; where several copies are equal in every field, they
    are merged map-side.
    """
    columns = [c for c in ("n_frames", "noise_subdir") if c in acquisitions.columns]
    raw = raw_scans(packets, raw_name).select(*ACQUISITION, "chunk_i", *RANK_FIELDS, "data")
    out = [*ACQUISITION, "chunk_i", "frame_start", *columns, "data"]
    regular, clean = F.col("body_frames").isNotNull(), F.col("clean")
    sizes = acquisitions.agg(
        F.count_if(regular).alias("regular"), F.count_if(~(regular & clean)).alias("others")
    ).first()

    by_index = lookup_join(
        raw,
        acquisitions.filter(regular).select(*ACQUISITION, *columns, "body_frames"),
        ACQUISITION,
        salt=F.col("chunk_i"),
        small_rows=sizes["regular"],
    ).withColumn("frame_start", (F.col("chunk_i") - 1) * F.col("body_frames"))
    if not sizes["others"]:
        return by_index.select(*out)

    others = acquisitions.filter(~(regular & clean))
    places = _chunk_places(packets, others, sizes["others"], frame_bytes, raw_name)
    once = F.col("irregular") & (F.col("n_copies") == 1)
    counts = places.agg(
        F.count_if(once).alias("once"), F.count_if(F.col("n_copies") > 1).alias("repeated"), F.count_if(F.col("n_best") > 1).alias("equal")
    ).first()
    key, fits = [*ACQUISITION, "chunk_i"], rows_within(128)
    repeated = places.filter("n_copies > 1").select(*key, "frame_start", "best", "n_best")
    branches = []
    if sizes["regular"]:
        if counts["repeated"]:
            salt, n = F.col("arrival_order"), counts["repeated"]
            by_index = lookup_join(by_index, repeated.select(*key), key, salt, "left_anti", fits, n)
        branches.append(by_index.select(*out))
    parts = []
    if counts["once"]:
        # One packet per key, so no key is hot.
        starts = places.filter(once).select(*key, "frame_start")
        placed = lookup_join(raw, starts, key, None, max_rows=fits, small_rows=counts["once"])
        parts.append(placed.select(*key, "frame_start", "data"))
    if counts["repeated"]:
        salt, n = F.col("arrival_order"), counts["repeated"]
        copies = lookup_join(raw, repeated, key, salt, max_rows=fits, small_rows=n).filter(copy_rank() == F.col("best"))
        parts.append(copies.filter("n_best = 1").select(*key, "frame_start", "data"))
        if counts["equal"]:
            parts.append(copies.filter("n_best > 1").groupBy(*key, "frame_start").agg(F.first("data").alias("data")))
    facts = others.select(*ACQUISITION, *columns)
    for part in parts:
        part = lookup_join(part, facts, ACQUISITION, salt=F.col("chunk_i"), small_rows=sizes["others"])
        branches.append(part.select(*out))
    return reduce(DataFrame.unionByName, branches)


def compute_means(
    packets: DataFrame, ready: Ready, calibration: dict, geometry: Geometry, raw_name: str = RAW_SCAN_NAME
) -> DataFrame:
    chunks = select_chunks(packets, ready.noises, geometry.frame_bytes, raw_name)
    return noise_means(chunks, calibration, geometry)


def correct_signals(
    packets: DataFrame,
    signals: DataFrame,
    means: DataFrame,
    calibration: dict,
    geometry: Geometry,
    rule: OffsetRule = OffsetRule(),
    raw_name: str = RAW_SCAN_NAME,
    packed: bool = False,
    with_pixels: bool = True,
) -> DataFrame:
    """Corrected frames with their statistics, one Arrow pass over the payload.

    With ``packed`` the pixels of a frame are float32 little-endian bytes instead of an array; without ``with_pixels`` there are
    the statistics alone, and no pixel leaves the kernel. ``means`` should be a stored table. The mean frames of the noises at hand are sent
    once to each executor and looked up by name while they fit the budget; otherwise they are joined to each chunk by a shuffle on
    experiment plus salt.
    """
    spark = packets.sparkSession
    names = ["experiment", "noise_subdir"]
    chunks = select_chunks(packets, signals, geometry.frame_bytes, raw_name)
    known = means.join(signals.select(*names).distinct(), names, "left_semi")
    noises = known.select(*names).distinct()
    n_noises = noises.count()
    columns = [*ACQUISITION, "chunk_i", "frame_start", "n_frames"]
    schema = STORED_SCHEMA if packed else CORRECTED_SCHEMA
    schema = schema if with_pixels else STATS_SCHEMA
    if n_noises <= rows_within(2 * 8 * geometry.pixels):
        sent = spark.sparkContext.broadcast(kernels.mean_frames(means_by_noise(known).toArrow()))
        # Chunks of noises without a mean stay out.
        joined = lookup_join(chunks, noises, names, salt=F.col("chunk_i"), small_rows=n_noises).select(*columns, "noise_subdir", "data")
    else:
        sent = None
        wide = means_by_noise(known)
        joined = lookup_join(chunks, wide, names, salt=F.col("chunk_i"), max_rows=0, small_rows=n_noises).select(*columns, "mean_0", "mean_1", "data")
    return joined.mapInArrow(kernels.correct_frames(geometry.pixels, calibration, word_masks(), rule, packed, sent, with_pixels), schema)


def frame_stats(corrected: DataFrame) -> DataFrame:
    return corrected.select(*ACQUISITION, "frame_no", "hist_max", "hist_arg", "offset")
