"""Payload checks at ingest and the choice between copies of a chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICIES = ("keep", "drop", "quarantine")


def hash_matches(bits: int = 512) -> Column:
    return F.sha2("data", bits) == F.lower(F.hex("chunk_hash"))


def check_integrity(packets: DataFrame, policy: str = "keep") -> DataFrame:
    """Add ``hash_ok``, ``n_bytes`` and ``data_hash``; keep all rows, only matching rows, or only the others."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    checked = packets.withColumns(
        {
            "hash_ok": F.coalesce(hash_matches(), F.lit(False)),
            "n_bytes": F.octet_length("data").cast("bigint"),
            "data_hash": F.xxhash64("data"),
        }
    )
    if "arrival_order" in packets.columns:
        checked = checked.withColumn("arrival_order", F.col("arrival_order").cast("decimal(38,0)"))
    if policy == "keep":
        return checked
    return checked.filter(F.col("hash_ok") if policy == "drop" else ~F.col("hash_ok"))


RANK_FIELDS = ("hash_ok", "arrival_order", "n_bytes", "data_hash")


def copy_rank() -> Column:
    """Order of the copies of one chunk: a matching hash first, then the latest arrival, then length and content.

    Columns that ``check_integrity`` adds, so the order is total up to equal payloads and needs no payload.
    """
    return F.struct(
        F.coalesce("hash_ok", F.lit(False)).alias("hash_ok"),
        F.coalesce(F.col("arrival_order").cast("decimal(38,0)"), F.lit(-1).cast("decimal(38,0)")).alias("arrival_order"),
        F.coalesce("n_bytes", F.lit(-1).cast("bigint")).alias("n_bytes"),
        "data_hash",
    )


def latest_chunks(packets: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per (acquisition, file, chunk). Copies are merged before the shuffle, hot ones too."""
    keys = ["experiment", "subdir_str", "filename", "chunk_i"]
    rest = [c for c in (columns or packets.columns) if c not in keys]
    best = F.max_by(F.struct(*rest), copy_rank()).alias("best")
    return packets.groupBy(*keys).agg(best).select(*keys, "best.*")
