"""Tables: landed packets, noise means and corrected frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scanforge.operators.integrity import check_integrity
from scanforge.plans.ledger import Ledger
from scanforge.plans.tables import save
from scanforge.schema import NOISE_MEANS_SCHEMA


def land_packets(
    packets: DataFrame, path: str, partition_by: list[str] | None = None, policy: str = "keep"
) -> DataFrame:
    """Check packets once and store them with ``n_bytes`` and ``hash_ok``.

    Later steps read those two columns instead of the payload, which parquet then skips. With
    ``partition_by`` a later read of one acquisition skips the others.
    """
    return save(check_integrity(packets, policy), path, partition_by)


def noise_means_table(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, path, NOISE_MEANS_SCHEMA)


def store_noise_means(means: DataFrame, path: str, batch_id: int = 0) -> DataFrame:
    """Store the means that one run computed and return all stored ones.

    A run that is repeated replaces its own means and leaves those of other runs.
    """
    table = noise_means_table(means.sparkSession, path)
    table.append(means, batch_id)
    return table.load()
