"""A lookup join that never trusts the size of its small side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 256 * 1024 * 1024
SALTS = 64


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    salt: Column | None,
    how: str = "inner",
    max_rows: int | None = None,
    small_rows: int | None = None,
) -> DataFrame:
    """Join ``big`` with ``small`` (at most one or few rows per key).

    ``small`` is counted first, unless ``small_rows`` gives its count. Within the bound it is broadcast and ``big`` keeps its
    partitioning. Beyond it both sides are shuffled on the key plus a salt taken from ``salt``, an
    expression over ``big`` that varies inside a key, so one hot key is spread over many tasks; None says
    that no key can be hot.
    ``how`` may be inner, left, left_semi or left_anti.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    if small_rows is None:
        small_rows = small.count()
    if small_rows <= max_rows:
        return big.join(F.broadcast(small), on, how)
    if salt is None:
        return big.join(small, on, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def rows_within(bytes_per_row: int, budget: int | None = None) -> int:
    """How many rows of a known width fit into the broadcast budget."""
    return max(1, (BROADCAST_BYTES if budget is None else budget) // max(1, bytes_per_row))
