"""Running sums over keys of any length, in blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
LEVELS = 2


def running_sum(rows: DataFrame, by: list[str], position: str, value: str, out: str, block: int | None = None, levels: int = LEVELS) -> DataFrame:
    """``rows`` with ``out``: the sum of ``value`` over the rows of the same key with a smaller ``position``.

    ``position`` is a whole number, different within a key. Rows are summed in blocks of ``block`` positions, the blocks' totals in blocks
    of blocks, and so on; the sums before a block are then added to its rows. With positions below block ** (levels + 1) no
    task sorts more than ``block`` rows of a key. Rows without a position or a value count as 0 and get the sum before the key's first.
    """
    block = block or BLOCK
    summed = F.coalesce(F.col(value), F.lit(0))
    before = (Window.unboundedPreceding, -1)

    def sum_before(over: list[str | Column]) -> Column:
        window = Window.partitionBy(*over).orderBy(position).rowsBetween(*before)
        return F.coalesce(F.sum(summed).over(window), F.lit(0))

    if levels <= 0:
        return rows.withColumn(out, sum_before(list(by)))
    number, start = f"{out}_block", f"{out}_start"
    keyed = rows.withColumn(number, F.floor(F.col(position) / block))
    totals = keyed.groupBy(*by, number).agg(F.sum(summed).alias(value))
    starts = running_sum(totals, by, number, value, start, block, levels - 1).select(*by, number, start)
    same = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in (*by, number)]
    inside = keyed.withColumn(out, sum_before([*by, number]))
    joined = inside.alias("a").join(starts.alias("b"), same)
    return joined.select(*[F.col(f"a.`{c}`") for c in rows.columns], (F.col(f"a.`{out}`") + F.col(f"b.`{start}`")).alias(out))
