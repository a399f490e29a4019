"""Element-wise matrix algebra on flat, row-major array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hadamard(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") + y.cast("double"))


def add_narrow(a: Column, b: Column) -> Column:
    """Sum in double precision, kept as float."""
    return to_float(add(a, b))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))


def to_float(a: Column) -> Column:
    return a.cast("array<float>")


def _sized(a: Column, size: int) -> Column:
    wrong = F.concat(F.lit(f"array must have {size} elements, it has "), F.size(a).cast("string"))
    return F.when(F.size(a) == size, a).otherwise(F.raise_error(wrong))


def reshape_2d(a: Column, rows: int, cols: int) -> Column:
    """Array of ``rows`` arrays; an array of any other length is an error."""
    whole = _sized(a, rows * cols)
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: F.slice(whole, r * cols + 1, cols))


def reshape_3d(a: Column, depth: int, rows: int, cols: int) -> Column:
    plane = rows * cols
    whole = _sized(a, depth * plane)
    return F.transform(
        F.sequence(F.lit(0), F.lit(depth - 1)),
        lambda d: F.transform(
            F.sequence(F.lit(0), F.lit(rows - 1)),
            lambda r: F.slice(whole, d * plane + r * cols + 1, cols),
        ),
    )


def flatten_2d(a: Column) -> Column:
    return F.flatten(a)


def flatten_3d(a: Column) -> Column:
    return F.flatten(F.flatten(a))


def arange(start: float, end: float, step: float = 10.0) -> Column:
    """start, start + step, … up to and including end."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(int((end - start) / step))), lambda i: i * F.lit(step) + F.lit(start)
    )


def largest_index(a: Column) -> Column:
    """First 0-based index of the largest element, -1 for an empty or missing array."""
    return F.coalesce(F.array_position(a, F.array_max(a)) - 1, F.lit(-1).cast("bigint")).cast("int")
