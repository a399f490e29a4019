"""Calibration tables: eight named matrices, one entry per sensor pixel each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.config import CALIBRATION_MATRICES, Geometry

FIELDS = ("g1", "g2", "off", "flat")


def from_named_matrices(entries: DataFrame, geometry: Geometry) -> DataFrame:
    """(name, y, x, value DOUBLE) to one row per parity with four float arrays."""
    known = F.array(*[F.lit(n) for n in CALIBRATION_MATRICES])
    field, parity = (
        F.coalesce(*[F.when(F.col("name") == n, F.lit(target[k])) for n, target in CALIBRATION_MATRICES.items()])
        for k in (0, 1)
    )
    placed = entries.filter(F.array_contains(known, F.col("name"))).select(
        field.alias("field"),
        parity.cast("int").alias("parity"),
        (F.col("y") * geometry.width + F.col("x")).cast("int").alias("pos"),
        F.col("value").cast("float").alias("value"),
    )

    def matrix(name: str):
        # Bounded by the sensor: one entry per pixel.
        entry = F.when(F.col("field") == name, F.struct("pos", "value"))
        return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e.value).alias(name)

    return placed.groupBy("parity").agg(*[matrix(f) for f in FIELDS])


def to_long(calibration: DataFrame) -> DataFrame:
    """One row per (parity, pos)."""
    zipped = F.posexplode(F.arrays_zip(*FIELDS)).alias("pos", "m")
    return calibration.select("parity", zipped).select("parity", "pos", *[f"m.{f}" for f in FIELDS])


def as_arrays(calibration: DataFrame, geometry: Geometry) -> dict:
    """The calibration as numpy arrays by parity, for the kernels.

    Its size is that of the sensor and is checked here: two rows, each matrix one value per pixel.
    """
    rows = calibration.limit(3).collect()
    if sorted(r["parity"] for r in rows) != [0, 1]:
        raise ValueError("a calibration has exactly one row for parity 0 and one for parity 1")
    arrays = {r["parity"]: {f: np.asarray(r[f], dtype="f4") for f in FIELDS} for r in rows}
    for parity, fields in arrays.items():
        for field, values in fields.items():
            if values.shape != (geometry.pixels,):
                raise ValueError(f"{field} of parity {parity} has {values.size} values, not {geometry.pixels}")
    return arrays
