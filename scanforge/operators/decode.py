"""Raw chunks to frames, and detector words to pixel values.

Array form (one row per frame) runs Arrow kernels where Spark placed each chunk. Long form (one row per
pixel) is plain column expressions and serves checks and small data. Both use the same formulas.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanforge.config import ANALOG_MASK, DIGITAL_MASK, DIGITAL_SHIFT, GAIN_SHIFT, Geometry
from scanforge.functions import kernels
from scanforge.functions import words as W
from scanforge.plans.joins import lookup_join

FRAME_COLUMNS = "experiment string, subdir_str string, chunk_i bigint, frame_no bigint, parity int"


def word_masks() -> dict:
    return {
        "analog": np.uint32(ANALOG_MASK),
        "shift": DIGITAL_SHIFT,
        "digital": np.uint32(DIGITAL_MASK),
        "gain": GAIN_SHIFT,
    }


def _chunk_columns(chunks: DataFrame, *more: str) -> DataFrame:
    return chunks.select("experiment", "subdir_str", "chunk_i", "frame_start", *more, "data")


def unpack_frames(chunks: DataFrame, geometry: Geometry) -> DataFrame:
    """Chunks (with ``frame_start``) to frames of raw words."""
    return _chunk_columns(chunks).mapInArrow(
        kernels.unpack_frames(geometry.pixels), FRAME_COLUMNS + ", pixels array<bigint>"
    )


def decode_frames(chunks: DataFrame, calibration: dict, geometry: Geometry) -> DataFrame:
    """Chunks (with ``frame_start``) to decoded frames. ``calibration`` comes from ``as_arrays``."""
    return _chunk_columns(chunks).mapInArrow(
        kernels.decode_frames(geometry.pixels, calibration, word_masks()),
        FRAME_COLUMNS + ", pixels array<double>",
    )


def explode_pixels(frames: DataFrame, value: str = "value") -> DataFrame:
    """Frames to one row per pixel, ``pos`` counted row by row over the sensor."""
    rest = [c for c in frames.columns if c != "pixels"]
    return frames.select(*rest, F.posexplode("pixels").alias("pos", value))


def unpack_pixels(frames: DataFrame, geometry: Geometry) -> DataFrame:
    """Frames stored as float32 bytes to frames with an array of floats."""
    fields = [
        T.StructField("pixels", T.ArrayType(T.FloatType())) if f.name == "pixels" else f
        for f in frames.schema.fields
    ]
    return frames.mapInArrow(kernels.unpack_pixels(geometry.pixels), T.StructType(fields))


def word_fields(words: DataFrame, word: str = "w") -> DataFrame:
    w = F.col(word)
    return words.select(
        *[c for c in words.columns if c != word],
        W.analog(w).alias("ana"),
        W.digital(w).alias("dig"),
        W.gain(w).alias("gn"),
    )


def decode_words(words: DataFrame, calibration: DataFrame, word: str = "w") -> DataFrame:
    """Long form: one row per word to one row per pixel value.

    ``calibration`` holds one row per (parity, pos), two per sensor pixel.
    """
    value = W.decoded(F.col(word), F.col("g1"), F.col("g2"), F.col("off")).alias("value")
    rest = [c for c in words.columns if c != word]
    masks = calibration.select("parity", "pos", "g1", "g2", "off")
    return lookup_join(words, masks, ["parity", "pos"], salt=F.col("frame_no")).select(*rest, value)
