"""Parameters shared by all operators, with the detector's defaults."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

# Names and marks that decide which packets count as what.
RAW_SCAN_NAME = "scan_x256_y256.raw"
NOISE_MARK = "bkg"
OPERATION_SUFFIX_LENGTH = 4
ANCILLARY_MARKS = ("even", "odd", ".tif", ".log", "stream_operations")

# Positions in the packet envelope.
ENVELOPE_FIELDS = {
    "filename": 0,
    "chunk_hash": 2,
    "chunk_i": 4,
    "n_total_chunks": 5,
    "subdir_str": 6,
    "filename_append": 7,
    "data": 8,
}

# The eight calibration matrices, as (column, parity).
CALIBRATION_MATRICES = {
    "g1A": ("g1", 0),
    "g1B": ("g1", 1),
    "g2A": ("g2", 0),
    "g2B": ("g2", 1),
    "offA": ("off", 0),
    "offB": ("off", 1),
    "flatfA": ("flat", 0),
    "flatfB": ("flat", 1),
}

# Bit layout of a detector word.
ANALOG_MASK = 0x3FFF
DIGITAL_SHIFT = 14
DIGITAL_MASK = 0xFFFF
GAIN_SHIFT = 31

ACQUISITION = ["experiment", "subdir_str"]


@dataclass(frozen=True)
class Geometry:
    """Sensor size; one pixel is one 4-byte word in a raw scan."""

    height: int = 128
    width: int = 128

    @property
    def pixels(self) -> int:
        return self.height * self.width

    @property
    def frame_bytes(self) -> int:
        return 4 * self.pixels


@dataclass(frozen=True)
class OffsetRule:
    """Histogram and parabola fit that give the offset of one frame."""

    low: float = -205.0
    step: float = 10.0
    n_bins: int = 42
    min_peak: int = 40
    max_offset: float = 200.0
    half_width: int = 3
    min_curvature: float = 0.0001

    @property
    def high(self) -> float:
        return self.low + self.step * self.n_bins

    @property
    def n_points(self) -> int:
        return 2 * self.half_width + 1

    @property
    def edges(self) -> list[float]:
        return [self.low + self.step * i for i in range(self.n_bins + 1)]

    def weight_sums(self, power: int) -> list[int]:
        """Sum of weight**power over the first n points, for n = 1..n_points."""
        weights = range(-self.half_width, self.half_width + 1)
        return list(accumulate(w**power for w in weights))
