import numpy as np
import pytest

import golden
from scanforge.config import Geometry, OffsetRule
from scanforge.functions import kernels
from scanforge.operators import debounce
from scanforge.operators.decode import word_masks

RULE = OffsetRule()


def border_frames():
    """Centres from below to above the histogram, plus frames without any value inside."""
    rng = np.random.default_rng(3)
    frames = [rng.normal(c, rng.uniform(12, 20), 400) for c in np.linspace(-230, 230, 60)]
    frames += [np.full(400, 1000.0), np.full(400, np.nan), np.zeros(400), np.full(400, 214.999), np.full(400, -205.0)]
    return np.array(frames)


def test_rule_matches_the_fixed_layout():
    assert RULE.edges[0] == -205 and RULE.edges[-1] == RULE.high == 215 and len(RULE.edges) == 43
    assert RULE.weight_sums(2)[3:] == [14, 15, 19, 28]
    assert RULE.weight_sums(4)[3:] == [98, 99, 115, 196]


@pytest.mark.parametrize("first_frame", [0, 1])
def test_decode_equals_the_word_formula(first_frame):
    calibration = golden.make_calibration(16)
    words = golden.make_words(5, 16, seed=5)
    shifted = {p: calibration[(p + first_frame) % 2] for p in (0, 1)}
    got = kernels.decode(words, first_frame, kernels.in_double(calibration), word_masks())
    assert np.array_equal(got, golden.decode(words, shifted))


def test_decode_ignores_the_unused_bit():
    calibration = kernels.in_double(golden.make_calibration(4))
    words = golden.make_words(2, 4, seed=6) & np.uint32(~(1 << 30) & 0xFFFFFFFF)
    with_bit = words | np.uint32(1 << 30)
    masks = word_masks()
    assert np.array_equal(kernels.decode(words, 0, calibration, masks), kernels.decode(with_bit, 0, calibration, masks))


def test_offsets_equal_the_loops_also_at_the_borders():
    frames = border_frames()
    peak, arg, offset = kernels.estimate_offsets(frames, RULE)
    for f, values in enumerate(frames):
        assert (peak[f], arg[f]) == golden.offset(values)[:2]
        assert offset[f] == pytest.approx(golden.offset(values)[2], abs=1e-9)
    assert {0, 41} <= set(arg.tolist()) and (offset == 0).any() and (offset != 0).any()


def test_long_form_offsets_equal_the_kernel(spark):
    frames = border_frames()
    rows = [(f, float(v)) for f, values in enumerate(frames) for v in values]
    pixels = spark.createDataFrame(rows, "frame int, value double")
    got = {r["frame"]: r for r in debounce.frame_offsets(pixels, ["frame"]).collect()}
    modes = {r["frame"]: r for r in debounce.histogram_mode(pixels, ["frame"]).collect()}
    peak, arg, offset = kernels.estimate_offsets(frames, RULE)
    assert len(got) == len(frames)
    for f in range(len(frames)):
        assert (got[f]["hist_max"], got[f]["hist_arg"]) == (peak[f], arg[f] + 1)
        assert (modes[f]["hist_max"], modes[f]["hist_arg"]) == (peak[f], arg[f] + 1)
        assert got[f]["offset"] == offset[f]


def test_wrong_chunk_length_is_refused():
    with pytest.raises(ValueError, match="whole number"):
        kernels.values_of(b"\0" * 100, Geometry(8, 8).pixels)


def test_output_batches_are_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(kernels, "OUTPUT_VALUES", 64)
    monkeypatch.setattr(kernels, "STEP_VALUES", 48)
    words = golden.make_words(40, 16, seed=9)
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(["e"]),
            pa.array(["s"]),
            pa.array([1], pa.int64()),
            pa.array([0], pa.int64()),
            pa.array([words.tobytes()], pa.binary()),
        ],
        ["experiment", "subdir_str", "chunk_i", "frame_start", "data"],
    )
    out = list(kernels.unpack_frames(16)([batch]))
    assert len(out) > 1 and max(len(b) for b in out) * 16 < 64 + 48
    frames = np.concatenate([b.column("pixels").flatten().to_numpy() for b in out]).reshape(-1, 16)
    assert np.array_equal(frames, words)
    assert np.concatenate([b.column("frame_no").to_numpy() for b in out]).tolist() == list(range(40))
