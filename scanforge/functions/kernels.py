"""Array kernels over Arrow batches: one input row is one chunk, one output row is one frame.

They hold no more than one input batch plus a bounded output batch, and run wherever Spark placed the
chunk. Functions of this module are pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Values worked on at a time, and values that complete an output batch: 64 frames of 128 x 128 pixels,
# 8 MiB as float64. An output batch holds less than the sum of both.
STEP_VALUES = 1 << 20
OUTPUT_VALUES = 1 << 20
# Acquisitions whose partial sums a task holds at a time.
HELD_SUMS = 64


def values_of(data, pixels, layout="<u4"):
    """The 4-byte values of a chunk, one row per frame."""
    if len(data) % (4 * pixels):
        raise ValueError(f"chunk of {len(data)} bytes is not a whole number of frames of {pixels} pixels")
    return np.frombuffer(data, layout).reshape(-1, pixels)


def by_parity(first_frame, n):
    """(parity, rows) of n consecutive frames, as strided slices."""
    lead = int(first_frame) % 2
    return [(lead, slice(0, n, 2)), (1 - lead, slice(1, n, 2))]


def in_double(calibration):
    """Masks widened once per task, which is exact and keeps the inner loops free of casts."""
    return {parity: {f: m.astype("f8") for f, m in fields.items()} for parity, fields in calibration.items()}


def decode(words, first_frame, calibration, masks):
    out = (words & masks["analog"]).astype("f8")
    digital = ((words >> np.uint32(masks["shift"])) & masks["digital"]).astype("f8")
    high_gain = (words >> np.uint32(masks["gain"])).astype(bool)
    high = np.empty_like(out)
    for parity, rows in by_parity(first_frame, len(words)):
        m = calibration[parity]
        np.subtract(out[rows], m["off"], out=high[rows])
        high[rows] *= m["g1"]
        digital[rows] *= m["g2"]
    np.copyto(out, high, where=high_gain)
    out += digital
    return out


def bin_counts(values, rule):
    """Histogram of each frame; values outside and NaN are not counted."""
    n, n_bins = len(values), rule.n_bins
    outside = ~((values >= rule.low) & (values < rule.high))
    slot = values - rule.low
    slot /= rule.step
    # The last edge can be reached by rounding alone.
    np.minimum(slot, n_bins - 0.5, out=slot)
    np.copyto(slot, n_bins, where=outside)
    slot = slot.astype("i8")
    slot += np.arange(n)[:, None] * (n_bins + 1)
    return np.bincount(slot.ravel(), minlength=n * (n_bins + 1)).reshape(n, -1)[:, :n_bins]


def estimate_offsets(values, rule):
    """(peak count, 0-based peak bin, offset) per frame, from a histogram and a parabola through its peak."""
    n, n_bins, half = len(values), rule.n_bins, rule.half_width
    counts = bin_counts(values, rule)
    peak_bin = counts.argmax(axis=1)
    peak = counts[np.arange(n), peak_bin]
    start = np.maximum(peak_bin - half, 0)
    stop = np.minimum(peak_bin + half + 1, n_bins)
    width = stop - start
    # Near a border the window is cut, yet its weights still begin at -half.
    steps = np.arange(rule.n_points)
    at = np.minimum(start[:, None] + steps, n_bins - 1)
    y = np.where(steps < width[:, None], np.take_along_axis(counts, at, axis=1), 0).astype("f8")
    weight = (steps - half).astype("f8")
    s_y, s_wy, s_w2y = y.sum(axis=1), y @ weight, y @ weight**2
    s_w2 = np.asarray(rule.weight_sums(2), "f8")[width - 1]
    s_w4 = np.asarray(rule.weight_sums(4), "f8")[width - 1]
    slope = s_wy / s_w2
    curvature = (rule.n_points * s_w2y - s_w2 * s_y) / (rule.n_points * s_w4 - s_w2 * s_w2)
    curved = np.abs(curvature) > rule.min_curvature
    shift = np.where(curved, -slope / (2 * np.where(curved, curvature, 1.0)), 0.0)
    offset = rule.low + rule.step * peak_bin + rule.step / 2 + shift * rule.step
    offset = np.where((peak <= rule.min_peak) | (np.abs(offset) > rule.max_offset), 0.0, offset)
    return peak, peak_bin, offset


def list_array(rows, arrow_type):
    """2-D array to an Arrow list column without a Python loop."""
    flat = pa.array(np.ascontiguousarray(rows).ravel(), arrow_type)
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype="i4")
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def binary_array(rows):
    """2-D array to an Arrow binary column: the little-endian bytes of each row."""
    flat = np.ascontiguousarray(rows, rows.dtype.newbyteorder("<"))
    ends = np.arange(len(rows) + 1, dtype="i4") * (flat.itemsize * flat.shape[1])
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def list_rows(column):
    """Numpy view of an Arrow list column as a function of the row number."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return lambda i: values[ends[i] : ends[i + 1]]


class FrameBatches:
    """Collects the frames of consecutive chunks and releases them in batches of bounded size; without a pixel type their columns alone."""

    def __init__(self, keys, columns, pixel_type):
        self.keys, self.columns, self.pixel_type = keys, columns, pixel_type
        self.parts, self.held = [], 0

    def add(self, key_values, columns, pixels):
        self.parts.append((key_values, columns, pixels))
        self.held += len(columns[0]) if pixels is None else pixels.size
        if self.held >= OUTPUT_VALUES:
            yield self.flush()

    def flush(self):
        sizes = [len(p[1][0]) for p in self.parts]
        arrays = []
        for k, arrow_type in enumerate(self.keys.values()):
            values = [v for p, n in zip(self.parts, sizes) for v in [p[0][k]] * n]
            arrays.append(pa.array(values, arrow_type))
        for c, arrow_type in enumerate(self.columns.values()):
            arrays.append(pa.array(np.concatenate([p[1][c] for p in self.parts]), arrow_type))
        names = [*self.keys, *self.columns]
        if self.pixel_type is not None:
            rows = np.concatenate([p[2] for p in self.parts])
            packed = pa.types.is_binary(self.pixel_type)
            arrays.append(binary_array(rows) if packed else list_array(rows, self.pixel_type))
            names.append("pixels")
        self.parts, self.held = [], 0
        return pa.RecordBatch.from_arrays(arrays, names)


CHUNK_KEYS = {"experiment": pa.string(), "subdir_str": pa.string(), "chunk_i": pa.int64()}


def chunks_in(batch, pixels, layout="<u4"):
    """(key values, first frame, values, row number) of every chunk, a long chunk in several steps."""
    keys = list(zip(*[batch.column(k).to_pylist() for k in CHUNK_KEYS]))
    starts = batch.column("frame_start").to_pylist()
    data = batch.column("data")
    step = max(2, STEP_VALUES // pixels)
    for i, (key, start) in enumerate(zip(keys, starts)):
        values = values_of(data[i].as_buffer(), pixels, layout)
        for lo in range(0, len(values), step):
            yield key, start + lo, values[lo : lo + step], i


def unpack_frames(pixels):
    """Chunks to frames of raw words."""

    def run(batches):
        for batch in batches:
            out = FrameBatches(CHUNK_KEYS, {"frame_no": pa.int64(), "parity": pa.int32()}, pa.int64())
            for key, start, words, _ in chunks_in(batch, pixels):
                numbers = start + np.arange(len(words), dtype="i8")
                yield from out.add(key, [numbers, (numbers % 2).astype("i4")], words.astype("i8"))
            if out.held:
                yield out.flush()

    return run


def decode_frames(pixels, calibration, masks):
    """Chunks to decoded frames."""

    def run(batches):
        masks_of = in_double(calibration)
        for batch in batches:
            out = FrameBatches(CHUNK_KEYS, {"frame_no": pa.int64(), "parity": pa.int32()}, pa.float64())
            for key, start, words, _ in chunks_in(batch, pixels):
                values = decode(words, start, masks_of, masks)
                numbers = start + np.arange(len(values), dtype="i8")
                yield from out.add(key, [numbers, (numbers % 2).astype("i4")], values)
            if out.held:
                yield out.flush()

    return run


def noise_sums(pixels, calibration, masks, width):
    """Chunks of noise acquisitions to one sum per task, acquisition and parity, in blocks of ``width`` pixels with a column for each.

    A last frame without partner is left out. Both parities are always given, zero if they have no frame; so are pixels beyond the last.
    """
    n_blocks = -(-pixels // width)

    def rows(sums):
        keys = [(*key, parity, block) for key in sums for parity in (0, 1) for block in range(n_blocks)]
        types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*keys), types)]
        values = np.zeros((2 * len(sums), n_blocks * width))
        values[:, :pixels] = np.concatenate(list(sums.values()))
        by_pixel = np.ascontiguousarray(values.reshape(-1, width).T)
        arrays += [pa.array(column) for column in by_pixel]
        names = ["experiment", "noise_subdir", "n_frames", "parity", "block", *[f"s{i}" for i in range(width)]]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches):
        masks_of = in_double(calibration)
        sums = {}
        for batch in batches:
            totals = batch.column("n_frames").to_pylist()
            for (experiment, subdir, _), start, words, i in chunks_in(batch, pixels):
                values = decode(words, start, masks_of, masks)
                values = values[: max(0, totals[i] // 2 * 2 - start)]
                held = sums.setdefault((experiment, subdir, totals[i]), np.zeros((2, pixels)))
                for parity, part in by_parity(start, len(values)):
                    held[parity] += values[part].sum(axis=0)
                if len(sums) >= HELD_SUMS:
                    yield rows(sums)
                    sums = {}
        if sums:
            yield rows(sums)

    return run


def mean_frames(table):
    """Means of an Arrow table (experiment, noise_subdir, mean_0, mean_1) as pairs of arrays by name."""
    out = {}
    for batch in table.to_batches():
        names = zip(batch.column("experiment").to_pylist(), batch.column("noise_subdir").to_pylist())
        means = [list_rows(batch.column("mean_0")), list_rows(batch.column("mean_1"))]
        out |= {name: (means[0](i).copy(), means[1](i).copy()) for i, name in enumerate(names)}
    return out


def correct_frames(pixels, calibration, masks, rule, packed, means=None, with_pixels=True):
    """Chunks to corrected frames and frame statistics, in one pass; without ``with_pixels`` to the statistics alone.

    ``means`` is a broadcast variable of ``mean_frames``, looked up by (experiment, noise_subdir); without it each chunk brings both mean frames.
    """
    columns = {
        "frame_no": pa.int64(),
        "parity": pa.int32(),
        "hist_max": pa.int64(),
        "hist_arg": pa.int32(),
        "offset": pa.float64(),
    }

    def means_in(batch):
        if means is None:
            both = [list_rows(batch.column("mean_0")), list_rows(batch.column("mean_1"))]
            return lambda i: (both[0](i), both[1](i))
        known = means.value
        names = list(zip(batch.column("experiment").to_pylist(), batch.column("noise_subdir").to_pylist()))
        return lambda i: known[names[i]]

    def run(batches):
        masks_of = in_double(calibration)
        for batch in batches:
            out = FrameBatches(CHUNK_KEYS, columns, (pa.binary() if packed else pa.float32()) if with_pixels else None)
            totals = batch.column("n_frames").to_pylist()
            mean_of = means_in(batch)
            for key, start, words, i in chunks_in(batch, pixels):
                values = decode(words, start, masks_of, masks)
                halves = by_parity(start, len(values))
                own = mean_of(i)
                for parity, rows in halves:
                    values[rows] -= own[parity]
                peak, peak_bin, offset = estimate_offsets(values, rule)
                numbers = start + np.arange(len(values), dtype="i8")
                stats = [
                    numbers,
                    (numbers % 2).astype("i4"),
                    peak.astype("i8"),
                    (peak_bin + 1).astype("i4"),
                    offset,
                ]
                if not with_pixels:
                    yield from out.add(key, stats, None)
                    continue
                values -= offset[:, None]
                paired = max(0, totals[i] // 2 * 2 - start)
                for parity, rows in halves:
                    values[:paired][rows] *= masks_of[parity]["flat"]
                yield from out.add(key, stats, values.astype("f4"))
            if out.held:
                yield out.flush()

    return run


def write_runs(root, byte_order, max_frames):
    """Writes runs of consecutive frames as headerless float32 files and reports each file.

    A run ends where the next frame does not follow, so frames should come in order at least within
    their chunk. Every attempt of a task writes files of its own name; the report names those of the attempt that counts,
    and readers go by the report.
    """

    def run(batches):
        import uuid

        from pyarrow import fs

        attempt = uuid.uuid4().hex[:12]

        filesystem, base = fs.FileSystem.from_uri(root)
        stream = None
        report = []

        def close():
            nonlocal stream
            if stream is not None:
                stream["out"].close()
                report.append((*stream["key"], stream["path"], stream["first"], stream["frames"]))
                stream = None

        for batch in batches:
            numbers = batch.column("frame_no").to_numpy()
            names = list(zip(batch.column("experiment").to_pylist(), batch.column("subdir_str").to_pylist()))
            column = batch.column("pixels")
            if pa.types.is_binary(column.type):
                ends = np.frombuffer(column.buffers()[1], "i4", len(column) + 1, column.offset * 4) // 4
                values = np.frombuffer(column.buffers()[2], "<f4") if column.buffers()[2] else np.empty(0, "<f4")
            else:
                ends, values = column.offsets.to_numpy(), column.values.to_numpy()
            # Rows that follow one another are written together.
            breaks = [i for i in range(1, len(names)) if names[i] != names[i - 1] or numbers[i] != numbers[i - 1] + 1]
            for lo, hi in zip([0, *breaks], [*breaks, len(names)]):
                while lo < hi:
                    number, key = int(numbers[lo]), names[lo]
                    follows = (
                        stream is not None
                        and stream["key"] == key
                        and stream["first"] + stream["frames"] == number
                        and stream["frames"] < max_frames
                    )
                    if not follows:
                        close()
                        folder = f"{base}/{key[0]}/out_{key[1]}.raw"
                        filesystem.create_dir(folder)
                        path = f"{folder}/part-{number:012d}-{attempt}"
                        out = filesystem.open_output_stream(path)
                        stream = {"key": key, "path": path, "out": out, "first": number, "frames": 0}
                    upto = min(hi, lo + max_frames - stream["frames"])
                    stream["out"].write(values[ends[lo] : ends[upto]].astype(byte_order + "f4").tobytes())
                    stream["frames"] += upto - lo
                    lo = upto
        close()
        columns = list(zip(*report)) if report else [[]] * 5
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        fields = ["experiment", "subdir_str", "path", "first_frame", "n_frames"]
        yield pa.RecordBatch.from_arrays(arrays, fields)

    return run


def unpack_parts(pixels, byte_order):
    """float32 bytes back to frames."""

    def run(batches):
        for batch in batches:
            out = FrameBatches(CHUNK_KEYS, {"frame_no": pa.int64(), "parity": pa.int32()}, pa.float32())
            for key, start, values, _ in chunks_in(batch, pixels, byte_order + "f4"):
                numbers = start + np.arange(len(values), dtype="i8")
                yield from out.add(key, [numbers, (numbers % 2).astype("i4")], values.astype("f4"))
            if out.held:
                yield out.flush()

    return run


def unpack_pixels(pixels):
    """Packed frames to arrays, all other columns passed on."""

    def run(batches):
        for batch in batches:
            packed = batch.column("pixels")
            ends = np.frombuffer(packed.buffers()[1], "i4", len(packed) + 1, packed.offset * 4)
            if np.any(np.diff(ends) != 4 * pixels):
                raise ValueError(f"a packed frame is not {pixels} float32 values")
            values = np.frombuffer(packed.buffers()[2], "<f4", len(packed) * pixels, int(ends[0]))
            at = batch.schema.get_field_index("pixels")
            frames = list_array(values.reshape(-1, pixels), pa.float32())
            yield batch.set_column(at, "pixels", frames)

    return run
