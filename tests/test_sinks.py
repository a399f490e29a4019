import glob
import hashlib
import os

import numpy as np
import pytest

import golden
from scanforge.config import Geometry
from scanforge.operators import decode
from scanforge.sinks.histogram_log import write_log
from scanforge.sinks.raw import export_raw
from scanforge.sources import calibration as cal
from scanforge.sources import raw_files

G = Geometry(4, 4)


def frames_df(spark, n=23, packed=False):
    rng = np.random.default_rng(2)
    data = {s: rng.normal(0, 50, (n, G.pixels)).astype("f4") for s in ("s1", "s2")}
    kind = "binary" if packed else "array<float>"
    rows = [
        ("lab", s, f, bytearray(v.tobytes()) if packed else v.tolist()) for s in data for f, v in enumerate(data[s])
    ]
    rows = rows[::-1] if packed else rows
    return data, spark.createDataFrame(rows, f"experiment string, subdir_str string, frame_no bigint, pixels {kind}")


@pytest.mark.parametrize("byte_order,packed", [("<", False), (">", True), ("<", True)])
def test_raw_export_and_read_back(spark, tmp_path, byte_order, packed):
    data, frames = frames_df(spark, packed=packed)
    root = str(tmp_path / "out")
    files = export_raw(frames, root, byte_order, frames_per_file=5, merge_runs=packed).collect()
    assert sum(f["n_frames"] for f in files) == 46 and max(f["n_frames"] for f in files) <= 5
    for s, values in data.items():
        parts = sorted(glob.glob(f"{root}/lab/out_{s}.raw/part-*"))
        whole = b"".join(open(p, "rb").read() for p in parts)
        assert whole == values.astype(byte_order + "f4").tobytes()
    back = raw_files.read_exported(spark, root, G, byte_order).orderBy("subdir_str", "frame_no").collect()
    assert np.array_equal([r["pixels"] for r in back], np.concatenate([data["s1"], data["s2"]]))
    with pytest.raises(ValueError, match="new folder"):
        export_raw(frames, root, byte_order)


def test_packed_frames_unpack(spark):
    data, frames = frames_df(spark, packed=True)
    got = decode.unpack_pixels(frames, G).orderBy("subdir_str", "frame_no").collect()
    assert np.array_equal([r["pixels"] for r in got], np.concatenate([data["s1"], data["s2"]]))
    with pytest.raises(Exception, match="float32 values"):
        decode.unpack_pixels(frames, Geometry(3, 3)).collect()


def test_histogram_log_is_ordered(spark, tmp_path):
    rows = [("lab", s, f, 100 + f, f % 42 + 1) for s in ("s1", "s2") for f in range(500)][::-1]
    stats = spark.createDataFrame(
        rows, "experiment string, subdir_str string, frame_no bigint, hist_max bigint, hist_arg int"
    )
    for _ in range(2):
        write_log(stats, str(tmp_path / "hist"))
    for s in ("s1", "s2"):
        parts = sorted(glob.glob(f"{tmp_path}/hist/experiment=lab/log_name=hist_{s}.txt/part-*"))
        lines = [line for p in parts for line in open(p).read().splitlines()]
        assert lines == [f"{100 + f} : {f % 42 + 1}" for f in range(500)]


def test_raw_file_becomes_packets(spark, tmp_path):
    folder = tmp_path / "scan_3_bkg"
    os.makedirs(folder)
    content = bytes(range(256)) * 5 + b"end"
    (folder / golden.RAW).write_bytes(content)
    rows = raw_files.files_to_packets(spark, str(tmp_path), "lab", n_chunks=10).orderBy("chunk_i").collect()
    assert b"".join(bytes(r["data"]) for r in rows) == content
    assert [r["chunk_i"] for r in rows] == list(range(1, 12)) and {r["n_total_chunks"] for r in rows} == {11}
    assert all(bytes(r["chunk_hash"]) == hashlib.sha512(bytes(r["data"])).digest() for r in rows)
    assert {(r["subdir_str"], r["filename"], r["kind"]) for r in rows} == {("scan_3_bkg", golden.RAW, "noise")}


def test_scan_file_is_read_at_record_boundaries(spark, tmp_path):
    words = golden.make_words(37, G.pixels, seed=3)
    path = tmp_path / "scan.raw"
    path.write_bytes(words.tobytes())
    rows = raw_files.read_scan_records(spark, str(path), G.frame_bytes).orderBy("frame_no").collect()
    assert [r["frame_no"] for r in rows] == list(range(37))
    assert b"".join(bytes(r["data"]) for r in rows) == words.tobytes()


def test_part_of_wrong_length_is_refused(spark):
    parts = spark.createDataFrame(
        [("lab", "s", 1, 0, bytearray(10))],
        "experiment string, subdir_str string, chunk_i bigint, frame_start bigint, data binary",
    )
    with pytest.raises(Exception, match="whole number of frames"):
        raw_files.read_float_parts(parts, G).collect()


def test_calibration_from_named_matrices(spark):
    calibration = golden.make_calibration(G.pixels)
    names = {(f, p): n for n, (f, p) in cal.CALIBRATION_MATRICES.items()}
    rows = [
        (names[f, p], i // 4, i % 4, float(v) + 1e-12)
        for p, fields in calibration.items()
        for f, m in fields.items()
        for i, v in enumerate(m)
    ][::-1] + [("other", 0, 0, 1.0)]
    table = cal.from_named_matrices(spark.createDataFrame(rows, "name string, y int, x int, value double"), G)
    got = cal.as_arrays(table, G)
    assert all(np.array_equal(got[p][f], calibration[p][f]) for p in (0, 1) for f in cal.FIELDS)
    assert cal.to_long(table).count() == 2 * G.pixels
    with pytest.raises(ValueError, match="values"):
        cal.as_arrays(table, Geometry(5, 5))
    with pytest.raises(ValueError, match="exactly one row"):
        cal.as_arrays(table.filter("parity = 0"), G)


def test_log_keeps_other_signals(spark, tmp_path):
    schema = "experiment string, subdir_str string, frame_no bigint, hist_max bigint, hist_arg int"
    for s, peak in (("s1", 5), ("s2", 6), ("s1", 7)):
        write_log(spark.createDataFrame([("lab", s, 0, peak, 1)], schema), str(tmp_path / "hist"))
    lines = {s: "".join(open(p).read() for p in glob.glob(f"{tmp_path}/hist/experiment=lab/log_name=hist_{s}.txt/part-*")) for s in ("s1", "s2")}
    assert lines == {"s1": "7 : 1\n", "s2": "6 : 1\n"}


def test_leftover_parts_are_not_read(spark, tmp_path):
    data, frames = frames_df(spark)
    root = f"file:{tmp_path}/out"
    export_raw(frames, root)
    part = glob.glob(f"{tmp_path}/out/lab/out_s1.raw/part-*")[0]
    open(part.rpartition("-")[0] + "-leftover", "wb").write(open(part, "rb").read())
    open(part + ".tmp", "wb").write(b"abc")
    assert raw_files.read_exported(spark, root, G).count() == len(data["s1"]) + len(data["s2"])


def test_empty_file_is_one_empty_chunk(spark):
    files = spark.createDataFrame([("a", bytearray()), ("b", bytearray(b"xyz")), ("c", None)], "name string, content binary")
    rows = raw_files.cut_into_chunks(files, 2).orderBy("name", "chunk_i").collect()
    assert [(r["name"], r["chunk_i"], r["n_total_chunks"], bytes(r["data"])) for r in rows] == [("a", 1, 1, b""), ("b", 1, 3, b"x"), ("b", 2, 3, b"y"), ("b", 3, 3, b"z")]
