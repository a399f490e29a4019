import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import golden
from scanforge.config import Geometry, OffsetRule
from scanforge.operators import arrays, background, decode
from scanforge.operators.integrity import check_integrity
from scanforge.plans import correction, joins
from scanforge.plans.run import correct_packets, read_corrected, wave_count
from scanforge.plans.tables import load, save
from scanforge.schema import NOISE_MEANS_SCHEMA, PACKET_SCHEMA, STORED_SCHEMA
from scanforge.sinks.tables import store_noise_means

G = Geometry(12, 12)
CALIBRATION = golden.make_calibration(G.pixels)
NOISE = golden.make_words(10, G.pixels, seed=20)
SIGNALS = {
    "s1": golden.make_words(10, G.pixels, seed=21, shift=40),
    "s2": golden.make_words(11, G.pixels, seed=22, shift=-90),
}
GOLDEN = {name: golden.correct(words, NOISE, CALIBRATION) for name, words in SIGNALS.items()}


def packet_rows(sizes=(4, 4, 2)):
    rows = golden.scan_packets("n_bkg", NOISE, sizes)
    rows += golden.scan_packets("s1", SIGNALS["s1"], sizes, arrival=100)
    return rows + golden.scan_packets("s2", SIGNALS["s2"], [*sizes[:-1], sizes[-1] + 1], arrival=200)


def run(spark, rows, root, partition_by=None, **options):
    packets = check_integrity(spark.createDataFrame(rows, PACKET_SCHEMA))
    packets = save(packets, f"{root}/packets", partition_by)
    correct_packets(packets, CALIBRATION, G, str(root), partition_by=partition_by, **options)
    return results(spark, root)


def results(spark, root):
    out = {}
    for r in read_corrected(spark, f"{root}/corrected", G).orderBy("frame_no").collect():
        out.setdefault(r["subdir_str"], []).append(r)
    return out


def assert_golden(got, names=("s1", "s2")):
    assert set(got) == set(names)
    for name in names:
        frames, stats = GOLDEN[name]
        assert [r["frame_no"] for r in got[name]] == list(range(len(frames)))
        assert [(r["hist_max"], r["hist_arg"]) for r in got[name]] == [s[:2] for s in stats]
        np.testing.assert_allclose([r["offset"] for r in got[name]], [s[2] for s in stats], atol=1e-9)
        np.testing.assert_allclose(np.array([r["pixels"] for r in got[name]]), frames, rtol=1e-6, atol=1e-5)


def test_golden_covers_both_arms():
    offsets = [s[2] for _, stats in GOLDEN.values() for s in stats]
    peaks = [s[0] for _, stats in GOLDEN.values() for s in stats]
    assert any(offsets) and max(peaks) > 40


@pytest.mark.parametrize("layout", [None, ["experiment", "subdir_str"]])
def test_batch_equals_golden(spark, tmp_path, layout):
    assert_golden(run(spark, packet_rows(), tmp_path, layout))
    # A second run finds nothing left to do.
    assert_golden(run(spark, packet_rows(), tmp_path, layout))


def disturbed(kind):
    rows = packet_rows()
    if kind == "reversed":
        return rows[::-1]
    if kind == "noise last":
        return [r[:8] + (r[8] + 10_000 * (r[1] == "n_bkg"),) for r in rows]
    if kind == "copies":
        return rows + [r for r in rows if r[4] in (1, 3)]
    if kind == "damaged copies":
        bad = [r[:7] + (bytes(len(r[7])), r[8] + 50) for r in rows if r[2] == golden.RAW and r[4] == 2]
        return rows + bad
    if kind == "longer damaged copies":
        bad = [r[:7] + (bytes(2 * len(r[7])), r[8] - 1) for r in rows if r[2] == golden.RAW and r[4] == 1]
        return bad + rows
    if kind == "uneven chunks":
        return packet_rows(sizes=(1, 5, 4))
    if kind == "short first chunk":
        return packet_rows(sizes=(2, 4, 4))
    if kind == "many operation files":
        return rows + [golden.operation(n, suffix=s) for n in ("n_bkg", "s1", "s2") for s in (".xml", ".txt")]
    rng = random.Random(1)
    rng.shuffle(rows)
    return rows


KINDS = ["reversed", "noise last", "copies", "damaged copies", "longer damaged copies"]
KINDS += ["uneven chunks", "short first chunk", "many operation files", "shuffled"]


@pytest.mark.parametrize("kind", KINDS)
def test_result_does_not_depend_on_delivery(spark, tmp_path, kind):
    assert_golden(run(spark, disturbed(kind), tmp_path))


@pytest.mark.parametrize("kind", ["shuffled", "damaged copies"])
def test_salted_joins_give_the_same(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "rows_within", lambda *a: 0)
    monkeypatch.setattr(correction, "rows_within", lambda *a: 0)
    assert_golden(run(spark, disturbed(kind), tmp_path))


def test_missing_chunk_holds_an_acquisition_back(spark, tmp_path):
    rows = [r for r in packet_rows() if not (r[1] == "s1" and r[4] == 2)]
    assert_golden(run(spark, rows, tmp_path), names=["s2"])
    rows = [r for r in packet_rows() if not (r[1] == "n_bkg" and r[4] == 2)]
    assert run(spark, rows, tmp_path / "no_noise") == {}


def test_processed_acquisitions_are_skipped_and_means_reused(spark, tmp_path):
    done = spark.createDataFrame([("lab", "s1")], "experiment string, subdir_str string")
    assert_golden(run(spark, packet_rows(), tmp_path, processed=done), names=["s2"])
    means = load(spark, str(tmp_path / "noise_means"), NOISE_MEANS_SCHEMA)
    doubled = means.withColumn("pixels", F.transform("pixels", lambda v: v * 2))
    store_noise_means(doubled, str(tmp_path / "second/noise_means"))
    got = run(spark, packet_rows(), tmp_path / "second")
    frames = golden.decode(SIGNALS["s1"], CALIBRATION)
    mean = golden.means(golden.decode(NOISE, CALIBRATION))
    values = frames[0] - 2 * mean[0]
    assert got["s1"][0]["offset"] == pytest.approx(golden.offset(values)[2], abs=1e-9)


def test_extra_noise_as_signal(spark, tmp_path):
    rows = packet_rows() + golden.scan_packets("x_bkg", SIGNALS["s1"], [4, 4, 2], arrival=900)
    assert set(run(spark, rows, tmp_path)) == {"s1", "s2"}
    got = run(spark, rows, tmp_path / "switch", treat_extra_noise_as_signal=True)
    assert set(got) == {"s1", "s2", "x_bkg"}
    assert [r["offset"] for r in got["x_bkg"]] == [r["offset"] for r in got["s1"]]


def test_single_noise_frame(spark, tmp_path):
    rows = golden.scan_packets("n_bkg", NOISE[:1], [1]) + golden.scan_packets("s", SIGNALS["s1"][:2], [2], arrival=9)
    got = run(spark, rows, tmp_path)["s"]
    assert np.isnan(got[0]["pixels"]).all() and (got[0]["hist_max"], got[0]["offset"]) == (0, 0.0)
    odd = golden.decode(SIGNALS["s1"][:2], CALIBRATION)[1]
    expected = (odd - golden.offset(odd)[2]) * CALIBRATION[1]["flat"].astype("f8")
    np.testing.assert_allclose(got[1]["pixels"], expected.astype("f4"), rtol=1e-6)


def test_two_experiments_and_waves(spark, tmp_path, monkeypatch):
    other = golden.scan_packets("n2_bkg", SIGNALS["s2"], [4, 4, 3], experiment="two")
    other += golden.scan_packets("s3", SIGNALS["s1"], [4, 4, 2], arrival=50, experiment="two")
    plain = run(spark, packet_rows() + other, tmp_path)
    assert_golden({k: plain[k] for k in ("s1", "s2")})
    monkeypatch.setattr("scanforge.plans.run.wave_count", lambda *a: 3)
    waves = run(spark, packet_rows() + other, tmp_path / "waves")
    assert {k: [r["pixels"] for r in v] for k, v in waves.items()} == {k: [r["pixels"] for r in v] for k, v in plain.items()}
    assert wave_count(1, Geometry()) == 1 and wave_count(5000, Geometry()) == 7


def test_full_size_frames(spark, tmp_path):
    full = Geometry()
    calibration = golden.make_calibration(full.pixels, seed=8)
    noise, signal = golden.make_words(4, full.pixels, seed=30), golden.make_words(4, full.pixels, seed=31, shift=25)
    rows = golden.scan_packets("n_bkg", noise, [2, 2]) + golden.scan_packets("s", signal, [2, 2], arrival=10)
    packets = save(check_integrity(spark.createDataFrame(rows, PACKET_SCHEMA)), str(tmp_path / "packets"))
    correct_packets(packets, calibration, full, str(tmp_path))
    got = read_corrected(spark, str(tmp_path / "corrected"), full).orderBy("frame_no").collect()
    frames, stats = golden.correct(signal, noise, calibration)
    assert [(r["hist_max"], r["hist_arg"]) for r in got] == [s[:2] for s in stats]
    np.testing.assert_allclose(np.array([r["pixels"] for r in got]), frames, rtol=1e-6, atol=1e-5)


def test_array_columns_give_the_same_as_the_kernel(spark, tmp_path):
    run(spark, packet_rows(), tmp_path)
    packets = spark.read.parquet(str(tmp_path / "packets"))
    ready = correction.find_ready(packets, G, str(tmp_path / "again"))
    chunks = correction.select_chunks(packets, ready.signals, G.frame_bytes)
    frames = decode.decode_frames(chunks, CALIBRATION, G)
    means = load(spark, str(tmp_path / "noise_means"), NOISE_MEANS_SCHEMA)
    stored = load(spark, str(tmp_path / "corrected"), STORED_SCHEMA)
    totals = ready.signals.select("experiment", "subdir_str", "n_frames")
    masks = [(p, *[[float(v) for v in m[f]] for f in ("g1", "g2", "off", "flat")]) for p, m in CALIBRATION.items()]
    calibration = spark.createDataFrame(masks, "parity int, g1 array<float>, g2 array<float>, off array<float>, flat array<float>")
    out = arrays.subtract_background(frames, means)
    out = arrays.remove_offsets(out, stored.select("experiment", "subdir_str", "frame_no", "offset"))
    out = arrays.apply_flat_field(out, calibration, totals)
    got = {}
    for r in out.orderBy("frame_no").collect():
        got.setdefault(r["subdir_str"], []).append(r["pixels"])
    for name, (frames, _) in GOLDEN.items():
        np.testing.assert_allclose(np.array(got[name]), frames, rtol=1e-6, atol=1e-5)


def test_regular_payload_is_not_shuffled(spark, tmp_path):
    root = str(tmp_path)
    packets = check_integrity(spark.createDataFrame(packet_rows(), PACKET_SCHEMA))
    packets = save(packets, f"{root}/packets", ["experiment", "subdir_str"])
    ready = correction.find_ready(packets, G, f"{root}/gate")
    means = save(correction.compute_means(packets, ready, CALIBRATION, G), f"{root}/means")
    frames = correction.correct_signals(packets, ready.signals, means, CALIBRATION, G, OffsetRule())
    plan = frames._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # What is shuffled are noise names and mean frames; chunks and their payload are not.
    assert shuffles and all("chunk_i" not in s and "subdir_str" not in s and "_salt" not in s for s in shuffles)
    assert "SortMergeJoin" not in plan and "max_by" not in plan and plan.count("MapInArrow") == 1
    assert "dynamicpruning" in plan and "EqualTo(filename" in plan


def test_means_of_noise_without_partner_frames(spark, tmp_path):
    rows = golden.scan_packets("n_bkg", NOISE[:5], [2, 3])
    packets = save(check_integrity(spark.createDataFrame(rows, PACKET_SCHEMA)), str(tmp_path / "p"))
    ready = correction.find_ready(packets, G, str(tmp_path / "g"))
    means = {r["parity"]: r["pixels"] for r in correction.compute_means(packets, ready, CALIBRATION, G).collect()}
    expected = golden.means(golden.decode(NOISE[:5], CALIBRATION))
    np.testing.assert_allclose(means[0], expected[0], rtol=1e-12)
    np.testing.assert_allclose(means[1], expected[1], rtol=1e-12)
    wide = background.means_by_noise(correction.compute_means(packets, ready, CALIBRATION, G)).first()
    np.testing.assert_allclose(wide["mean_1"], expected[1], rtol=1e-12)


def test_malformed_acquisition_is_set_aside(spark, tmp_path):
    """A chunk that isn't a whole number of frames holds back its acquisition only; a good copy later frees it."""
    rows = packet_rows()
    broken = golden.packet("s2", 2, 3, b"12345", 5000)
    others = [r for r in rows if not (r[1] == "s2" and r[2] == golden.RAW and r[4] == 2)]
    got = run(spark, [*others, broken], tmp_path / "a")
    assert_golden(got, ("s1",))
    listed = spark.read.parquet(str(tmp_path / "a/gate/batch_id=0/malformed")).collect()
    assert [(r["subdir_str"], r["n_broken"]) for r in listed] == [("s2", 1)]


def test_tied_copies_give_one_result_in_any_order(spark, tmp_path):
    """Copies with equal arrival and hashes of their own, of different lengths: one is chosen, whatever the order of rows."""
    rows = packet_rows()
    first = next(r for r in rows if r[1] == "s1" and r[2] == golden.RAW and r[4] == 2)
    shorter = golden.packet("s1", 2, 3, SIGNALS["s1"][4:6].tobytes(), 0)
    tied = [(*r[:-1], first[-1]) for r in (first, shorter)]
    others = [r for r in rows if r != first]
    seen = []
    for i, pair in enumerate((tied, tied[::-1], [*tied, tied[0], tied[1]])):
        got = run(spark, [*others, *pair], tmp_path / str(i))
        seen.append([(r["frame_no"], tuple(r["pixels"])) for r in got["s1"]])
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == len(SIGNALS["s1"])
