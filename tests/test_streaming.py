import json
import os
import random
import subprocess
import sys
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import golden
import test_correction as batch
from scanforge.operators.select import raw_operation_join
from scanforge.plans import run as plans_run
from scanforge.plans.run import Outputs
from scanforge.schema import PACKET_SCHEMA
from scanforge.sinks.histogram_log import log_table
from scanforge.sinks.raw import raw_table
from scanforge.sources.packets import stream_packet_files
from scanforge.sources.raw_files import read_listed
from scanforge.streaming import correction as streaming
from scanforge.streaming.join import raw_operation_stream_join
from scanforge.streaming.progress import ProgressLines, observe_packets


def write_files(spark, rows, folder, n_files):
    for i in range(n_files):
        part = spark.createDataFrame(rows[i::n_files], PACKET_SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(folder))


def handler(tables):
    return streaming.correct_completed(tables, batch.CALIBRATION, batch.G)


def run(spark, folder, tables, files_per_trigger=1):
    packets = stream_packet_files(spark, str(folder), files_per_trigger=files_per_trigger)
    streaming.start(packets, handler(tables), tables, once=True).awaitTermination()


def test_stream_equals_batch_and_survives_a_restart(spark, tmp_path):
    """Signals first, noise last, in two runs of one stream; then the last batch once more."""
    rows = batch.packet_rows()
    noise = [r for r in rows if r[1] == "n_bkg"]
    signals = [r for r in rows if r[1] != "n_bkg"]
    tables = streaming.Tables(str(tmp_path / "stream"))
    write_files(spark, signals + signals[:2], tmp_path / "in", 2)
    run(spark, tmp_path / "in", tables)
    assert tables.corrected(spark).count() == 0 and tables.processed(spark).count() == 0
    write_files(spark, noise, tmp_path / "in", 2)
    run(spark, tmp_path / "in", tables)
    batch.assert_golden(batch.results(spark, tables.root))
    assert sorted(r["subdir_str"] for r in tables.processed(spark).collect()) == ["s1", "s2"]

    landed = tables.packets(spark)
    last = landed.agg(F.max("batch_id")).first()[0]
    columns = [c.split()[0] for c in PACKET_SCHEMA.split(", ")]
    repeated = landed.filter(F.col("batch_id") == last).withColumn("arrival_order", F.col("arrival_order").cast("bigint"))
    again = spark.createDataFrame(repeated.select(*columns).collect(), PACKET_SCHEMA)
    before = landed.count()
    handler(tables)(again, last)
    assert tables.packets(spark).count() == before
    batch.assert_golden(batch.results(spark, tables.root))
    assert tables.processed(spark).count() == 2


def test_late_copies_of_processed_acquisitions_change_nothing(spark, tmp_path):
    tables = streaming.Tables(str(tmp_path / "stream"), partition_by=[])
    write_files(spark, batch.packet_rows(), tmp_path / "in", 1)
    run(spark, tmp_path / "in", tables)
    late = [r[:7] + (bytes(len(r[7])), 10_000) for r in batch.packet_rows() if r[1] == "s1"]
    write_files(spark, late, tmp_path / "in", 1)
    run(spark, tmp_path / "in", tables)
    batch.assert_golden(batch.results(spark, tables.root))
    assert tables.processed(spark).count() == 2


@pytest.mark.parametrize("bounded", [False, True])
def test_stream_join_equals_batch_join(spark, tmp_path, bounded):
    rows = batch.packet_rows() + [golden.packet("alone", 1, 1, b"x", 1), golden.operation("s1")]
    write_files(spark, rows, tmp_path / "in", 3)
    packets = stream_packet_files(spark, str(tmp_path / "in"), files_per_trigger=1)
    if bounded:
        packets = packets.withColumn("seen", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("arrival_order")))
    bounds = {"time_column": "seen", "delay": "1 hour", "max_gap": "1 day"} if bounded else {}
    joined = raw_operation_stream_join(packets, **bounds)
    query = (
        joined.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    columns = ["raw_subdir_str", "raw_chunk_i", "opr_filename", "my_experiment"]
    got = spark.read.schema(joined.schema).parquet(str(tmp_path / "out"))
    want = raw_operation_join(spark.createDataFrame(rows, PACKET_SCHEMA))
    key = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert key(got) == key(want) and len(key(got)) == 9


def test_progress_lines(spark, tmp_path):
    write_files(spark, batch.packet_rows(), tmp_path / "in", 2)
    lines = []
    listener = ProgressLines(lines.append)
    spark.streams.addListener(listener)
    try:
        packets = observe_packets(stream_packet_files(spark, str(tmp_path / "in"), files_per_trigger=1))
        query = packets.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
        query.trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10000)
    finally:
        spark.streams.removeListener(listener)
    assert len(lines) == 2 and lines[-1].endswith("12 packets so far")
    assert np.all(["bytes" in line for line in lines])


def raw_frames(spark, root, byte_order="<"):
    """Pixels by acquisition and frame, of the raw files that the run's list names."""
    table = raw_table(spark, root)
    rows = read_listed(table.load(), table.files_path, batch.G, byte_order).collect()
    assert len({(r["subdir_str"], r["frame_no"]) for r in rows}) == len(rows)
    return {(r["subdir_str"], r["frame_no"]): r["pixels"] for r in rows}


def check_outputs(spark, root, byte_order="<"):
    frames = batch.results(spark, root)
    batch.assert_golden(frames)
    want = {(s, r["frame_no"]): r["pixels"] for s, rows in frames.items() for r in rows}
    assert raw_frames(spark, root, byte_order) == want
    lines = {(r["log_name"], r["frame_no"]): r["line"] for r in log_table(spark, root).load().collect()}
    assert lines == {(f"hist_{s}.txt", r["frame_no"]): f"{r['hist_max']} : {r['hist_arg']}" for s, rows in frames.items() for r in rows}
    assert log_table(spark, root).load().count() == len(lines)


def test_outputs_of_a_batch_run(spark, tmp_path):
    batch.run(spark, batch.packet_rows(), tmp_path, outputs=Outputs(log=True, raw=">"))
    check_outputs(spark, str(tmp_path), ">")
    batch.run(spark, batch.packet_rows(), tmp_path, outputs=Outputs(log=True, raw=">"))
    check_outputs(spark, str(tmp_path), ">")


def test_outputs_count_once_when_a_batch_runs_again(spark, tmp_path, monkeypatch):
    """The batch fails after its files are written, again after its frames are listed, and then runs to its end, twice."""
    tables = streaming.Tables(str(tmp_path / "stream"))
    handle = streaming.correct_completed(tables, batch.CALIBRATION, batch.G, outputs=Outputs(log=True, raw="<"))
    rows = spark.createDataFrame(batch.packet_rows(), PACKET_SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(plans_run, "processed_table", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            handle(rows, 0)
    with monkeypatch.context() as m:
        m.setattr(streaming.Gate, "retire", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            handle(rows, 0)
    for _ in range(2):
        handle(rows, 0)
        check_outputs(spark, tables.root)
    late = spark.createDataFrame([r for r in batch.packet_rows() if r[1] == "s1"], PACKET_SCHEMA)
    handle(late, 1)
    check_outputs(spark, tables.root)
    assert tables.processed(spark).count() == 2


@pytest.mark.parametrize("policy", ["keep", "drop", "quarantine"])
def test_policy_of_a_stream(spark, tmp_path, policy):
    """A damaged copy is kept with the others, dropped, or set aside; a damaged only copy holds its acquisition back unless kept."""
    rows = batch.packet_rows()
    bad = [r[:7] + (bytes(len(r[7])), r[8] + 50) for r in rows if r[2] == golden.RAW and r[4] == 2]
    write_files(spark, rows + bad, tmp_path / "in", 2)
    tables = streaming.Tables(str(tmp_path / "stream"))
    packets = stream_packet_files(spark, str(tmp_path / "in"), files_per_trigger=1)
    streaming.start(packets, handler(tables), tables, once=True, policy=policy, emit=None).awaitTermination()
    batch.assert_golden(batch.results(spark, tables.root))
    n_bad = len(bad)
    assert tables.packets(spark).count() == len(rows) + (n_bad if policy == "keep" else 0)
    assert tables.quarantined(spark).count() == (n_bad if policy == "quarantine" else 0)
    handler(tables)(spark.createDataFrame(bad, PACKET_SCHEMA), 5)
    handler(tables)(spark.createDataFrame(bad, PACKET_SCHEMA), 5)
    assert tables.quarantined(spark).count() == (2 * n_bad if policy == "quarantine" else 0)


def test_unknown_policy(spark, tmp_path):
    tables = streaming.Tables(str(tmp_path / "stream"), policy="burn")
    with pytest.raises(ValueError, match="policy"):
        handler(tables)(spark.createDataFrame(batch.packet_rows(), PACKET_SCHEMA), 0)


def test_start_reports_progress(spark, tmp_path):
    write_files(spark, batch.packet_rows(), tmp_path / "in", 2)
    tables = streaming.Tables(str(tmp_path / "stream"))
    packets = stream_packet_files(spark, str(tmp_path / "in"), files_per_trigger=1)
    lines = []
    before = spark._jsparkSession.streams().listListeners().__len__()
    streaming.start(packets, handler(tables), tables, once=True, emit=lines.append).awaitTermination()
    deadline = time.time() + 30
    while spark._jsparkSession.streams().listListeners().__len__() > before and time.time() < deadline:
        time.sleep(0.2)
    assert len(lines) == 2 and lines[-1].endswith("12 packets so far")
    assert spark._jsparkSession.streams().listListeners().__len__() == before


def many_acquisitions(n):
    rows = golden.scan_packets("n_bkg", batch.NOISE, [4, 4, 2])
    parts = [rows]
    for i in range(n):
        parts.append(golden.scan_packets(f"s{i}", batch.SIGNALS["s1"], [4, 4, 2], arrival=100 * (i + 1)))
    return parts


def test_gate_equals_batch_for_any_split(spark, tmp_path):
    """Chunks, copies, damaged copies and operation files in random order over many batches."""
    rows = [r for part in many_acquisitions(3) for r in part]
    rows += [r[:7] + (bytes(len(r[7])), r[8] + 1) for r in rows if r[2] == golden.RAW and r[4] == 2]
    rows += [golden.packet("s1", 2, 3, batch.SIGNALS["s1"][4:8].tobytes(), 9_999), golden.packet("lost", 1, 3, b"1234", 7)]
    random.Random(4).shuffle(rows)
    tables = streaming.Tables(str(tmp_path / "stream"), partition_by=[])
    handle = handler(tables)
    for i in range(0, len(rows), 8):
        for _ in range(2 if i == 8 else 1):
            handle(spark.createDataFrame(rows[i : i + 8], PACKET_SCHEMA), i // 8)
    got = batch.results(spark, tables.root)
    want = batch.run(spark, rows, tmp_path / "batch")
    assert {s: [(r["frame_no"], r["offset"], r["pixels"]) for r in x] for s, x in got.items()} == {s: [(r["frame_no"], r["offset"], r["pixels"]) for r in x] for s, x in want.items()}
    assert set(got) == {"s0", "s1", "s2"}
    gate = streaming.Gate(spark, tables.root, tables.packet_table(spark), streaming.processed_table(spark, tables.root))
    assert {r["subdir_str"] for r in gate.state.load().collect()} == {"n_bkg", "lost"}


GROWTH = """
import json, sys
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", {log!r})
    .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").config("spark.checkpoint.dir", {shared!r}).getOrCreate())
import test_streaming as t
from scanforge.schema import PACKET_SCHEMA
from scanforge.streaming import correction as streaming
tables = streaming.Tables({stream!r})
handle = streaming.record_completed(tables)
for i, rows in enumerate(t.many_acquisitions(20)):
    batch = spark.createDataFrame(rows, PACKET_SCHEMA)
    spark.sparkContext.setJobGroup(str(i), "batch")
    handle(batch, i)
assert tables.completed(spark).count() == 21
spark.stop()
"""


def test_rows_read_by_a_batch_do_not_grow(tmp_path):
    """Twenty acquisitions of one experiment, one a batch; rows that tables gave to each batch's tasks, from the event log."""
    here = os.path.dirname(os.path.abspath(__file__))
    places = {k: str(tmp_path / k) for k in ("log", "shared", "stream")}
    os.makedirs(places["log"])
    code = GROWTH.format(root=os.path.dirname(here), tests=here, **places)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    group, read = {}, Counter()
    for name in os.listdir(places["log"]):
        for line in open(os.path.join(places["log"], name)):
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group |= dict.fromkeys(event["Stage IDs"], event.get("Properties", {}).get("spark.jobGroup.id"))
            if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                read[group.get(event["Stage ID"])] += event["Task Metrics"]["Input Metrics"]["Records Read"]
    early, late = [sum(read[str(i)] for i in some) for some in (range(2, 8), range(15, 21))]
    # What remains is a row of the list of processed acquisitions for each one before.
    assert late <= early + 6 * 13 * 8, (early, late, dict(read))
    assert max(read[str(i)] for i in range(15, 21)) < 1.5 * min(read[str(i)] for i in range(2, 8)) + 13 * 8
