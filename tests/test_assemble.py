import random

from pyspark.sql import functions as F

import golden
from scanforge.operators import assemble
from scanforge.operators.integrity import check_integrity
from scanforge.schema import PACKET_SCHEMA


def facts_of(spark, rows, frame_bytes=1):
    packets = check_integrity(spark.createDataFrame(rows, PACKET_SCHEMA))
    chunks = assemble.chunk_facts(packets)
    return assemble.with_operation_file(assemble.acquisition_facts(chunks, frame_bytes), packets), chunks


def chunks_of(subdir, sizes, total=None, arrival=1, experiment="lab"):
    total = len(sizes) if total is None else total
    return [
        golden.packet(subdir, i, total, bytes(n), arrival + i, experiment=experiment) for i, n in enumerate(sizes, 1)
    ]


def test_gate_counts_distinct_chunks(spark):
    rows = chunks_of("whole", [4, 4, 2]) + [golden.operation("whole")]
    rows += chunks_of("copied", [4, 4])[:1] * 2 + [golden.operation("copied")]
    rows += chunks_of("gap", [4, 4], total=3) + [golden.operation("gap")]
    rows += chunks_of("lonely", [4])
    facts, _ = facts_of(spark, rows, frame_bytes=2)
    got = {r["subdir_str"]: r for r in facts.collect()}
    assert set(got) == {"whole", "copied", "gap"}
    assert got["whole"]["complete"] and got["whole"]["clean"]
    assert (got["whole"]["n_frames"], got["whole"]["body_frames"]) == (5, 2)
    assert not got["copied"]["complete"] and got["copied"]["n_received"] == 2 and not got["copied"]["clean"]
    assert not got["gap"]["complete"] and got["gap"]["body_frames"] is None


def test_irregular_layouts_are_recognised(spark):
    layouts = {"a": [4, 4, 4], "b": [4, 2, 4], "c": [3, 3, 3], "d": [7], "e": [2, 2, 9]}
    rows = [p for name, sizes in layouts.items() for p in [*chunks_of(name, sizes), golden.operation(name)]]
    facts, _ = facts_of(spark, rows, frame_bytes=2)
    assert {r["subdir_str"]: r["body_frames"] for r in facts.collect()} == {"a": 2, "b": None, "c": None, "d": 0, "e": 1}


def test_frame_offsets_over_many_blocks(spark):
    rng = random.Random(4)
    sizes = {"s": [rng.randint(0, 9) for _ in range(50)], "t": [rng.randint(1, 5) for _ in range(7)]}
    rows = [p for name, s in sizes.items() for p in chunks_of(name, s)]
    rng.shuffle(rows)
    _, chunks = facts_of(spark, rows)
    for block in (1, 4, 1024):
        got = {(r["subdir_str"], r["chunk_i"]): r for r in assemble.frame_offsets(chunks, 1, block).collect()}
        for name, s in sizes.items():
            for i, n in enumerate(s, 1):
                assert (got[name, i]["frame_start"], got[name, i]["n_frames"]) == (sum(s[: i - 1]), n)


def test_active_noise_rules(spark):
    rows = []
    for name, arrival in (("n1_bkg", 10), ("n2_bkg", 5), ("n3_bkg", 20)):
        rows += [*chunks_of(name, [2], arrival=arrival), golden.operation(name)]
    rows += [*chunks_of("half_bkg", [2], total=2, experiment="other"), golden.operation("half_bkg", "other")]
    facts, _ = facts_of(spark, rows)
    stored = spark.createDataFrame([("lab", "n1_bkg"), ("lab", "n3_bkg")], "experiment string, noise_subdir string")

    def pick(**kw):
        return {r["experiment"]: (r["noise_subdir"], r["stored"], r["usable"]) for r in assemble.active_noise(facts, **kw).collect()}

    assert pick() == {"lab": ("n2_bkg", False, True), "other": ("half_bkg", False, False)}
    assert pick(stored_means=stored)["lab"] == ("n3_bkg", True, True)
    assert pick(noise_subdir="n1_bkg") == {"lab": ("n1_bkg", False, True)}


def test_ready_signals(spark):
    rows = []
    for name in ("n_bkg", "m_bkg", "s1", "s2"):
        rows += [*chunks_of(name, [2], arrival=1 if name == "n_bkg" else 9), golden.operation(name)]
    rows += [*chunks_of("late", [2], total=2), golden.operation("late")]
    facts, _ = facts_of(spark, rows)
    noise = assemble.active_noise(facts)
    done = spark.createDataFrame([("lab", "s2")], "experiment string, subdir_str string")
    ready = assemble.ready_signals(facts, noise, done)
    assert [(r["subdir_str"], r["noise_subdir"]) for r in ready.collect()] == [("s1", "n_bkg")]
    ready = assemble.ready_signals(facts, noise, treat_extra_noise_as_signal=True)
    assert sorted(r["subdir_str"] for r in ready.collect()) == ["m_bkg", "s1", "s2"]


def test_gate_never_reads_the_payload(spark, tmp_path):
    packets = check_integrity(spark.createDataFrame(chunks_of("s", [2, 2]), PACKET_SCHEMA))
    packets.write.parquet(str(tmp_path / "p"))
    stored = spark.read.schema(packets.schema).parquet(str(tmp_path / "p"))
    facts = assemble.acquisition_facts(assemble.chunk_facts(stored), 2)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert "data#" not in plan.split("Relation")[0]
    physical = facts._jdf.queryExecution().executedPlan().toString()
    assert "data:binary" not in physical and "EqualTo(filename" in physical
    assert facts.filter(F.col("n_frames") == 2).count() == 1
