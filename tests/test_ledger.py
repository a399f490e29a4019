import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanforge.operators.scan import running_sum
from scanforge.plans import ledger as ledgers
from scanforge.plans.ledger import Ledger
from scanforge.plans.tables import load

SCHEMA = "batch_id bigint, name string, x bigint"


def rows_of(spark, batch, n=3):
    return spark.createDataFrame([(batch, f"n{i % 2}", 100 * batch + i) for i in range(n)], SCHEMA).coalesce(1)


def values(df):
    return sorted(r["x"] for r in df.collect())


def files_in(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


@pytest.mark.parametrize("partition_by", [(), ("name",)])
def test_parts_stay_few(spark, tmp_path, monkeypatch, partition_by):
    monkeypatch.setattr(ledgers, "FANOUT", 4)
    table = Ledger(spark, str(tmp_path / "t"), SCHEMA, partition_by)
    assert table.load().count() == 0
    most = 0
    for batch in range(50):
        table.append(rows_of(spark, batch), batch)
        most = max(most, len(files_in(tmp_path / "t")))
    assert values(table.load()) == sorted(100 * b + i for b in range(50) for i in range(3))
    assert len(table.parts()) <= 3 * 4 and most <= (2 if partition_by else 1) * 2 * 3 * 4
    assert values(load(spark, str(tmp_path / "t"), SCHEMA)) == values(table.load())
    late = table.load(first=49)
    assert late.count() < 150 and set(values(late.where("batch_id = 49"))) == {4900, 4901, 4902}


def test_a_batch_that_runs_again_counts_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledgers, "FANOUT", 3)
    table = Ledger(spark, str(tmp_path / "t"), SCHEMA)
    for batch in (0, 1, 2, 2, 2, 3, 3):
        table.append(rows_of(spark, batch), batch)
        assert values(table.load(before=batch)) == sorted(100 * b + i for b in range(batch) for i in range(3))
    assert values(table.load()) == sorted(100 * b + i for b in range(4) for i in range(3))


def test_what_a_failed_attempt_left_is_not_read(spark, tmp_path):
    """A crash after the rows and before the list, and one while a list was written."""
    table = Ledger(spark, str(tmp_path / "t"), SCHEMA)
    table.append(rows_of(spark, 0), 0)
    table.write(rows_of(spark, 1), table.folder(1))
    os.makedirs(tmp_path / "t/_lists", exist_ok=True)
    (tmp_path / "t/_lists/000000000001.0123456789ab").write_text("[{")
    assert values(table.load()) == [0, 1, 2] and table.versions() == [0]
    table.append(rows_of(spark, 1, n=1), 1)
    assert values(table.load()) == [0, 1, 2, 100]
    assert len([f for f in files_in(tmp_path / "t")]) == 2


def test_replace_reads_what_it_replaces(spark, tmp_path):
    table = Ledger(spark, str(tmp_path / "t"), SCHEMA)
    for batch in range(5):
        table.replace(table.load(before=batch).withColumn("x", F.col("x") + 1).union(rows_of(spark, batch, 1)), batch)
        table.replace(table.load(before=batch).withColumn("x", F.col("x") + 1).union(rows_of(spark, batch, 1)), batch)
    assert values(table.load()) == sorted(100 * b + 4 - b for b in range(5))
    assert len(files_in(tmp_path / "t")) <= 20


def test_large_parts_are_not_rewritten(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledgers, "FANOUT", 2)
    monkeypatch.setattr(ledgers, "LARGE", 1)
    table = Ledger(spark, str(tmp_path / "t"), SCHEMA)
    for batch in range(4):
        table.append(rows_of(spark, batch), batch)
    assert [p.level for p in table.parts()] == [0] * 4 and table.load().count() == 12


@pytest.mark.parametrize("block,levels", [(4, 0), (4, 1), (4, 3), (7, 2), (1024, 4)])
def test_running_sum(spark, block, levels):
    draw = np.random.default_rng(block)
    rows = [(k, int(p), int(v)) for k, n in (("a", 300), ("b", 1), (None, 40)) for p, v in zip(draw.permutation(n * 3)[:n], draw.integers(0, 50, n))]
    df = spark.createDataFrame(rows, "k string, p bigint, v bigint").repartition(4, "p")
    got = {(r["k"], r["p"]): (r["v"], r["s"]) for r in running_sum(df, ["k"], "p", "v", "s", block, levels).collect()}
    want = {(k, p): (v, sum(y for a, q, y in rows if a == k and q < p)) for k, p, v in rows}
    assert got == want


def test_running_sum_sorts_blocks_only(spark):
    """With two levels of 8, no window holds more than 8 rows of a key of 512."""
    df = spark.range(512).select(F.lit("k").alias("k"), F.col("id").alias("p"), F.lit(1).alias("v"))
    out = running_sum(df, ["k"], "p", "v", "s", block=8, levels=2)
    assert [r["s"] for r in out.orderBy("p").collect()] == list(range(512))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line.lower() or "Window [" in line]
    assert len(windows) == 3 and all("block" in line for line in windows[:2])
