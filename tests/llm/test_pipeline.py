import os

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from llm import brute
from pyspark.sql import functions as F
from scanforge.llm import mixing, quality, queries, secrets
from tools.check_queries import normal

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    got, want = normal(queries.QUERIES[name](spark, SF).toPandas()), normal(con.execute(queries.ORACLE_SQL[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 0
    for c in got.columns:
        assert np.all(got[c].to_numpy() == want[c].to_numpy()), c


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_pipeline_equals_plain_steps(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r["doc_id"] for r in quality.judge(spark.read.parquet(f"{SF}/documents.parquet")).where("kept").collect()}
    one = set(brute.near_texts({i: docs[i]["text"] for i in kept}, 5).values())
    survivors = spark.createDataFrame([docs[i] for i in one], spark.read.parquet(f"{SF}/documents.parquet").schema)
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(survivors).collect()}
    placed = survivors.withColumn("domain", F.expr(queries.DOMAIN)).withColumn("text", F.col("text"))
    redacted = spark.createDataFrame([(r["doc_id"], clean[r["doc_id"]], r["lang"], r["source"], r["domain"]) for r in placed.collect()], "doc_id bigint, text string, lang string, source string, domain string")
    drawn = sorted(r["doc_id"] for r in mixing.mix(redacted, queries.PATH, [F.expr(w) for w in queries.WEIGHTS]).collect())
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == drawn
    assert all(r["restored"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert not any(brute.secret(clean[r["doc_id"]]) for r in rows)


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for df in (odd_docs, plain, no_docs):
        columns = df.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, SF)
            assert df.columns == columns, name
            df = spark.createDataFrame(df.collect(), df.schema)
        corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
