
import pyarrow as pa
import pytest
from llm import brute
from pyspark.sql import functions as F
from scanforge.llm import quality

def test_counts_equal_brute_force(docs, odd_docs):
    for df in (docs, odd_docs):
        texts = [r["text"] for r in df.select("text").collect()]
        got = quality.count_texts(pa.array([None if t is None else t.encode() for t in texts])).to_pylist()
        for text, row in zip(texts, got):
            assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute.counts(text or "")

def test_repeated_windows():
    words = [b"w%d" % i for i in range(8)]
    assert quality.repeat_words(words * 2) == 16
    assert quality.repeat_words(words + [b"x"] + words) == 16
    assert quality.repeat_words(words) == 0
    assert quality.repeat_words([b"a"] * 20) == 20

@pytest.mark.parametrize("values", [[0], [1, 2, 3, 4], list(range(1000)), [7] * 50 + [9000] * 3])
def test_sketch_quartiles_within_resolution(spark, values):

    rows = spark.createDataFrame([("en", "s", "word_length", v) for v in values], "lang string, source string, metric string, v bigint")
    sketch = rows.select("lang", "source", "metric", quality.cell(F.col("v")).alias("cell")).groupBy("lang", "source", "metric", "cell").count().withColumnRenamed("count", "n")
    got = quality.quartiles(sketch, ["lang"]).first()
    for q in (1, 3):
        exact = sorted(values)[-(-q * len(values) // 4) - 1]
        assert exact * 15 // 16 <= got[f"word_length_q{q}"] <= exact

def test_odd_rows(odd_docs, no_docs):
    rows = quality.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert {r["n_words"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(r["doc_id"]) for r in rows if r["kept"])
    assert quality.judge(no_docs).count() == quality.keep_good(no_docs).count() == 0

def test_stage_keeps_what_the_query_keeps(docs):
    want = {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == want


def test_texts_are_counted_once_in_a_scan(docs, capsys):
    quality.sketches(quality.measure(docs)).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    good = quality.keep_good(docs)
    capsys.readouterr()
    good.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
