import os
import pickle
import random
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from scanforge.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="needs the public model")
ODD = ["", " ", "  a", "a ", "▁a", "😀é½ﬁ\t\n x", " \x00\x01abc日本語テキスト", "a" * 300, "    indent\n\t\tdef f(x):  return x**2", "Ünïcödé — “quotes” … ☃ नमस्ते"]


@pytest.fixture(scope="module")
def model(spark):
    return pieces.read_model(spark, pieces.MODEL)


def test_ids_equal_the_library(spark, model, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    machine = pieces.Transducer(model)
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    for text in [r["text"] for r in docs.collect()] + pages + ODD:
        ids = machine.encode(text)
        assert ids == library.encode(text)
        assert machine.decode(ids) == library.decode(ids) == text.replace(pieces.MARK, " ")


def test_unigram_path_is_the_best_of_all():
    vocabulary = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -3.5, "ba": -5.0, "▁ab": -7.2, "aba": -6.0}
    model = pieces.Model(list(vocabulary), list(vocabulary.values()), [pieces.NORMAL] * len(vocabulary), pieces.UNIGRAM)
    machine = pieces.Transducer(model)

    def best(text):
        if not text:
            return 0.0
        return max(vocabulary[text[:n]] + best(text[n:]) for n in range(1, len(text) + 1) if text[:n] in vocabulary)

    for text in ("▁abab", "▁aabba", "▁baba", "▁abaaba"):
        assert sum(vocabulary[p] for p in machine.unigram_path(text)) == pytest.approx(best(text))


def test_rows(odd_docs, no_docs):
    rows = pieces.tokenise(odd_docs.select("doc_id", "text", F.lit("x").alias("restored"))).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r["ids"] is None) == (r["text"] is None)
        assert r["text"] is None or r["restored"] == r["text"]
    assert pieces.tokenise(no_docs).count() == 0


def test_odd_ids(model):
    machine = pieces.Transducer(model)
    assert machine.decode([]) == "" and machine.decode([None, -1, 10**6, 1, 2]) == ""
    byte = machine.bytes_of[0xFF]
    assert machine.decode([byte]) == "�"


def kept_in_workers(spark, n=16):
    """Most words and pairs that any Python worker's transducers hold."""

    def look(batches):
        kept = [len(m.words) + len(m.pairs) for m in sys.__dict__.get("_piece_transducers", {}).values()]
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [max(kept, default=-1)]})

    return [r["n"] for r in spark.range(0, n, 1, n).mapInArrow(look, "n bigint").collect()]


def test_workers_keep_no_caches(spark, docs):
    """A worker goes on to other queries, whose memory its caches would take."""
    assert pieces.tokenise(docs.repartition(8)).where("restored = text").count() > 0
    found = kept_in_workers(spark)
    assert max(found) == 0, found


def test_a_text_is_encoded_once(spark, docs):
    """Ids and the way back come of one call."""
    plan = pieces.tokenise(docs)._jdf.queryExecution().executedPlan().toString()
    calls = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert len(calls) == 1 and "decoded(" not in calls[0] and calls[0].count("coded(text") == 1


def test_arrays_equal_single_texts(spark, model, docs):
    """The dictionary of words and parts gives what each text gives by itself, in any mix, with slices and nulls."""
    machine, alone = pieces.Transducer(model), pieces.Transducer(model)
    texts = [r["text"] for r in docs.collect()][:60] + [None, *ODD, "a\nb.\nC, d", "x", "é\x80\u0100 ߿", "one two", "one\u00a0two"]
    random.Random(5).shuffle(texts)
    for part in (pa.array(texts, pa.string()), pa.array(texts, pa.string())[3:40], pa.array([None, None], pa.string()), pa.array([], pa.string()), pa.array(["  "]), pa.array(["a b"], pa.large_string())):
        ids = machine.encode_array(part)
        assert ids.to_pylist() == [None if t is None else alone.encode(t) for t in part.to_pylist()]
        restored = pieces.decode_array(machine, ids).to_pylist()
        assert restored == [None if t is None else t.replace(pieces.MARK, " ") for t in part.to_pylist()]
    odd = pa.array([None, [], [None, 5], [-1, 10**6], [0, 1, 2], [machine.bytes_of[0xC3], machine.bytes_of[0x0A]], [machine.bytes_of[0x20], 5]], pa.list_(pa.int32()))
    assert pieces.decode_array(machine, odd).to_pylist() == [None if r is None else alone.decode(r) for r in odd.to_pylist()]


def test_each_part_is_searched_once(model):
    """Words that differ in what stands around their letters share a search."""
    machine, searched = pieces.Transducer(model), []
    search = machine.bpe_paths
    machine.bpe_paths = lambda words: (searched.extend(words), search(words))[1]
    text = "qzot\nqzot\nQzotim, qzot\nQzotim qzot\n"
    assert machine.encode_array(pa.array([text, text])).to_pylist() == [pieces.Transducer(model).encode(text)] * 2
    assert len(searched) == len(set(searched)) and all("\n" not in w or w == "\n" for w in searched)


def test_models_without_a_front_mark():
    vocabulary = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -3.5, "ba": -5.0}
    for kind in (pieces.UNIGRAM, pieces.BPE):
        for pieces_of in (list(vocabulary), [*vocabulary, "b▁a"]):
            model = pieces.Model(pieces_of, [*vocabulary.values(), -6.0][: len(pieces_of)], [pieces.NORMAL] * len(pieces_of), kind, front_mark=False)
            for text in ("ab a", "a b ab ba", "b a", " a", "a  b", "ba\nab c"):
                assert pieces.Transducer(model).encode_array(pa.array([text])).to_pylist() == [pieces.Transducer(model).encode(text)]


KEPT_MEMORY = """
import pickle, random, sys
sys.path.insert(0, sys.argv[1])
import pyarrow as pa
from scanforge.llm import pieces
machine = pieces.Transducer(pickle.load(sys.stdin.buffer))
draw = random.Random(5)
texts = ["".join(" " + "".join(draw.choices("abcdefghijklmnoprstuvw", k=draw.randint(4, 9))) for _ in range(200))[1:] for _ in range(600)]
batches = [pa.array(texts[i : i + 200]) for i in range(0, 600, 200)]
del texts
held = lambda: int(open("/proc/self/status").read().split("RssAnon:")[1].split()[0]) / 1024
def task(of):
    before = held()
    for found in pieces.in_task(machine, iter(batches), of):
        assert len(found) == 200
    del found
    return held() - before
print(task(machine.encode_array))
"""


def test_a_task_leaves_no_memory_behind(model):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", KEPT_MEMORY, root], input=pickle.dumps(model), capture_output=True, check=True)
    assert float(out.stdout) < 10
