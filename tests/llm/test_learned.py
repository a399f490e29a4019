import numpy as np
import pytest
from pyspark.sql import functions as F
from scanforge.llm import languages, queries, secrets, toxicity

SF = "/root/testdata/sf0.01"


def test_gradients_equal_differences():
    net = languages.Network.fresh(["a", "b", "c"], 3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, mask = languages.as_bytes([b"one", b"three", b"a", b"abcdefghijkl"])
    label = np.array([0, 1, 2, 1])

    def loss():
        p = net.positions(x, mask)
        return -(np.log(p[:, np.arange(4), label]) * mask.T).sum() / mask.sum()

    got = net.gradients(x, mask, label)
    for name, w in net.weights.items():
        index = np.unravel_index(np.argmax(np.abs(got[name])), w.shape)
        kept, step = w[index], 1e-3
        w[index] = kept + step
        up = loss()
        w[index] = kept - step
        down = loss()
        w[index] = kept
        assert got[name][index] == pytest.approx((up - down) / (2 * step), rel=0.03, abs=1e-4), name


def test_languages_of_held_out_texts(spark):
    rows = queries.op7_language_id(spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_odd_texts_have_no_language(odd_docs, no_docs, docs):
    net = languages.train(docs)
    got = {r["doc_id"]: r for r in languages.predict(odd_docs, net).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5))
    assert got[10]["lang_pred"] in net.languages
    assert languages.predict(no_docs, net).count() == 0
    assert languages.train(no_docs) is None
    assert {r["lang_pred"] for r in languages.predict(odd_docs, None).collect()} == {"und"}


def test_folding():
    assert toxicity.fold("Yоu IDI0T!") == " you idiot "
    assert toxicity.fold("ŚTÚPÍD,m0r0n 12345") == " stupid moron "
    assert toxicity.fold("") == "  "


def test_lexicon_and_exceptions():
    lexicon = toxicity.Lexicon({"clown": 4.0, "clownish": 5.0, "trash": 4.0}, ["trash can", "clown fish"])
    machine = lexicon.machine()
    plain = toxicity.strength(machine, "such a clown here")
    assert plain > 0 and toxicity.strength(machine, "such a сl0wn here") == plain
    assert toxicity.strength(machine, "such a clownish act") > plain
    assert toxicity.strength(machine, "the trash can and a clown fish") == 0
    assert toxicity.strength(machine, "a sunclown") == 0
    assert toxicity.strength(machine, "such a clown " + "here " * 500) < plain


def test_toxicity_of_held_out_texts(spark):
    rows = queries.op8_toxicity(spark, SF).collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(p for p, t in held if not t) == 0
    assert np.mean([p for p, t in held if t]) > 0.75
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_odd_texts_have_a_score(spark, odd_docs, no_docs):
    lexicon = toxicity.train(odd_docs.select("text", F.lit(0).alias("toxic")))
    rows = toxicity.score(odd_docs, lexicon).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] < 0.7 for r in rows)
    empty = toxicity.train(no_docs.select("text", F.lit(1).alias("toxic")))
    assert set(empty.weights) == set(toxicity.KNOWN)
    assert toxicity.score(no_docs, empty).count() == 0


def test_copies_are_sampled_once(spark):
    rows = [("harmless windowsill", 1)] * 50 + [(f"plain text {i}", 0) for i in range(50)]
    labelled = spark.createDataFrame(rows, "text string, toxic int")
    assert toxicity.sample(labelled).where("toxic = 1").count() == 1
    assert set(toxicity.train(labelled).weights) == set(toxicity.KNOWN)
    copies = spark.createDataFrame([("password=abcdefgh12345678 some words here",)] * 50, "text string")
    assert secrets.random_samples(copies).where("value = 'abcdefgh12345678'").count() == 1
    assert secrets.identifier_samples(copies).where("value = 'some'").count() == 1


def test_exception_phrases_end_with_their_words():
    lexicon = toxicity.Lexicon({"idiot": 4.0, "trash": 4.0, "ass ": 3.0, "蠢": 2.0, "蠢货": 5.0}, ["trash can", "idiot proof"])
    machine = lexicon.machine()
    of = lambda text: toxicity.strength(machine, text)
    assert of("two trash cans") == of("an idiot-proof lock") == of("the trash can") == 0
    assert of("you are trash cannot code") > 0 and of("idiot proofreader") > 0 and of("trash can trash") == of("x can trash")
    assert of("what an ass") > 0 == of("assemble the class") and of("ıdıot") == of("idiot")
    assert of("你是蠢货吗") == 5.0 / np.log2(8 + 2) and of("你很蠢") == 2.0 / np.log2(8 + 2)


def test_strength_equals_brute_force():
    draw = np.random.default_rng(4)
    weights = {"clown": 4.0, "clownish": 5.0, "trash": 4.0, "ass ": 3.0, "moron": 2.5}
    phrases = ["trash can", "class clown", "clown fish"]
    machine = toxicity.Lexicon(weights, phrases).machine()
    words = "clown clowns clownish trash can cans class fish ass assembly moron the".split()
    for _ in range(300):
        folded = f" {' '.join(draw.choice(words, draw.integers(1, 12)))} "
        barred = {i for p in phrases for q in (f" {p} ", f" {p}s ") for k in range(len(folded)) if folded.startswith(q, k) for i in range(k, k + len(q) - 1)}
        total = 0.0
        for k in range(len(folded)):
            hits = [(len(w), x) for w, x in weights.items() if folded.startswith(f" {w}", k)]
            total += max(hits)[1] if hits and k not in barred else 0.0
        assert toxicity.strength(machine, folded) == pytest.approx(total / np.log2(8 + folded.count(" ")))


def test_short_words_and_unspaced_scripts_are_learned():
    assert {"bad ", "good", "goodn"} <= toxicity.beginnings("bad goodn") and "蠢货" in toxicity.beginnings("他是蠢货。")


def test_equal_texts_in_different_partitions_score_alike(spark, docs):
    """Predictions of copies that stand in batches of different company."""
    net = languages.train(docs)
    lexicon = toxicity.train(docs.select("text", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    copies = docs.select("text").distinct().crossJoin(spark.range(3).withColumnRenamed("id", "part")).select(F.monotonically_increasing_id().alias("doc_id"), "text", "part").repartition(7, "part")
    for found in (languages.predict(copies, net).select("doc_id", "lang_pred", F.round("score", 5).alias("score")), toxicity.score(copies, lexicon).select("doc_id", F.lit("").alias("lang_pred"), "score")):
        by = {}
        texts = {r["doc_id"]: r["text"] for r in copies.select("doc_id", "text").collect()}
        for r in found.collect():
            by.setdefault(texts[r["doc_id"]], set()).add((r["lang_pred"], r["score"]))
        assert all(len(v) == 1 for v in by.values())
