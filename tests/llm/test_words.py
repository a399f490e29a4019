import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from scanforge.llm import collocations, passages, queries, variants
from scanforge.llm.common import Scratch, least_hashes

from llm import brute

SF = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def same_variants(got, want):
    order = lambda rows: sorted(rows, key=lambda r: r[0])
    assert order(tuple(r) for r in got.collect()) == order(want)


# Phrases.


@pytest.fixture
def frequent(monkeypatch):
    """Thresholds for small texts; blocks and tiles of a few words."""
    monkeypatch.setattr(collocations, "MIN_COUNT", 3)
    monkeypatch.setattr(collocations, "TOP", 40)


def text_of(seed, n):
    draw = random.Random(seed)
    words = "new york city of the In\tand Straße été 日本 x".split(" ") + ["new york city of"] * 2
    return "".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\t", "\x0b"]) for _ in range(n))


def test_phrases_equal_brute_force(spark, frequent):
    rows = [(draw, text_of(i, 300)) for i, draw in enumerate(["en", "fr", None, "en", "und"])] + [("en", None), ("en", ""), ("en", " .\n"), ("en", text_of(0, 300)), (None, "a\x85b a\x85b  a\x85b  a\x85b ")]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string").withColumn("score", F.lit("x"))
    want = brute.collocations(rows, 3, 40)
    assert len(want) > 20 and any(r[1] == 40 for r in want)
    assert rows_of(collocations.collocations(docs)) == want


def test_odd_phrases(spark, frequent, odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(collocations.collocations(odd_docs.where("doc_id is null or doc_id <> 8"))) == brute.collocations([x for x in rows if len(x[1] or "") < 100_000 or "x" in x[1][:2]], 3, 40)
    assert collocations.collocations(no_docs).count() == 0
    assert collocations.collocations(odd_docs.where("text is null")).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    totals = spark.createDataFrame([("en", 30_000_000_000_000)], "lang string, n bigint")
    found = spark.createDataFrame([("en", 1, "a", 4_000_000_000_000), ("en", 1, "b", 3_000_000_000_001), ("en", 2, "a b", 1_999_999_999_999)], "lang string, n_words int, phrase string, f bigint")
    monkeypatch.setattr(collocations, "count_phrases", lambda docs, scratch: (totals, found))
    want = 1000 * 1_999_999_999_999 * 30_000_000_000_000 // (4_000_000_000_000 * 3_000_000_000_001)
    assert rows_of(collocations.collocations(found)) == [("en", 1, "a b", 1_999_999_999_999, 4_000_000_000_000, 3_000_000_000_001, 30_000_000_000_000, want)]


@pytest.mark.parametrize("tile, side, at_once", [(256, 1024, 32), (4, 2, 1), (4, 8, 2), (2, 1, 32)])
def test_dense_and_sparse_tiles_count_alike(monkeypatch, tile, side, at_once):
    monkeypatch.setattr(collocations, "TILE", tile)
    monkeypatch.setattr(collocations, "SIDE", side)
    monkeypatch.setattr(collocations, "TILES_AT_ONCE", at_once)
    for dense in (1, 20, 10**9):
        monkeypatch.setattr(collocations, "DENSE", dense)
        draw = np.random.default_rng(tile)
        left, right = (np.minimum(draw.geometric(0.1, 3000) - 1, 60) for _ in range(2))
        keys, counts = collocations.count_pairs(left, right, 61)
        want = np.unique(left * 61 + right, return_counts=True)
        assert np.array_equal(keys, want[0]) and np.array_equal(counts, want[1])
    keys, counts = collocations.count_pairs(left[:0], right[:0], 1)
    assert len(keys) == len(counts) == 0


def test_a_full_filter_changes_nothing(spark, frequent, monkeypatch):
    rows = [("en", text_of(i, 200)) for i in range(3)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "filter_of", lambda frequent: np.full(collocations.FILTER_BITS // 64, 2**64 - 1, np.uint64))
    assert rows_of(collocations.collocations(docs)) == brute.collocations(rows, 3, 40)


def test_rare_pairs_stay_unnamed(monkeypatch):
    """Sums by hash over all blocks keep each frequent pair, and pairs of frequent words that are rare leave no block by name."""
    import pyarrow as pa

    monkeypatch.setattr(collocations, "BLOCK_WORDS", 60)
    monkeypatch.setattr(collocations, "MERGED", 200)
    draw = random.Random(4)
    texts = [" ".join(draw.choice(["new york"] + [f"w{k}" for k in range(30)]) for _ in range(40)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 60), pa.array(texts)], ["lang", "text"])
    blocks, least = list(collocations.encode_blocks(iter([batch]))), 20
    assert len(blocks) > 10
    words, pairs = {}, {}
    for t in texts:
        t = t.split(" ")
        for w in t:
            words[w] = words.get(w, 0) + 1
        for w in zip(t, t[1:]):
            pairs[" ".join(w)] = pairs.get(" ".join(w), 0) + 1
    assert min(words.values()) >= least and sum(n < least for n in pairs.values()) > 500

    class Shared:
        value = np.full(collocations.FILTER_BITS // 64, 2**64 - 1, np.uint64)

    rows = list(collocations.pair_hashes(Shared, least)(iter(blocks)))
    rows = pa.Table.from_batches(rows).combine_chunks()
    assert len(rows) > len(set(rows["part"].to_pylist()))
    hashes = [collocations.frequent_hashes(least)(rows.take(pa.array(np.flatnonzero(rows["part"].to_numpy() == part))))["hash"].to_numpy() for part in set(rows["part"].to_pylist())]
    hashes = np.concatenate(hashes).view(np.uint64)
    assert len(hashes) == sum(n >= least for n in pairs.values())

    class Pairs:
        value = np.zeros(collocations.FILTER_BITS // 64, np.uint64)

    for shift in (collocations.SPARE_BITS, 38):
        at = (hashes >> np.uint64(shift)) & np.uint64(collocations.FILTER_BITS - 1)
        np.bitwise_or.at(Pairs.value, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    named = {}
    for b in collocations.counter([Shared, Pairs], (2, 3), 3)(iter(blocks)):
        for n_words, phrase, n in zip(*(b.column(c).to_pylist() for c in ("n_words", "phrase", "n"))):
            if n_words == 2:
                named[phrase] = named.get(phrase, 0) + n
    assert named == {p: n for p, n in pairs.items() if n >= least}


def test_blocks_split_texts_alike(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 50)
    import pyarrow as pa
    import scanforge.llm.common as common

    monkeypatch.setattr(common, "SLICE", 7)
    texts = [text_of(i, 40) for i in range(9)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 9), pa.array(texts)], ["lang", "text"])
    blocks = list(collocations.encode_blocks(iter([batch])))
    assert len(blocks) > 2
    counts = {}
    for b in blocks:
        for w, n in zip(b.column("words")[0].as_py(), b.column("counts")[0].as_py()):
            counts[w] = counts.get(w, 0) + n
    want = {}
    for t in texts:
        for w in brute.re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", t.translate(brute.CAPITALS)):
            want[w] = want.get(w, 0) + 1
    assert counts == want


# Variants.


def test_variants_equal_brute_force(spark):
    draw = random.Random(3)
    stems = ["harbour", "signal", "garden", "étééènuit", "Straße", "night", "aaaaaa", "ababab", "stone"]
    letters = "abehnotéß"

    def edited(w):
        i = draw.randrange(len(w))
        return draw.choice([w, w[:i] + w[i + 1 :], w[:i] + draw.choice(letters) + w[i:], w[:i] + draw.choice(letters) + w[i + 1 :]])

    rows = [(i, " ".join(draw.choice(["", "", "-", "9"]).join([edited(edited(draw.choice(stems)))]) for _ in range(900))) for i in range(6)]
    rows += [(None, "HARBOUR harbour harbour"), (7, None), (8, ""), (8, "signal signal"), (8, "signal signal")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("word", F.lit("x"))
    words = brute.variant_words(rows)
    want = brute.variants(words)
    assert len(want) > 100 and any(r[1] and r[1] != r[2] for r in want)
    same_variants(variants.variants(docs), want)


def test_hot_chunks_are_dealt_in_squares(spark, monkeypatch):
    monkeypatch.setattr(variants, "SIDE", 3)
    words = {"prefix" + a + b: 3 + i for i, (a, b) in enumerate((a, b) for a in "abcdefg" for b in "abcdefgh")} | {"prefixa": 500}
    got = variants.near_words(spark.createDataFrame(list(words.items()), "word string, n bigint"))
    want = sorted((w, n, v, words[v]) for w, n in words.items() for v in words if brute.one_edit(w, v))
    assert rows_of(got) == want


def test_odd_variants(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    same_variants(variants.variants(odd_docs), brute.variants(brute.variant_words(rows)))
    assert variants.variants(no_docs).count() == 0
    # A deletion may leave a word too short, and a chain of forms has an end.
    chain = {"abcde" + "f" * k: 3 * 2**k for k in range(9)}
    words = spark.createDataFrame([(1, " ".join(" ".join([w] * n) for w, n in chain.items()))], "doc_id bigint, text string")
    same_variants(variants.variants(words), brute.variants(brute.variant_words([(1, " ".join(" ".join([w] * n) for w, n in chain.items()))])))


def test_a_word_of_any_length(spark):
    long = "".join(random.Random(5).choice("abcdefgh") for _ in range(50_000))
    docs = spark.createDataFrame([(1, f"{long} {long} {long} {long} {long[:-1]} {long[:-1]} {long[:-1]}")], "doc_id bigint, text string")
    assert {r["n_near"] for r in variants.variants(docs).collect()} == {1}


# Passages.


def sample(seed=1, n=40):
    draw = random.Random(seed)
    word = lambda: draw.choice(["the", "of", "river", "stone", "Night", "garden."])
    out = []
    for i in range(n):
        good = [" ".join(word() for _ in range(70)) for _ in range(3)]
        bad = [" ".join(word().upper() + "!!" for _ in range(70)) if k == i % 3 else g for k, g in enumerate(good)]
        out += [(1, passages.spread_passages("\n".join(good))), (0, passages.spread_passages("\n".join(bad)))]
    return out


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(passages, "TURNS", 3)
    kept = {}
    real = passages.loss_and_gradients

    def held(model, bags, chosen):
        kept["bags"] = bags
        return real(model, bags, chosen)

    monkeypatch.setattr(passages, "loss_and_gradients", held)
    model = passages.fit(sample())
    bags, chosen = kept["bags"], np.arange(0, 20)
    _, grads = real(model, bags, chosen)
    for name, w in model.weights.items():
        index = np.unravel_index(np.argmax(np.abs(grads[name])), w.shape)
        old, step = w[index], 1e-5
        w[index] = old + step
        up, _ = real(model, bags, chosen)
        w[index] = old - step
        down, _ = real(model, bags, chosen)
        w[index] = old
        assert grads[name][index] == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-8), name


def test_attention_finds_the_bad_passage():
    model = passages.fit(sample())
    good, bad = "the river of stone garden. " * 120, "THE!! RIVER!! OF!! STONE!! " * 20
    ids = passages.Ids()
    codes = [passages.codes_of(t, ids) for t in (good, good + bad + good, bad)]
    table = model.table(list(ids))
    scores = [model.score(c, table) for c in codes]
    assert scores[0] > 0.5 > scores[1] and scores[2] < 0.5
    e, _, _ = model.attend(model.encode(codes[1], table))
    assert 100 * 5 // passages.WIDTH <= np.argmax(e) <= 160 * 5 // passages.WIDTH + 1
    # The training form and the scoring form of a text agree.
    text = "the river OF!! stone"
    ids = passages.Ids()
    c = passages.codes_of(text, ids)
    kinds = [passages.seen_in(w.decode()) for w in ids]
    assert kinds[2][0] == "A!" and model.score(c, model.table(list(ids))) == model.score(c, model.table(list(ids)))


def test_long_texts_in_parts_equal_whole(monkeypatch):
    model = passages.fit(sample())
    ids = passages.Ids()
    codes = passages.codes_of(text_of(4, 3000), ids)
    table = model.table(list(ids))
    whole = model.encode(codes, table)
    monkeypatch.setattr(passages, "WORDS_AT_ONCE", passages.WIDTH * 3)
    assert np.array_equal(whole, model.encode(codes, table)) and len(whole) == -(-len(codes) // passages.WIDTH)


def test_quality_of_held_out_texts(spark):
    rows = queries.op13_quality_classifier(spark, SF).collect()
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert np.mean([p == t for p, t in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_odd_texts_have_a_quality(spark, odd_docs, no_docs, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    odd_labels = labels.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (1, None), (2, 5), (10**9, 0)], "doc_id bigint, quality int"))
    model = passages.train(docs, odd_labels.union(odd_labels))
    rows = passages.score(odd_docs.repartition(5, "doc_id"), model).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert by[3] == by[4] == by[5] and by[1] == by[2] and by[1] <= by[None]
    assert passages.score(no_docs, model).count() == 0
    assert passages.train(no_docs, odd_labels) is None and passages.train(docs, labels.where("quality = 1")) is None
    assert {r["score"] for r in passages.score(odd_docs, None).collect()} == {0.5}


def test_least_hashes(spark):
    rows = spark.range(30_000).select((F.col("id") % 3).alias("g"), F.xxhash64(F.col("id") % 5000).alias("h")).union(spark.createDataFrame([(None, 1), (7, 5)], "g bigint, h bigint"))
    got = {}
    for r in least_hashes(rows, "g", 100, Scratch(spark)).collect():
        got.setdefault(r["g"], []).append(r["h"])
    every = {}
    for r in rows.collect():
        every.setdefault(r["g"], set()).add(r["h"])
    assert {g: sorted(h) for g, h in got.items()} == {g: sorted(h)[:100] for g, h in every.items() if g is not None}
