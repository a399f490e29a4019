"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``WIDTH`` words, all of them. A passage is encoded from the words and word shapes in it
(learned embeddings of those that the training sample knows, averaged) and from a few measures (lengths, capitals, signs, digits, repetition
within the passage and within the document) by a layer of tanh units. Gated attention gives each passage a weight; the
weighted mean of the encodings is the document's, and a logistic unit scores it. Labels exist for documents only; which passages
speak for the label is learned through the attention.

Training is on the driver in numpy, by backpropagation with Adam, on a bounded sample: of either label the ``TEXTS`` different
texts of least hash, and of each at most ``PASSAGES`` passages, evenly spread. Scoring reads every passage of every whole text.

Defined results: a null text, an empty one or one of blanks is one passage without words and gets that passage's score; without texts of
both labels every score is 0.5; equal texts get equal scores; labels without a text or other than 0 and 1 are left out; extra
columns stay out; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.llm.common import Scratch, labelled_sample, slices, text_batches

WIDTH = 48
TEXTS = 1500
PASSAGES = 24
# Known words and shapes: the commonest of those in at least MIN_TEXTS texts of the sample.
WORDS, SHAPES, MIN_TEXTS = 1000, 500, 10
HIDDEN, GATES = 16, 8
MEASURES = 9
TURNS, BATCH, RATE, DECAY = 400, 64, 0.01, 1e-4
REPEAT = 4
# Words of a text whose features are held at a time.
WORDS_AT_ONCE = WIDTH * 4096
# Different words that a task remembers between batches.
HELD = 300_000


class Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self)
        return new


def codes_of(text: str | None, ids: Ids) -> np.ndarray:
    """Ids of a text's words."""
    parts = [np.fromiter(map(ids.__getitem__, words), np.int64, len(words)) for words in (s.split() for s in slices((text or "").encode()))]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


class Kinds(dict):
    """Character table for str.translate: A a 0 for capitals, other letters and digits; signs stay."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "0" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else "*" if c.isalnum() else c
        return out


KINDS = Kinds()
RUNS = re.compile(r"(.)\1+", re.DOTALL)


def seen_in(word: str) -> tuple[str, tuple[float, float, float, float]]:
    """A word's shape (kinds of characters in order, runs as one) and its measures: length, shares of capitals, signs and digits."""
    kinds, n = word.translate(KINDS), max(1, len(word))
    capitals, digits = kinds.count("A"), kinds.count("0")
    return RUNS.sub(r"\1", kinds), (math.log1p(n) / 2, capitals / n, (n - capitals - digits - kinds.count("a")) / n, digits / n)


def starts_of(n: int) -> np.ndarray:
    return np.arange(0, max(1, n), WIDTH)


def repetition(codes: np.ndarray) -> np.ndarray:
    """Of each passage the share of words equal to the one before, of different words, and of words in runs of REPEAT words that the text has twice."""
    n, starts = len(codes), starts_of(len(codes))
    if not n:
        return np.zeros((1, 3))
    size = np.diff(np.append(starts, n))
    stutter = np.concatenate([[0.0], codes[1:] == codes[:-1]])
    inside = np.repeat(np.arange(len(starts)), size)
    order = np.lexsort((codes, inside))
    fresh = np.ones(n)
    fresh[1:] = (codes[order][1:] != codes[order][:-1]) | (inside[order][1:] != inside[order][:-1])
    again = np.zeros(n)
    if n >= REPEAT:
        windows = np.zeros(n - REPEAT + 1, np.uint64)
        for k in range(REPEAT):
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + codes[k : n - REPEAT + 1 + k].astype(np.uint64)
        _, back, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = (times[back] > 1).astype(float)
        for k in range(REPEAT):
            again[k : n - REPEAT + 1 + k] = np.maximum(again[k : n - REPEAT + 1 + k], twice)
    return np.stack([np.add.reduceat(x, starts) / size for x in (stutter, fresh, again)], 1)


@dataclass
class Model:
    """Rows of known words and shapes (others share row 0) and the network's weights."""

    words: dict[str, int]
    shapes: dict[str, int]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, words: list[str], shapes: list[str], seed: int = 1) -> Model:
        draw = np.random.default_rng(seed)
        size = {"embed": (1 + len(words) + len(shapes), HIDDEN), "dense": (MEASURES, HIDDEN), "bias": (HIDDEN,), "v": (HIDDEN, GATES), "u": (HIDDEN, GATES), "w": (GATES,), "out": (HIDDEN,), "out_b": (1,)}
        weights = {k: draw.normal(0, 0.3, s) if k not in ("bias", "out_b") else np.zeros(s) for k, s in size.items()}
        weights["embed"][0] = 0
        return cls({w: 1 + i for i, w in enumerate(words)}, {s: 1 + len(words) + i for i, s in enumerate(shapes)}, weights)

    def table(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to its passage's tanh units: its embeddings, and its measures weighted."""
        text = [w.decode() for w in words]
        seen = [seen_in(w) for w in text]
        rows = np.array([[self.words.get(w.lower(), 0), self.shapes.get(kinds, 0)] for w, (kinds, _) in zip(text, seen)], np.int64).reshape(-1, 2)
        return self.weights["embed"][rows].sum(1) + np.array([m for _, m in seen]).reshape(-1, 4) @ self.weights["dense"][:4]

    def attend(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Attention before the softmax, and both gates."""
        t, s = np.tanh(h @ self.weights["v"]), 1 / (1 + np.exp(-np.clip(h @ self.weights["u"], -30, 30)))
        return (t * s) @ self.weights["w"], t, s

    def encode(self, codes: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Encodings (passages, HIDDEN) of a text."""
        n, sums = len(codes), []
        for i in range(0, n, WORDS_AT_ONCE):
            part = codes[i : i + WORDS_AT_ONCE]
            sums.append(np.add.reduceat(table[part], starts_of(len(part))) / np.diff(np.append(starts_of(len(part)), len(part)))[:, None])
        mean = np.concatenate(sums) if sums else np.zeros((1, HIDDEN))
        size = np.diff(np.append(starts_of(n), n))
        return np.tanh(mean + of_passage(repetition(codes), size) @ self.weights["dense"][4:] + self.weights["bias"])

    def score(self, codes: np.ndarray, table: np.ndarray) -> float:
        h = self.encode(codes, table)
        e, _, _ = self.attend(h)
        a = np.exp(e - e.max())
        logit = (a / a.sum()) @ h @ self.weights["out"] + self.weights["out_b"][0]
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def of_passage(repeated: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The measures that aren't means over words: three of repetition, the length, and whether there is a word."""
    return np.column_stack([repeated, np.log1p(size) / 4, size > 0])


@dataclass
class Bags:
    """Passages of the sample: bag of each, counts of embedding rows per word, measures; labels of the bags."""

    bag: np.ndarray
    rows: list[np.ndarray]
    measures: np.ndarray
    label: np.ndarray


def loss_and_gradients(model: Model, bags: Bags, chosen: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of the chosen bags, and its gradients. The passages of a bag are together."""
    w = model.weights
    at = np.concatenate([np.arange(*np.searchsorted(bags.bag, [b, b + 1])) for b in chosen])
    size = np.array([np.searchsorted(bags.bag, b + 1) - np.searchsorted(bags.bag, b) for b in chosen])
    starts, of = np.append(0, np.cumsum(size)[:-1]), np.repeat(np.arange(len(chosen)), size)
    width = len(w["embed"])
    n_rows = np.array([len(bags.rows[i]) for i in at])
    flat = np.concatenate([bags.rows[i] for i in at]) + np.repeat(np.arange(len(at)) * width, n_rows)
    # Two rows a word, so a passage's mean over words divides by half of them.
    x = np.bincount(flat, minlength=len(at) * width).reshape(len(at), width) / np.maximum(n_rows / 2, 1)[:, None]
    x[:, 0] = 0
    h = np.tanh(x @ w["embed"] + bags.measures[at] @ w["dense"] + w["bias"])
    e, t, s = model.attend(h)
    a = np.exp(e - np.maximum.reduceat(e, starts)[of])
    a /= np.add.reduceat(a, starts)[of]
    z = np.add.reduceat(a[:, None] * h, starts)
    y = bags.label[chosen]
    logit = z @ w["out"] + w["out_b"][0]
    p = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
    loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
    d_logit = (p - y) / len(y)
    d_z = d_logit[:, None] * w["out"]
    d_a = (d_z[of] * h).sum(1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, starts)[of])
    d_g = d_e[:, None] * w["w"]
    d_v, d_u = d_g * s * (1 - t * t), d_g * t * s * (1 - s)
    d_h = a[:, None] * d_z[of] + d_v @ w["v"].T + d_u @ w["u"].T
    d_pre = d_h * (1 - h * h)
    grads = {"embed": x.T @ d_pre, "dense": bags.measures[at].T @ d_pre, "bias": d_pre.sum(0), "v": h.T @ d_v, "u": h.T @ d_u}
    return loss, grads | {"w": (t * s).T @ d_e, "out": z.T @ d_logit, "out_b": np.array([d_logit.sum()])}


def fit(sample: list[tuple[int, list[tuple[str, list[float]]]]], seed: int = 1) -> Model | None:
    """``sample``: label and passages (words between blanks, measures of repetition) of each text."""
    if {label for label, _ in sample} != {0, 1}:
        return None
    split = [(label, [(p.split(" ") if p else [], m) for p, m in passages]) for label, passages in sample]
    common = []
    for kind, most in ((str.lower, WORDS), (lambda w: seen_in(w)[0], SHAPES)):
        held = Counter(f for _, passages in split for f in {kind(word) for words, _ in passages for word in words})
        common.append([f for f, n in sorted(held.items(), key=lambda x: (-x[1], x[0])) if n >= MIN_TEXTS][:most])
    model = Model.fresh(*common, seed)
    seen: dict[str, tuple] = {}
    rows, measures, bag = [], [], []
    for i, (_, passages) in enumerate(split):
        for words, repeated in passages:
            for word in words:
                if word not in seen:
                    kinds, own = seen_in(word)
                    seen[word] = (model.words.get(word.lower(), 0), model.shapes.get(kinds, 0), own)
            rows.append(np.array([r for word in words for r in seen[word][:2]], np.int64))
            mean = np.mean([seen[word][2] for word in words], 0) if words else np.zeros(4)
            measures.append(np.concatenate([mean, of_passage(np.array([repeated]), np.array([len(words)]))[0]]))
            bag.append(i)
    bags = Bags(np.array(bag), rows, np.array(measures), np.array([label for label, _ in sample], float))
    draw = np.random.default_rng(seed)
    by_label = [np.flatnonzero(bags.label == k) for k in (0, 1)]
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for turn in range(1, TURNS + 1):
        # Both labels count alike.
        chosen = np.sort(np.concatenate([draw.choice(some, BATCH // 2) for some in by_label]))
        _, grads = loss_and_gradients(model, bags, chosen)
        rate = RATE * (1 - turn / (TURNS + 1)) * np.sqrt(1 - 0.99**turn) / (1 - 0.9**turn)
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            model.weights[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8) + DECAY * model.weights[k]
    return model


def spread_passages(text: str) -> list[tuple[str, list[float]]]:
    """At most PASSAGES of a text's passages, evenly spread, with their measures of repetition."""
    ids = Ids()
    codes = codes_of(text, ids)
    words, repeated, starts = list(ids), repetition(codes), starts_of(len(codes))
    picked = np.unique(np.linspace(0, len(starts) - 1, min(PASSAGES, len(starts))).astype(int))
    return [(b" ".join(words[c] for c in codes[starts[i] : starts[i] + WIDTH]).decode(), repeated[i].tolist()) for i in picked]


def train(docs: DataFrame, labels: DataFrame, seed: int = 1) -> Model | None:
    """``docs``: doc_id and text; ``labels``: doc_id and quality (0 or 1) of the rows that may be learned from."""
    spark = docs.sparkSession
    text_batches(spark)
    scratch = Scratch(spark)
    @F.arrow_udf("array<struct<words:string,repeated:array<double>>>")
    def passages(texts: pa.Array) -> pa.Array:
        rows = [[{"words": w, "repeated": r} for w, r in spread_passages(t)] for t in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("words", pa.string()), ("repeated", pa.list_(pa.float64()))])))

    chosen = labelled_sample(docs, labels, "quality", {0: TEXTS, 1: TEXTS}, scratch)
    rows = chosen.select("quality", "h", passages("text").alias("p")).collect()
    scratch.drop("keyed", "chosen", "hashes_0", "hashes_1")
    sample = [(r["quality"], [(p["words"], p["repeated"]) for p in r["p"]]) for r in sorted(rows, key=lambda r: (r["h"], r["quality"]))]
    return fit(sample, seed)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    text_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        ids, table = Ids(), np.empty((0, HIDDEN))
        for some in texts:
            if own is None:
                yield pa.array([0.5] * len(some), pa.float64())
                continue
            if len(ids) > HELD:
                ids, table = Ids(), np.empty((0, HIDDEN))
            codes = [codes_of(t, ids) for t in some.to_pylist()]
            table = np.concatenate([table, own.table(list(islice(ids, len(table), None)))])
            yield pa.array([own.score(c, table) for c in codes], pa.float64())

    return docs.select("doc_id", scored("text").alias("score"))
