"""Language identification by a bidirectional gated recurrent network over bytes.

Words with a blank on either side are sequences of bytes (longer runs are cut into pieces of ``STEPS`` bytes). The network
reads a sequence in both directions and gives every position a probability for each language; a text's probabilities are
the mean over all its positions. Equal words of a batch run through the network once and count as often as they stand.

Training is on the driver in numpy, by backpropagation through time with Adam, on a bounded sample: per language the
``SAMPLE_TEXTS`` different texts of least hash among the training rows, and of those ``SAMPLE_WORDS`` words by seeded draw. Every whole
text is predicted.

Defined results: a null text, or one without letters, is ``und`` with score 0; ties go to the language first in order;
with no labelled text every text is ``und``; equal texts get equal results; extra columns stay out; an empty table gives an
empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.llm.common import Scratch, sample_by_hash, text_batches

STEPS = 24
HIDDEN = 12
EMBED = 12
SAMPLE_TEXTS = 300
SAMPLE_WORDS = 6000
TURNS = 700
BATCH = 512
RATE = 0.01
# Sequences that run through the network at a time.
ROWS = 8192
UNKNOWN = "und"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    """Two gated recurrent layers, one for each direction, and an output layer. Gates: update, reset, candidate."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 1) -> Network:
        draw = np.random.default_rng(seed)
        w = {"embed": draw.normal(0, 0.3, (256, EMBED)), "out": draw.normal(0, 0.3, (2 * HIDDEN, len(languages))), "out_b": np.zeros(len(languages))}
        for side in ("f", "b"):
            w[f"{side}_in"] = draw.normal(0, EMBED**-0.5, (EMBED, 3 * HIDDEN))
            w[f"{side}_rec"] = draw.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
            w[f"{side}_b"] = np.zeros(3 * HIDDEN)
        return cls(languages, {k: v.astype(np.float32) for k, v in w.items()})

    def run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States (steps, rows, HIDDEN) of one direction; a padded position keeps the state. ``x``: bytes (rows, steps)."""
        w, h, steps = self.weights, HIDDEN, x.shape[1]
        table = w["embed"] @ w[f"{side}_in"] + w[f"{side}_b"]
        rec = w[f"{side}_rec"]
        state = np.zeros((len(x), h), np.float32)
        states, tape = np.empty((steps, len(x), h), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            given = table[x[:, t]]
            gates = sigmoid(given[:, : 2 * h] + state @ rec[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            candidate = np.tanh(given[:, 2 * h :] + (reset * state) @ rec[:, 2 * h :])
            step = update * mask[:, t, None]
            if keep:
                tape.append((t, state, update, reset, candidate))
            state = state + step * (candidate - state)
            states[t] = state
        return states, tape

    def positions(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probabilities (steps, rows, languages)."""
        both = np.concatenate([self.run(side, x, mask, False)[0] for side in ("f", "b")], 2)
        scores = both @ self.weights["out"] + self.weights["out_b"]
        scores = np.exp(scores - scores.max(2, keepdims=True))
        return scores / scores.sum(2, keepdims=True)

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all positions."""
        w, h = self.weights, HIDDEN
        runs = {side: self.run(side, x, mask, True) for side in ("f", "b")}
        both = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        scores = both @ w["out"] + w["out_b"]
        scores = np.exp(scores - scores.max(2, keepdims=True))
        error = scores / scores.sum(2, keepdims=True)
        error[:, np.arange(len(x)), label] -= 1
        error *= mask.T[:, :, None] / mask.sum()
        grads = {"out": np.einsum("trh,trl->hl", both, error), "out_b": error.sum((0, 1)), "embed": np.zeros_like(w["embed"])}
        back = error @ w["out"].T
        for side, part in (("f", back[:, :, :h]), ("b", back[:, :, h:])):
            rec, given = w[f"{side}_rec"], w[f"{side}_in"]
            d_rec, d_table, d_state = np.zeros_like(rec), np.zeros((256, 3 * h), np.float32), np.zeros((len(x), h), np.float32)
            for t, state, update, reset, candidate in reversed(runs[side][1]):
                d_next = d_state + part[t]
                m = mask[:, t, None]
                d_candidate = d_next * update * m * (1 - candidate**2)
                d_update = d_next * (candidate - state) * m * update * (1 - update)
                d_inner = d_candidate @ rec[:, 2 * h :].T
                d_reset = d_inner * state * reset * (1 - reset)
                d_gates = np.concatenate([d_update, d_reset], 1)
                d_state = d_next * (1 - update * m) + d_inner * reset + d_gates @ rec[:, : 2 * h].T
                d_rec[:, : 2 * h] += state.T @ d_gates
                d_rec[:, 2 * h :] += (reset * state).T @ d_candidate
                np.add.at(d_table, x[:, t], np.concatenate([d_gates, d_candidate], 1))
            grads[f"{side}_rec"], grads[f"{side}_b"] = d_rec, d_table.sum(0)
            grads[f"{side}_in"] = w["embed"].T @ d_table
            grads["embed"] += d_table @ given.T
        return grads


def as_bytes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (rows, steps) and mask of words, each with a blank on either side where there is room."""
    x, mask = np.full((len(words), STEPS), 32, np.uint8), np.zeros((len(words), STEPS), np.float32)
    for i, word in enumerate(words):
        part = (b" " + word + b" ")[:STEPS]
        x[i, : len(part)] = np.frombuffer(part, np.uint8)
        mask[i, : len(part)] = 1
    return x, mask


def cut(text: bytes) -> list[bytes]:
    """Words of a text; longer runs in pieces."""
    size, out = STEPS - 2, []
    for word in text.split():
        if len(word) <= size:
            out.append(word)
        else:
            out += [word[i : i + size] for i in range(0, len(word), size)]
    return out


def fit(words: list[bytes], labels: list[int], languages: list[str], seed: int = 1) -> Network:
    net, draw = Network.fresh(languages, seed), np.random.default_rng(seed)
    x, mask = as_bytes(words)
    label = np.array(labels)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for turn in range(1, TURNS + 1):
        rows = draw.integers(0, len(x), BATCH)
        width = int(mask[rows].sum(1).max())
        rate = RATE * (1 - turn / (TURNS + 1)) + 1e-4
        for k, g in net.gradients(x[rows, :width], mask[rows, :width], label[rows]).items():
            g = np.clip(g, -1, 1)
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            scale = rate * np.sqrt(1 - 0.99**turn) / (1 - 0.9**turn)
            net.weights[k] -= scale * first[k] / (np.sqrt(second[k]) + 1e-8)
    return net


def train(docs: DataFrame) -> Network | None:
    """``docs``: text and lang of the rows that may be learned from."""
    scratch = Scratch(docs.sparkSession)
    chosen = sample_by_hash(docs.select("lang", "text"), "lang", "text", SAMPLE_TEXTS, scratch)
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for r in chosen.select("lang", "h", F.col("text").cast("binary").alias("t")).collect():
        texts.setdefault(r["lang"], []).append((r["h"], bytes(r["t"])))
    scratch.drop("hashes", "hashes_last")
    words, labels, languages = [], [], sorted(lang for lang, some in texts.items() if any(cut(t) for _, t in some))
    draw = np.random.default_rng(1)
    for i, lang in enumerate(languages):
        own = [w for _, t in sorted(texts[lang]) for w in cut(t)]
        words += [own[k] for k in draw.integers(0, len(own), SAMPLE_WORDS)]
        labels += [i] * SAMPLE_WORDS
    return fit(words, labels, languages) if words else None


def pooled(net: Network, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities over all positions of each text, and whether it has a letter."""
    ids: dict[bytes, int] = {}
    rows = [[ids.setdefault(w, len(ids)) for w in cut(t)] if t else [] for t in texts]
    words = sorted(ids, key=len)
    sums, counts = np.zeros((len(ids), len(net.languages))), np.zeros(len(ids))
    for i in range(0, len(words), ROWS):
        part = words[i : i + ROWS]
        x, mask = as_bytes(part)
        width = int(mask.sum(1).max())
        x, mask = x[:, :width], mask[:, :width]
        at = [ids[w] for w in part]
        sums[at] = np.einsum("trl,rt->rl", net.positions(x, mask), mask)
        counts[at] = mask.sum(1)
    out = np.zeros((len(texts), len(net.languages)))
    for i, row in enumerate(rows):
        if row:
            out[i] = sums[row].sum(0) / counts[row].sum()
    return out, np.array([bool(t) and any(c.isalpha() for c in t.decode("utf-8", "replace")) for t in texts], bool)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of each row of ``docs`` (doc_id, text)."""
    text_batches(docs.sparkSession)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        if net is None:
            named, scores = [UNKNOWN] * len(rows), [0.0] * len(rows)
        else:
            p, letters = pooled(net, rows)
            named = [net.languages[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1), letters)]
            scores = np.where(letters, p.max(1), 0.0).clip(0, 1)
        return pa.StructArray.from_arrays([pa.array(named, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return docs.select("doc_id", predicted(F.col("text").cast("binary")).alias("p")).select("doc_id", "p.*")
