"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

Texts are folded first: compatibility forms and look-alike letters to Latin ones, digits and signs that stand for letters, accents and
case. The lexicon holds beginnings of words (of ``SHORTEST`` to ``LONGEST`` letters), shorter words as a whole, and runs of letters of scripts without blanks, with
weights learned from labelled texts (log odds of standing in a toxic text), over a short list of known insults. Matches within an
exception phrase, whole or in the plural, don't count. The sum of weights is divided by the
logarithm of the text's length, and a logistic curve fitted to the labelled texts makes it a score.

Learning is on bounded samples of different texts, those of least hash: at most ``TOXIC_TEXTS`` toxic and ``CLEAN_TEXTS`` other texts,
and of both together ``CURVE_TEXTS`` for the curve. The lexicon has at most ``ENTRIES`` entries. Every whole text is scored.

Defined results: a null or empty text has no match, and so the score of the curve at 0; without labels the known insults and a
fixed curve decide; equal texts get equal results; rows of labels without a text are left out; extra columns stay out; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.llm.common import Scratch, labelled_sample, sample_by_hash, text_batches

TOXIC_TEXTS = 6000
CLEAN_TEXTS = 12000
SIZES = {1: TOXIC_TEXTS, 0: CLEAN_TEXTS}
CURVE_TEXTS = 4000
ENTRIES = 5000
# Letters of a beginning; shorter words are entries as a whole, and longer words are known by their beginning.
SHORTEST, LONGEST = 4, 10
# Scripts without blanks between words (Thai to Khmer, kana, Han), and lengths of their entries.
UNSPACED = [("\u0e00", "\u0eff"), ("\u1000", "\u109f"), ("\u1780", "\u17ff"), ("\u3040", "\u30ff"), ("\u3400", "\u9fff")]
GRAMS = range(1, 5)
MIN_TEXTS = 4
# An entry stands in toxic texts at least this many times as often (log odds), with this much certainty.
MIN_WEIGHT = 2.5
MIN_SURE = 3.0
KNOWN_WEIGHT = 4.0

# English insults that the lexicon starts from, and phrases in which they are meant otherwise.
KNOWN = "idiot moron stupid loser scum trash pathetic worthless disgusting clown imbecile".split()
EXCEPTIONS = ["trash can", "trash bin", "trash collection", "clown fish", "clownfish", "idiot proof", "class clown", "pond scum", "sympathetic"]
# Look-alike letters, and digits and signs that stand for letters.
LOOKALIKES = dict(zip("аеорсухіјѕкмтнвԁɡӏαεορυικντıłøđƒɑɪʀʏɴʟʙɢʜßæœþħŧŋ", "aeopcyxijskmthbdglaeopuikvtilodfairynlbghsaophtn"))
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


class Folder(dict):
    """Character table for str.translate, filled as characters are seen. Anything but letters becomes a blank."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        char = unicodedata.normalize("NFKD", LOOKALIKES.get(char.lower(), char)).lower()
        char = "".join(LEET.get(c, LOOKALIKES.get(c, c)) for c in char if not unicodedata.combining(c))
        out = "".join(c if c.isalpha() else " " for c in char) or ("" if unicodedata.combining(chr(code)) else " ")
        self[code] = out
        return out


FOLDER = Folder()


def fold(text: str) -> str:
    """Folded words between single blanks, with one in front and one behind. A run of digits only isn't a word."""
    kept = " ".join(w for w in text.split() if not w.isdigit()) if any(c.isdigit() for c in text) else text
    return f" {' '.join(kept.translate(FOLDER).split())} "


def unspaced(char: str) -> bool:
    """Whether a letter belongs to a script that is written without blanks between words."""
    return any(lo <= char <= hi for lo, hi in UNSPACED)


def key_of(entry: str) -> str:
    """What is looked for in a folded text: the beginning of a word, a whole word (an entry that ends with a blank), or letters anywhere."""
    return entry if unspaced(entry[0]) else f" {entry}"


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the logistic curve."""

    weights: dict[str, float]
    exceptions: list[str]
    slope: float = 2.0
    middle: float = 0.5

    def machine(self):
        found = ahocorasick.Automaton()
        for word, weight in self.weights.items():
            found.add_word(key_of(word), (len(key_of(word)), weight))
        for phrase in self.exceptions:
            # A phrase ends with its word, or with the plural of it.
            for key in (f" {phrase} ", f" {phrase}s "):
                found.add_word(key, (len(key), None))
        found.make_automaton()
        return found

    def score(self, strength: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * (strength - self.middle)))))


def strength(machine, text: str | None) -> float:
    """Sum of the weights of the entries that stand in the text, the longest from each place, by the logarithm of the length."""
    if not text or not len(machine):
        return 0.0
    folded = fold(text)
    best: dict[int, tuple[int, float]] = {}
    barred: list[tuple[int, int]] = []
    for end, (n, weight) in machine.iter(folded):
        start = end - n + 1
        if weight is None:
            barred.append((start, end))
        elif start not in best or best[start][0] < n:
            best[start] = (n, weight)
    if not best:
        return 0.0
    # Both in order of their starts; a place is barred if a phrase that starts before it ends behind it.
    barred.sort()
    total, at, until = 0.0, 0, -1
    for start in sorted(best):
        while at < len(barred) and barred[at][0] <= start:
            until = max(until, barred[at][1])
            at += 1
        # The blank that ends a phrase may begin the next word.
        total += best[start][1] if start >= until else 0.0
    return total / math.log2(8 + folded.count(" "))


def beginnings(text: str) -> set[str]:
    """Entries that a text could give: beginnings of words, whole words shorter than those, and runs of letters of unspaced scripts."""
    out = set()
    for w in set(fold(text).split()):
        if any(map(unspaced, w)):
            out |= {w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1) if unspaced(w[i])}
        elif len(w) < SHORTEST:
            out.add(f"{w} ")
        else:
            out |= {w[:n] for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}
    return out


def count_beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, toxic texts, other texts: counts of a partition's beginnings of words."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for part in beginnings(text):
                counts.setdefault(part, [0, 0])[0 if toxic else 1] += 1
    parts = list(counts)
    for i in range(0, len(parts), 50_000):
        some = parts[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), *[pa.array([counts[p][k] for p in some], pa.int64()) for k in (0, 1)]], ["part", "toxic", "other"])


def sample(labelled: DataFrame) -> DataFrame:
    """text and toxic of the rows to learn from, those of least hash; copies of a text count once for each label."""
    scratch, out = Scratch(labelled.sparkSession), None
    for label, n in SIZES.items():
        own = labelled.where(F.col("toxic") == label).select("text", "toxic")
        own = sample_by_hash(own, "toxic", "text", n, scratch, f"hashes_{label}").select("text", "toxic")
        out = own if out is None else out.union(own)
    return out


def entries(counts: DataFrame, n_toxic: int, n_other: int) -> dict[str, float]:
    """Beginnings that tell toxic texts, without those that a shorter one covers as well."""
    odds = lambda c, n: (F.col(c) + 0.5) / F.lit(n + 1.0)
    weight = F.log(odds("toxic", n_toxic) / odds("other", n_other))
    doubt = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    scored = counts.select("part", "toxic", weight.alias("weight"), (weight / doubt).alias("sure"))
    rows = scored.where((F.col("toxic") >= MIN_TEXTS) & (F.col("weight") >= MIN_WEIGHT) & (F.col("sure") >= MIN_SURE))
    found = {r["part"]: (r["weight"], r["toxic"]) for r in rows.orderBy(F.desc("sure"), "part").limit(4 * ENTRIES).collect()}
    kept: dict[str, float] = {}
    for part in sorted(found, key=lambda p: (len(p), p)):
        shorter = max((found[part[:n]][0] for n in range(SHORTEST, len(part)) if part[:n] in kept), default=None)
        if shorter is None or found[part][0] > shorter + 0.5:
            kept[part] = found[part][0]
    return dict(sorted(kept.items(), key=lambda e: (-e[1], e[0]))[:ENTRIES])


def fit_curve(lexicon: Lexicon, rows: list[tuple[str, int]]) -> None:
    """Logistic regression of the labels on the strength, classes weighted alike, by Newton steps with a small penalty."""
    machine = lexicon.machine()
    x = np.array([strength(machine, t) for t, _ in rows])
    y = np.array([float(label) for _, label in rows])
    if not len(y) or y.min() == y.max():
        return
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (share * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2), design.T @ (share * (y - p)) - 0.01 * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    if beta[0] > 0:
        lexicon.slope, lexicon.middle = float(beta[0]), float(-beta[1] / beta[0])


def learn(rows: DataFrame) -> Lexicon:
    """``rows``: text and toxic of a bounded sample."""
    text_batches(rows.sparkSession)
    rows = rows.repartition(16, F.xxhash64("text")).persist()
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    counts = rows.mapInArrow(count_beginnings, "part string, toxic bigint, other bigint").groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    weights = dict.fromkeys(KNOWN, KNOWN_WEIGHT)
    weights |= entries(counts, sizes.get(1, 0), sizes.get(0, 0)) if sizes.get(1) and sizes.get(0) else {}
    lexicon = Lexicon(weights, EXCEPTIONS)
    fit_curve(lexicon, [(r["text"], r["toxic"]) for r in rows.orderBy(F.xxhash64("text"), "text").limit(CURVE_TEXTS).collect()])
    rows.unpersist()
    return lexicon


def train(labelled: DataFrame) -> Lexicon:
    """``labelled``: text and toxic of the rows that may be learned from."""
    return learn(sample(labelled))


def train_on(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The same from documents (doc_id, text) and labels (doc_id, toxic), without moving texts for their join."""
    return learn(labelled_sample(docs, labels, "toxic", SIZES, Scratch(docs.sparkSession)).select("text", "toxic"))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id and score of each row of ``docs`` (doc_id, text)."""
    text_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        machine = lexicon.machine()
        return pa.array([lexicon.score(strength(machine, t)) for t in texts.to_pylist()], pa.float64())

    return docs.select("doc_id", scored("text").alias("score"))
