"""Secrets: rules, and random strings found by character Markov models. Built-in functions only.

Rules find assignments to secret names, access key ids and long hexadecimal strings. Two first-order Markov models over
characters, one of random strings and one of ordinary identifiers, then judge every other run of 16 or more key characters: where the log-likelihood
ratio exceeds ``MARGIN``, the run is a secret. A shorter run can hardly reach it.

Labelled samples: random strings are the values with a digit that the rules find (at most ``RULE_VALUES``, those of least hash) and
``RANDOM_ROWS`` digests in hexadecimal, base 64 and upper case; identifiers are the words of ``WORD_TEXTS`` different texts of least hash,
as they stand, in upper case, and joined in pairs (camel and snake case, also in capitals). The models are tables of
at most (characters + 1) squared counts each. Scoring covers every whole text.

Defined results: a null text counts as empty and has no spans; each row is judged alone, so null and repeated ids don't matter;
an empty table gives an empty table, its models being those of the digests.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanforge.llm import spans
from scanforge.llm.common import Scratch, fresh_name, sample_by_hash

ASSIGN_NAME = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_NAME + r"[A-Za-z0-9+/_.=-]++"
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{24,}+"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
CHARACTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][a-z]{2,24}+(?![A-Za-z0-9+/_=-])"
MARGIN = math.log(1e6)
RANDOM_ROWS = 2000
RULE_VALUES = 5000
WORD_TEXTS = 2000
FLOOR = 0.1


def rules(text: Column) -> list:
    return [
        ("assign", ASSIGN, None, lambda v: F.length(F.regexp_replace(v, "^" + ASSIGN_NAME, "")) >= 6),
        ("access", ACCESS, text.contains("AKIA"), lambda v: F.length(v) >= 20),
        ("hex", HEX, None, None),
    ]


def random_samples(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Values that the rules find, if they hold a digit (plain words are no random strings), and digests."""
    scratch, text = scratch or Scratch(docs.sparkSession), F.col("text")
    values = F.concat(
        F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)), lambda v: F.regexp_replace(v, "^" + ASSIGN_NAME, "")),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    found = docs.where(text.rlike(f"{ASSIGN}|{ACCESS}|{HEX}")).select(F.lit(1).alias("g"), F.explode(values).alias("value"))
    found = found.where((F.length("value") >= 16) & F.col("value").rlike("[0-9]"))
    found = sample_by_hash(found, "g", "value", RULE_VALUES, scratch, "values").select("value")
    digest = F.sha2(F.col("id").cast("string"), 256)
    packed = F.base64(F.unhex(digest))
    digests = docs.sparkSession.range(0, RANDOM_ROWS, 1, 1).select(F.explode(F.array(digest, packed, F.upper(F.translate(packed, "+/=", "")))).alias("value"))
    return found.union(digests)


def identifier_samples(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Words of a sample of texts as they stand, in capitals, and joined in pairs: camel and snake case, capitals with and without an underscore."""
    scratch = scratch or Scratch(docs.sparkSession)
    texts = sample_by_hash(docs.select(F.lit(1).alias("g"), "text"), "g", "text", WORD_TEXTS, scratch, "texts")
    words = texts.select(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("w"))
    pairs = words.select("w", F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, 1_000_000).alias("b")).alias("p"))
    forms = F.concat(
        "w",
        F.transform("w", F.upper),
        F.transform("p", lambda x: F.concat(x["a"], F.initcap(x["b"]))),
        F.transform("p", lambda x: F.concat_ws("_", x["a"], x["b"])),
        F.transform("p", lambda x: F.upper(F.concat(x["a"], x["b"]))),
        F.transform("p", lambda x: F.upper(F.concat_ws("_", x["a"], x["b"]))),
    )
    return pairs.select(F.explode(forms).alias("value")).where(F.col("value").isNotNull())


def transitions(samples: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of neighbouring characters; at most len(CHARACTERS) squared."""
    codes = F.transform(F.split("value", ""), lambda c: F.instr(F.lit(CHARACTERS), c))
    pairs = samples.select(codes.alias("c")).select(F.explode(F.arrays_zip(F.col("c").alias("a"), F.slice("c", 2, 1_000_000).alias("b"))).alias("x"))
    counted = pairs.where("x.a > 0 and x.b > 0").groupBy("x.a", "x.b").agg(F.count("*").alias("n"))
    return {(r["a"] - 1, r["b"] - 1): r["n"] for r in counted.collect()}


def case_of(char: str) -> int:
    return 0 if char.islower() else 1 if char.isupper() else 2 if char.isdigit() else 3


def log_ratios(random: dict, words: dict) -> list[float]:
    """log P(next | last) under random strings less that under identifiers, at last * characters + next.

    Either model is a chain of letters whatever their case, times a chain of cases (lower, upper, digit, sign). So a word in capitals has
    the letters of a word, and a case that doesn't change. The letters' chain is mixed with ``FLOOR`` parts of even chances, as
    words of all languages hold pairs that the sample lacks.
    """
    size = len(CHARACTERS)
    letters = [c.lower() for c in CHARACTERS]
    folded = {c: i for i, c in enumerate(dict.fromkeys(letters))}
    letter = [folded[c] for c in letters]
    case = [case_of(c) for c in CHARACTERS]

    def chain(counts: dict, kinds: list[int], n: int, floor: float) -> list[list[float]]:
        table = [[1.0] * n for _ in range(n)]
        for (a, b), count in counts.items():
            table[kinds[a]][kinds[b]] += count
        return [[math.log((1 - floor) * x / sum(row) + floor / n) for x in row] for row in table]

    by_letter = [chain(counts, letter, len(folded), FLOOR) for counts in (random, words)]
    by_case = [chain(counts, case, 4, 0.0) for counts in (random, words)]
    ratio = lambda tables, a, b: tables[0][a][b] - tables[1][a][b]
    return [ratio(by_letter, letter[a], letter[b]) + ratio(by_case, case[a], case[b]) for a in range(size) for b in range(size)]


def train(docs: DataFrame) -> list[float]:
    scratch = Scratch(docs.sparkSession)
    random = transitions(random_samples(docs, scratch))
    scratch.drop("values", "values_last")
    scratch.release()
    words = transitions(identifier_samples(docs, scratch))
    scratch.drop("texts", "texts_last")
    scratch.release()
    return log_ratios(random, words)


def likelihood_ratio(value: Column, ratios: list[float]) -> Column:
    """Sum of the log ratios along a string of CHARACTERS."""
    size = len(CHARACTERS)
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    state = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        code = F.instr(F.lit(CHARACTERS), c) - 1
        gain = F.when(acc["last"] < 0, 0.0).otherwise(F.get(table, acc["last"] * size + code))
        return F.struct(code.alias("last"), (acc["sum"] + gain).alias("sum"))

    return F.aggregate(F.split(value, ""), state, step, lambda acc: acc["sum"])


def with_secrets(df: DataFrame, ratios: list[float], text: str, out: str) -> DataFrame:
    """``df`` with ``out``: spans of rules and models, ordered by start. ``text`` isn't null."""
    model = ("random", RUN, None, lambda v: likelihood_ratio(v, ratios) >= MARGIN)
    found = spans.with_spans(df, text, [*rules(F.col(text)), model], out)
    return found.withColumn(out, spans.outside_of(F.col(out), lambda s: s["kind"] != "random"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, text and spans of each row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_secrets(rows, train(docs), "text", "spans")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced by [kind]; a null text stays null."""
    text, found = fresh_name(docs, "_secrets_text"), fresh_name(docs, "_secrets_found")
    marked = with_secrets(docs.withColumn(text, F.coalesce("text", F.lit(""))), train(docs), text, found)
    clean = spans.rewrite(F.col(text), F.col(found), lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
    new = F.when(F.col("text").isNotNull(), clean).alias("text")
    return marked.select(*[new if c == "text" else F.col(f"`{c}`") for c in docs.columns])
