"""Quality rules with adaptive limits.

Each text gets counts (words, symbols, repeated lines, repeated passages, words that repeat their predecessor). Limits aren't fixed numbers: for every language and
source a mergeable quantile sketch of each ratio gives a fence around the usual values, and a text outside of its group's
fence is rejected.

The sketch is a log-linear histogram: a value is rounded down to ``BITS`` leading binary digits and counted, so its error is
at most 1/16 of the value, two sketches merge by adding counts, and the result doesn't depend on the order of merging. Small
groups take the sketch merged over their language, or over all texts.

Defined results: a null or empty text has zero counts and fails the base rule; a null language or source is a group of its
own; repeated rows count each; extra columns stay and may have any name; an empty table gives an empty table.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanforge.llm.common import Scratch, fresh_name, text_batches
from scanforge.plans.joins import lookup_join

BITS = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutters"]
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Least rows for a group to have limits of its own; below it the group's language decides, then all texts.
MIN_ROWS = 200
# Fence: quartile plus or minus FENCE times the quartile range; a range below the metric's least spread counts as that spread.
FENCE = 4
# name: (numerator, denominator, factor, least spread, is there a lower limit)
METRICS = {
    "symbol_share": ("n_symbols", "n_words", 10_000, 300, False),
    "dup_line_share": ("n_dup_lines", "n_lines", 10_000, 1000, False),
    "repeat_share": ("n_repeat_words", "n_words", 10_000, 740, False),
    "stutter_share": ("n_stutters", "n_words", 10_000, 500, False),
    "word_length": ("word_chars", "n_words", 100, 60, True),
}
NO_GROUP = "\u0000"


def repeat_words(words: list[bytes], width: int = 8) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words)
    if n <= width:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    span = 1
    while span < width:
        # Rank of a window of 2 * span words from the ranks of its halves; equal rank means equal words.
        pairs = rank[:-span] * (n + 1) + rank[span:]
        _, rank, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0
        span *= 2
    covered = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(counts[rank] > 1)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered)[:n] > 0).sum())


def count_text(text: bytes | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    code_points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    blanks = len(text) - sum(map(len, words))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    stutters = sum(map(eq, words, words[1:]))
    return (len(words), code_points - blanks, symbols, len(lines) - len(set(lines)), repeat_words(words), len(lines), stutters)


def count_texts(texts: pa.Array) -> pa.Array:
    rows = [count_text(t) for t in texts.to_pylist()]
    columns = zip(*rows) if rows else [[]] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)


def counts_of(text: Column) -> Column:
    kind = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"

    @F.arrow_udf(kind)
    def counted(texts: pa.Array) -> pa.Array:
        return count_texts(texts)

    # Else a filter on the counts moves below them and counts each text a second time, in a second worker of each task.
    return counted.asNondeterministic()(text.cast("binary"))


def base_failed(counts) -> Column:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def metric(counts, name: str) -> Column:
    top, below, factor, _, _ = METRICS[name]
    return F.floor(counts[top] * factor / F.greatest(counts[below], F.lit(1))).cast("long")


def cell(value: Column) -> Column:
    """The value cut to its leading binary digits: the sketch's cell, as its lower bound."""
    shift = F.greatest(F.length(F.bin(value)) - F.lit(BITS), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """Counts by (lang, source, metric, cell) over texts that pass the base rule. ``measured`` has lang, source and counts."""
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), cell(metric(F.col("counts"), m)).alias("cell")) for m in METRICS])
    return (
        measured.where(~base_failed(F.col("counts")))
        .select("lang", "source", F.explode(entries).alias("e"))
        .groupBy("lang", "source", "e.metric", "e.cell")
        .agg(F.count("*").alias("n"))
    )


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """First and third quartile of each metric by ``keys``, one row per key."""
    merged = sketch.groupBy(*keys, "metric", "cell").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    upto = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.select(*keys, "metric", "cell", F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("rows"))

    def at(m: str, quarter: int) -> Column:
        return F.min(F.when((F.col("metric") == m) & (4 * F.col("upto") >= quarter * F.col("rows")), F.col("cell")))

    columns = [F.max("rows").alias("rows")]
    for m in METRICS:
        columns += [at(m, 1).alias(f"{m}_q1"), at(m, 3).alias(f"{m}_q3")]
    return ranked.groupBy(*keys).agg(*columns)


def limits(sketch: DataFrame) -> DataFrame:
    """Lower and upper limit of each metric by (lang, source); a group without own limits takes wider ones.

    The sketch merged over everything is one row of numbers and comes to the driver.
    """
    own = quartiles(sketch, ["lang", "source"])
    values = [c for c in own.columns if c not in ("lang", "source")]
    named = lambda df, mark: df.select(*[F.col(c).alias(f"{mark}_{c}" if c in values else c) for c in df.columns])
    joined = named(own, "own").join(named(quartiles(sketch, ["lang"]), "lang"), "lang")
    whole = quartiles(sketch.withColumn("any", F.lit(1)), ["any"]).first()

    def pick(c: str) -> Column:
        return (
            F.when(F.col("own_rows") >= MIN_ROWS, F.col(f"own_{c}"))
            .when(F.col("lang_rows") >= MIN_ROWS, F.col(f"lang_{c}"))
            .otherwise(F.lit(whole[c] if whole else 0))
        )

    fences = []
    for m, (_, _, _, least, has_low) in METRICS.items():
        spread = F.greatest(pick(f"{m}_q3") - pick(f"{m}_q1"), F.lit(least))
        fences.append((pick(f"{m}_q3") + FENCE * spread).alias(f"{m}_high"))
        if has_low:
            fences.append((pick(f"{m}_q1") - FENCE * spread).alias(f"{m}_low"))
    return joined.select("lang", "source", *fences)


def within(counts, bounds) -> Column:
    """Are all metrics within the limits? ``bounds`` gives a limit column by name."""
    ok = F.lit(True)
    for m, (_, _, _, _, has_low) in METRICS.items():
        ok = ok & (metric(counts, m) <= bounds(f"{m}_high"))
        if has_low:
            ok = ok & (metric(counts, m) >= bounds(f"{m}_low"))
    return ok


def group_of(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(NO_GROUP))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and counts of each text."""
    text_batches(docs.sparkSession)
    return docs.select("doc_id", group_of("lang").alias("lang"), group_of("source").alias("source"), counts_of(F.col("text")).alias("counts"))


def judge(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Counts, base rule and verdict of each row of ``docs`` (doc_id, text, lang, source)."""
    scratch = scratch or Scratch(docs.sparkSession)
    measured = scratch.save(measure(docs), "quality_counts")
    bounds = scratch.save(limits(sketches(measured)), "quality_limits")
    # A group's key may hold a third of all rows; the join is by broadcast or salted.
    joined = lookup_join(measured, bounds, ["lang", "source"], F.col("doc_id"), "left")
    failed = base_failed(F.col("counts"))
    return joined.select(
        "doc_id",
        *[F.col(f"counts.{c}").alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        (~failed & F.coalesce(within(F.col("counts"), F.col), F.lit(False))).alias("kept"),
    )


def keep_good(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` without the texts that the base rule or the limits reject. Texts aren't shuffled: limits come to them."""
    scratch = scratch or Scratch(docs.sparkSession)
    # Limits read the sketch three times; texts are counted once for it.
    sketch = scratch.save(sketches(measure(docs)), "quality_sketch")
    bounds = scratch.save(limits(sketch), "quality_limits")
    scratch.drop("quality_sketch")
    lang, source, counts, limit = (fresh_name(docs, f"_quality_{x}") for x in ("lang", "source", "counts", "limits"))
    packed = bounds.select(
        F.col("lang").alias(lang), F.col("source").alias(source), F.struct(*[c for c in bounds.columns if c not in ("lang", "source")]).alias(limit)
    )
    marked = docs.select("*", group_of("lang").alias(lang), group_of("source").alias(source), counts_of(F.col("text")).alias(counts))
    marked = marked.where(~base_failed(F.col(counts)))
    joined = lookup_join(marked, packed, [lang, source], F.col("doc_id"), "inner")
    return joined.where(within(F.col(counts), lambda c: F.col(f"{limit}.{c}"))).select(*[F.col(f"`{c}`") for c in docs.columns])
