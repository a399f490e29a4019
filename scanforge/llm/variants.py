"""Spelling variants of words by asymmetric q-chunks.

Of two words that differ by one inserted, deleted or replaced code point, the shorter one (of length m, or either where the
lengths are equal) gives two disjoint chunks of q = m // 2 code points, its beginning and its end. One edit touches at most one
of them, so the other stands in the longer word, moved by at most one place. The longer word gives its positional grams of q code
points; those more than one place away from a chunk's can't meet it and are left out. Chunks join grams on (m, which chunk, string),
and the edit distance verifies every pair that meets.

Keys with many chunks or grams are dealt in squares of ``SIDE`` x ``SIDE`` over as many tasks as they need, so no key is gathered in one place.

A word's form is its near word of largest count, if that is at least twice its own. Counts double along a chain of forms, so a
chain has at most log2 of the largest count links, and its end (the root) is found by that many doublings.

Defined results: a null text has no words; a null id is an empty string in what crc32 is taken of; repeated rows count as often as
they stand; words compare by code points; extra columns stay out; an empty table gives an empty table. A very long text is read in slices.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.llm.common import Scratch, slices, text_batches

RUN = re.compile("[a-zÀ-ÿ]+")
SHORTEST = 5
MIN_COUNT = 3
MODULUS = 97
SIDE = 4096
# Different words of a task that are counted before they are handed on.
HELD = 300_000
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def damaged(run: str, crc: int) -> str:
    """The run without one code point, if its checksum says so. ``crc``: that of what stands before the run."""
    h = zlib.crc32(run.encode(), crc)
    if h % MODULUS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n from (id, text), ids being strings."""
    counts: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        part = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return part

    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            crc = zlib.crc32(f"{key}:".encode())
            for part in slices(text.encode()):
                for run, n in Counter(RUN.findall(part.translate(LOWER).decode())).items():
                    counts[damaged(run, crc)] += n
                if len(counts) > HELD:
                    yield counted()
    yield counted()


def words_of(docs: DataFrame) -> DataFrame:
    """word and n of the words that are long and common enough."""
    text_batches(docs.sparkSession)
    rows = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts = rows.mapInArrow(count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.col("n") >= MIN_COUNT) & (F.char_length("word") >= SHORTEST))


KEY = ["m", "chunk", "gram"]


def chunks(words: DataFrame) -> DataFrame:
    """The two chunks of each word."""
    sized = words.withColumn("m", F.char_length("word")).withColumn("q", F.expr("m div 2").cast("int"))
    both = F.array(*[F.struct(F.lit(c).alias("chunk"), F.expr(place).alias("gram")) for c, place in ((0, "left(word, q)"), (1, "right(word, q)"))])
    return sized.select("word", "n", "m", F.explode(both).alias("x")).select("word", "n", "m", "x.*")


def grams(words: DataFrame) -> DataFrame:
    """Each word's positional grams that a chunk of a word as long, or shorter by one, can meet within a shift of one."""
    sized = words.withColumn("m", F.explode(F.array(F.char_length("word"), F.char_length("word") - 1))).where(F.col("m") >= SHORTEST)
    placed = sized.withColumn("q", F.expr("m div 2").cast("int")).withColumn(
        "x", F.explode(F.expr("flatten(transform(array(0, m - q), (p, c) -> transform(array(p - 1, p, p + 1), at -> struct(c as chunk, at as at))))"))
    )
    inside = placed.where("x.at >= 0 and x.at + q <= char_length(word)")
    return inside.select("word", "n", "m", F.col("x.chunk").alias("chunk"), F.expr("substr(word, x.at + 1, q)").alias("gram")).distinct()


def in_squares(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with (i, j), the part of their key's rows on the left and on the right that they meet."""
    size = lambda df, name: df.groupBy(*KEY).agg(F.ceil(F.count("*") / SIDE).cast("int").alias(name))
    large = size(left, "n_i").join(size(right, "n_j"), KEY).where("n_i > 1 or n_j > 1")
    part = lambda c: F.pmod(F.xxhash64("word"), F.coalesce(c, F.lit(1))).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.coalesce(c, F.lit(1)) - 1))
    sides = []
    for df, own, other in ((left, "i", "j"), (right, "j", "i")):
        known = df.join(large, KEY, "left").withColumn(own, part(F.col(f"n_{own}"))).withColumn(other, every(F.col(f"n_{other}")))
        sides.append(known.drop("n_i", "n_j"))
    return sides[0], sides[1]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words of ``words`` (word, n) one edit apart, both ways round."""
    left, right = in_squares(chunks(words), grams(words))
    left, right = left.alias("a"), right.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in (*KEY, "i", "j")]
    # Of two words of one length either may give the chunks; the first in order does.
    first = (F.char_length("b.word") > F.col("a.m")) | (F.col("a.word") < F.col("b.word"))
    apart = F.levenshtein("a.word", "b.word", 1) == 1
    found = left.join(right, [*on, first, apart]).select(F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))
    found = found.distinct()
    turned = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return found.select(turned.alias("x")).select("x.*")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of ``docs`` (doc_id, text)."""
    scratch = Scratch(docs.sparkSession)
    words = scratch.save(words_of(docs), "words")
    best = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    taken = -F.col("best.less") >= 2 * F.col("n")
    formed = best.select("word", "n_near", F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"))
    rows = scratch.save(words.join(formed, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("bigint"))), "formed")
    longest = math.log2(max(2, words.agg(F.max("n")).first()[0] or 0))
    ends = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for turn in range(math.ceil(math.log2(longest + 1))):
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = scratch.save(ends.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), f"ends_{turn}")
    done = rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    return done
