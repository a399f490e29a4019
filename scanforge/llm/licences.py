"""Licence scans by a positional rare-token index. Built-in functions only.

Templates are short public licence notices. Their words are indexed with their positions; the words' frequencies over all
texts tell which are rare. An alignment counts only with the template's key phrase at its place in the text, so the rarest word of each
key phrase is looked up in all texts, which finds every alignment; it is scored by the share of the template's rarity that stands at its
place around the hit.

Some phrases are base findings of their own, whatever the index says.

Defined results: words are runs of lower-cased letters, digits and non-ASCII characters; a null text counts as empty and has
no labels; each row is judged alone, equal rows get equal results; extra columns stay out; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanforge.llm import spans
from scanforge.llm.common import Scratch

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
MIN_SCORE = 0.7

# Wording of public licence notices, as (label, notice, key phrase).
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "licensed under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("bsd", "licensed under the bsd license", "bsd license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license", "attribution sharealike"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license", "attribution noncommercial"),
    ("cc-by", "licensed under a creative commons attribution license", "commons attribution license"),
    ("cc-by", "licensed under cc by 4 0", "cc by"),
    ("cc0", "dedicated to the public domain under cc0", "cc0"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
]
# Function words stay out of the index.
STOP = set("a an and any are as at by for from in into is it of on or the this to under use with without you can".split())
VOCABULARY = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()} - STOP)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def strings(values: list[str]) -> Column:
    return F.split(F.lit(" ".join(values)), " ")


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_gaps(line: Column, phrase: str) -> Column:
    """The words of a text between places of a phrase, the words being joined by blanks with one before and after; null where there are none."""
    gaps = F.split(line, f"(?<= ){phrase}(?= )", -1)
    return F.when(line.contains(f" {phrase} "), F.slice(gaps, 1, F.size(gaps) - 1))


def phrase_places(gaps: Column, phrase: str) -> Column:
    """Word positions of a phrase from its gaps, a column of its own."""

    # A gap holds the blank before the phrase and one more for each word in it; a later gap starts with the blank after the last phrase.
    def step(acc: Column, gap: Column) -> tuple:
        place = (acc["next"] + spaces(gap) - 1).cast("long")
        return {"next": place + len(phrase.split())}, F.array(place)

    places = spans.collecting(gaps, {"next": F.lit(0).cast("long")}, "bigint", step)
    return F.when(F.size(gaps) > 0, places).otherwise(F.array().cast("array<bigint>"))


def scan_base(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_words, licence words and places of the base phrases of each text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = rows.select("doc_id", "text", words_of(F.col("text")).alias("words"))
    first = sorted({w for phrase in BASE for w in phrase.split()[:1]})
    some = F.arrays_overlap("words", strings(first))
    listed = words.select(
        "doc_id", F.xxhash64("text").alias("hash"), F.size("words").cast("long").alias("n_words"),
        F.array_intersect(strings(VOCABULARY), F.col("words")).alias("licence_words"),
        F.when(some, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))).alias("line"),
    )
    listed = listed.select("*", *[phrase_gaps(F.col("line"), p).alias(f"gaps_{i}") for i, p in enumerate(BASE)])
    places = [phrase_places(F.col(f"gaps_{i}"), p).alias(label) for i, (p, label) in enumerate(BASE.items())]
    return listed.select("doc_id", "hash", "n_words", "licence_words", F.array(*places).alias("places"))


def rarity(base: DataFrame) -> dict[str, float]:
    """IDF of the vocabulary's words over all texts; the vocabulary is fixed, so this is a bounded collect."""
    n = base.count()
    seen = base.select(F.explode("licence_words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    counts = {r["w"]: r["n"] for r in seen}
    # A word of all texts keeps a small weight, so that every notice has words, however common they are.
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-6 for w in VOCABULARY}


def notices(idf: dict[str, float], docs: DataFrame) -> DataFrame:
    """word, template, place, start and phrase (key phrase), parts (place, word, share of the template's rarity). One row per template.

    ``word`` is the rarest word of the key phrase. An alignment counts only with its key phrase, so each of them has this word at ``place``.
    """
    rows = []
    for t, (_, notice, key) in enumerate(TEMPLATES):
        words, phrase = notice.split(), key.split()
        start = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        placed = [(p, w) for p, w in enumerate(words) if w in idf]
        total = sum(idf[w] for _, w in placed)
        place = max((p for p, _ in placed if start <= p < start + len(phrase)), key=lambda p: (idf[words[p]], -p))
        rows.append((words[place], t, place, start, phrase, [(p, w, idf[w] / total) for p, w in placed]))
    schema = "word string, template int, place int, start int, phrase array<string>, parts array<struct<place:int,word:string,weight:double>>"
    return docs.sparkSession.createDataFrame(rows, schema)


def alignments(docs: DataFrame, idf: dict[str, float]) -> DataFrame:
    """hash, template and best score of the verified alignments, hash being that of the text."""
    index = notices(idf, docs)
    anchors = sorted({r["word"] for r in index.select("word").collect()})
    rows = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("hash"), words_of(F.col("text")).alias("words"))
    rows = rows.where(F.arrays_overlap("words", strings(anchors)))
    longest = max(len(n.split()) for _, n, _ in TEMPLATES)
    placed = rows.select("hash", "words", F.posexplode("words").alias("at", "word")).where(F.col("word").isin(anchors))
    # The words around a hit are enough to score a notice, so that no row carries its whole text further.
    first = F.greatest(F.col("at") - longest, F.lit(0))
    near = placed.select("hash", "at", "word", first.alias("first"), F.slice("words", first + 1, 2 * longest + 1).alias("near"))
    hits = near.join(F.broadcast(index), "word").withColumn("offset", F.col("at") - F.col("place") - F.col("first"))
    begin = F.col("offset") + F.col("start")
    there = (begin >= 0) & (F.slice("near", F.greatest(begin, F.lit(0)) + 1, F.size("phrase")) == F.col("phrase"))
    stands = lambda x: F.coalesce(F.get("near", F.col("offset") + x["place"]) == x["word"], F.lit(False))
    score = F.aggregate("parts", F.lit(0.0), lambda total, x: total + F.when(stands(x), x["weight"]).otherwise(0.0))
    scored = hits.where(there).select("hash", "template", score.alias("score")).where(F.col("score") >= MIN_SCORE)
    return scored.groupBy("hash", "template").agg(F.max("score").alias("score"))


def scan(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_words, places (by base label), labels and score of each row of ``docs`` (doc_id, text)."""
    scratch = scratch or Scratch(docs.sparkSession)
    base = scratch.save(scan_base(docs), "base")
    # A text that stands in several rows is scored once for its hash, whatever the number of its copies.
    found = alignments(docs, rarity(base))
    label = F.get(F.array(*[F.lit(name) for name, _, _ in TEMPLATES]), F.col("template"))
    best = found.groupBy("hash").agg(F.array_sort(F.collect_set(label)).alias("labels"), F.max(F.least("score", F.lit(1.0))).alias("score"))
    best = scratch.save(best, "labels")
    base_labels = F.filter(F.array(*[F.when(F.size(F.get("places", i)) > 0, F.lit(v)) for i, v in enumerate(BASE.values())]), lambda x: x.isNotNull())
    joined = base.join(best, "hash", "left")
    return joined.select(
        "doc_id", "n_words", F.flatten("places").alias("places"), F.array_sort(base_labels).alias("base_labels"),
        F.array_sort(F.array_union(base_labels, F.coalesce("labels", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
