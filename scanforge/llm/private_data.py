"""Personal data: rules, and sanitisation of terms that reveal it. Built-in functions only.

Rules find e-mail and IP addresses, card and phone numbers: the protected entities. Corpus co-occurrence then tells how much
a nearby term reveals an entity c: texts are cut into contexts of ``CONTEXT`` terms, and the disclosure of term t is
PMI(c; t) / IC(c) = 1 - log(n(t) / n(c, t)) / log(N / n(c)), which is 1 where t never occurs without c. Terms beyond
``REMOVE`` are removed, those beyond ``GENERALISE`` are replaced by their class. Pairs count only with ``SUPPORT`` different
contexts, since a pair seen once says nothing.

Counts cover all texts. A context has a bounded number of terms, so pairs grow with the number of entities found; counts of
terms are aggregated per task before they move.

Defined results: a null text counts as empty and has no spans; rows equal in doc_id and text get equal results, a null doc_id is allowed;
of overlapping spans the first is rewritten; extra columns stay out of the result; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanforge.llm import spans
from scanforge.llm.common import Scratch
from scanforge.plans.joins import lookup_join

CONTEXT = 16
SUPPORT = 5
GENERALISE = 0.6
REMOVE = 0.9
MARK = "\x01"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{3,}+"
# The part before @ starts where a run of its characters starts, or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_ip(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.expr("try_cast('' as int)"), p.try_cast("int"), F.lit(0)) <= 255))


def is_card(value: Column) -> Column:
    """13 to 19 digits whose Luhn sum ends in 0."""
    of = F.transform(F.split(F.reverse(digits(value)), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    luhn = F.transform(of, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.length(digits(value)).between(13, 19) & (F.aggregate(luhn, F.lit(0), lambda a, b: a + b) % 10 == 0)


def rules(text: Column) -> list:
    return [
        ("email", EMAIL, text.contains("@"), None),
        ("ip", IP, None, is_ip),
        ("card", CARD, None, is_card),
        ("phone", PHONE, text.contains("+"), lambda v: F.length(digits(v)).between(9, 15)),
    ]


def find_base(docs: DataFrame) -> DataFrame:
    """key (of doc_id and text), doc_id, base spans, and the text of rows that have some."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string"))
    found = spans.with_spans(rows, "text", rules(F.col("text")), "spans")
    contexts = F.ceil(F.regexp_count("text", F.lit(TERM)) / CONTEXT).cast("long").alias("n_contexts")
    return found.select(key.alias("key"), "doc_id", "spans", contexts, F.when(F.size("spans") > 0, F.col("text")).alias("text"))


def marked(text: Column) -> Column:
    """The text in lower case with each entity between marks."""
    out = F.translate(text, MARK, " ")
    for pattern in (EMAIL, PHONE, CARD, IP):
        out = F.regexp_replace(out, pattern, f"{MARK}$0{MARK}")
    return F.lower(out)


def in_contexts(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """One row per context from rows with ``tokens``."""
    last = F.floor((F.size("tokens") - 1) / CONTEXT).cast("int")
    starts = F.when(F.size("tokens") > 0, F.sequence(F.lit(0), last))
    numbered = tokens.select(*keep, "tokens", F.explode(starts).alias("i"))
    return numbered.select(*keep, F.slice("tokens", F.col("i") * CONTEXT + 1, CONTEXT).alias("context"))


def entity_pairs(base: DataFrame) -> DataFrame:
    """key, context hash, entity and term, for each entity and term of one context."""
    hits = base.where(F.col("text").isNotNull()).select("key", F.transform("spans", lambda s: F.lower(s["value"])).alias("values"), F.regexp_extract_all(marked(F.col("text")), F.lit(f"{MARK}[^{MARK}]*+{MARK}|{TERM}"), F.lit(0)).alias("tokens"))
    contexts = in_contexts(hits, ["key", "values"]).where(F.exists("context", lambda t: t.startswith(MARK)))
    entity = F.array_intersect(F.transform(F.filter("context", lambda t: t.startswith(MARK)), lambda t: F.translate(t, MARK, "")), "values")
    term = F.array_distinct(F.filter("context", lambda t: ~t.startswith(MARK)))
    split = contexts.select("key", F.xxhash64("context").alias("context"), entity.alias("entities"), term.alias("terms"))
    return split.select("key", "context", "terms", F.explode("entities").alias("entity")).select("key", "context", "entity", F.explode("terms").alias("term"))


def disclosure(n_term: Column, n_contexts: int) -> Column:
    """PMI by information of the entity, from n_entity and n_both; it falls as the term gets more frequent."""
    information = F.log(F.lit(float(n_contexts)) / F.col("n_entity"))
    lost = F.log(F.greatest(n_term, F.col("n_both")) / F.col("n_both"))
    return F.when(information > 0, 1 - lost / information).otherwise(0.0)


def disclosures(docs: DataFrame, pairs: DataFrame, n_contexts: int, scratch: Scratch) -> DataFrame:
    """entity, term, disclosure of the pairs with enough support."""
    together = pairs.groupBy("entity", "term", "context").agg(F.count("*").alias("n")).groupBy("entity", "term")
    together = together.agg(F.sum("n").alias("n_both"), F.count("*").alias("support")).where(F.col("support") >= SUPPORT)
    entities = pairs.select("entity", "key", "context").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    # A term stands at least as often as it does near entities; where that is too often already, no count is needed.
    near = pairs.select("term", "key", "context").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    together = together.join(entities, "entity").join(near, "term").where(disclosure(F.col("n_near"), n_contexts) >= GENERALISE)
    together = scratch.save(together, "together")
    terms = scratch.save(together.select("term").distinct(), "terms")
    tokens = docs.select(F.regexp_extract_all(F.lower(F.col("text")), F.lit(TERM), F.lit(0)).alias("tokens"))
    contexts = in_contexts(tokens, [])
    # Counted before the join: a frequent term is one row by then. An inner join, as a semi-join would be moved below the count.
    seen = contexts.select(F.explode(F.array_distinct("context")).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    seen = lookup_join(seen, terms, ["term"], None)
    return together.join(seen, "term").select("entity", "term", disclosure(F.col("n_term"), n_contexts).alias("disclosure"))


def term_spans(base: DataFrame, flagged: DataFrame) -> DataFrame:
    """key and spans of flagged terms. ``flagged``: key, term, kind."""
    texts = base.where(F.col("text").isNotNull()).join(flagged.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    parts = texts.select("key", F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("m"), F.split("text", TERM, -1).alias("g"))
    rows = parts.select("key", F.posexplode(F.arrays_zip("g", "m")).alias("i", "x")).select("key", "i", F.col("x.m").alias("value"), F.length("x.g").alias("gap"), F.length("x.m").alias("n"))
    # One document's words in order: the window holds one text at a time.
    before = Window.partitionBy("key").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.select("key", F.lower("value").alias("term"), "value", "n", (F.sum(F.col("gap") + F.coalesce("n", F.lit(0))).over(before) - F.col("n")).cast("long").alias("start"))
    found = placed.join(flagged, ["key", "term"])
    span = F.struct("start", F.lit(len(KINDS)).alias("rank"), (F.col("start") + F.col("n")).cast("long").alias("end"), F.col("kind"), "value")
    return found.groupBy("key").agg(F.array_sort(F.collect_list(span)).alias("terms"))


def find_private(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, base and all spans, and the text of rows with spans, for each row of ``docs`` (doc_id, text)."""
    scratch = scratch or Scratch(docs.sparkSession)
    base = scratch.save(find_base(docs), "base")
    pairs = scratch.save(entity_pairs(base), "pairs")
    n_contexts = base.agg(F.sum("n_contexts")).first()[0] or 1
    found = scratch.save(disclosures(docs, pairs, n_contexts, scratch).where(F.col("disclosure") >= GENERALISE), "disclosures")
    kind = F.when(F.max("disclosure") >= REMOVE, "remove").otherwise("generalise").alias("kind")
    flagged = scratch.save(pairs.join(found, ["entity", "term"]).groupBy("key", "term").agg(kind), "flagged")
    extra = term_spans(base, flagged)
    # Terms inside of an entity are part of it already.
    outside = F.filter("terms", lambda t: ~F.exists("spans", lambda s: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    joined = base.join(extra, "key", "left").select("doc_id", "text", "spans", F.when(F.col("terms").isNotNull(), outside).otherwise(spans.no_spans()).alias("terms"))
    return joined.select("doc_id", "text", F.col("spans").alias("base"), F.array_sort(F.concat("spans", "terms")).alias("spans"))


def sanitised(text: Column, found: Column) -> Column:
    """The text with entities replaced by their kind, revealing terms by their class, and the most revealing ones removed."""
    word = F.lit("[word]")
    return spans.rewrite(text, found, lambda s: F.when(s["kind"] == "remove", "").when(s["kind"] == "generalise", word).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]"))))
