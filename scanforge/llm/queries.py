"""Registered queries of the pipeline's operators, each over its whole table, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.llm import collocations, languages, licences, mixing, near_text, near_vectors, passages, pieces, private_data, quality, secrets, spans, sql, toxicity, variants


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.find_private(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[spans.count_kind("base", k).alias(f"n_{k}") for k in private_data.KINDS],
        F.sha2(spans.joined(spans.by_kind(F.col("base"))), 256).alias("base_sha256"),
        spans.joined(spans.by_kind(F.col("spans"))).alias("spans"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *[spans.count_kind("spans", k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(spans.joined(base), 256).alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_random"),
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids as a digest, and whether they decode to the text (the piece mark being a blank)."""
    found = pieces.tokenise(table(spark, sf_dir, "documents"))
    plain = F.translate("text", pieces.MARK, " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), (F.col("restored") == plain).alias("restored"))


def part_of(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = languages.train(docs.where(part_of(4) != 2).select("text", "lang"))
    return languages.predict(docs, net).select("doc_id", (part_of(4) == 2).alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(part_of(3) != 1).select("doc_id", "toxic")
    lexicon = toxicity.train_on(docs, labels)
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", (part_of(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


# The tree of the documents table: sources fall into three domains by their number.
DOMAIN = "concat('d', coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int), 0) % 3)"
PATH = ["domain", "lang", "source"]
WEIGHTS = [
    "case domain when 'd0' then 5 when 'd1' then 3 else 2 end",
    "case lang when 'en' then 6 else 2 end",
    "case source when 'src0' then 3 else 1 end",
]


def tree() -> dict[str, Column]:
    return {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", F.expr(DOMAIN).alias("domain"))
    return mixing.mix(docs, PATH, [F.expr(w) for w in WEIGHTS], budget_percent=60, epochs=2, seed=1)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = passages.train(docs, table(spark, sf_dir, "labels").where(part_of(3) != 1))
    scored = passages.score(docs, model)
    return scored.select("doc_id", (part_of(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_embedding_near_dedup,
        op3_private_data,
        op4_secret_scan,
        op5_minhash_near_dedup,
        op6_sentencepiece,
        op7_language_id,
        op8_toxicity,
        op9_license_scan,
        op10_mixing,
        op11_collocations,
        op12_spelling_variants,
        op13_quality_classifier,
    )
}
# The other methods (models, automata, co-occurrence) have no SQL; tests compare them with brute-force versions.
ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": sql.quality_rules(),
    "op2_embedding_near_dedup": sql.near_vectors(),
    "op5_minhash_near_dedup": sql.near_texts(),
    "op10_mixing": sql.mixing_sources(DOMAIN, PATH, WEIGHTS, 60, 2, 1),
    "op11_collocations": sql.collocations(),
    "op12_spelling_variants": sql.variants(),
}
