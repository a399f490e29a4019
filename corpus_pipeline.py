"""A training corpus from the documents table: good texts, one of each group, without secrets, mixed to weights, as token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.llm import mixing, near_text, pieces, quality, queries, secrets
from scanforge.llm.common import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that pass the base rule and their group's limits."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity of 0.8 or more."""
    return near_text.keep_one(docs, width=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced by their kind."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """60 percent of the tokens, dealt by weights of domain, language and source; up to two passes over a leaf."""
    return mixing.take_mixed(docs, queries.tree(), [F.expr(w) for w in queries.WEIGHTS])


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text."""
    found = pieces.tokenise(docs)
    plain = F.translate("text", pieces.MARK, " ")
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("restored") == plain).alias("restored"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]
# Networks of links and token paths have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again by the next."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage_{i}")
        if i:
            scratch.drop(f"stage_{i - 1}")
    return docs
