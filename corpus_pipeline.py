"""A training-text pipeline of the corpus operators.

toxicity -> line dedup -> SimHash near-dedup -> benchmark decontamination ->
BPE.  Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next
one works on what it kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldlens.llm import decontam, linededup, queries, simhash, toxicity
from fieldlens.llm.common import read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    scored = toxicity.score(docs, queries.learned_toxicity(spark, docs, sf_dir), threshold=queries.TOXIC_FROM)
    return scored.where("predicted = 0").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated windows of lines lose their later occurrences; all rows stay."""
    out = linededup.dedup_lines(docs)
    n_chars = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    kept = simhash.keep_one_each(docs, shingle=queries.SHINGLE, max_bits=queries.MAX_BITS)
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    out = decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return out.where("NOT contaminated").select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of the decoded text."""
    return queries.token_digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_near),
    ("benchmark decontamination", drop_contaminated),
    ("BPE", tokenize),
]

#: Neither the trained model nor the vocabulary can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
