"""From raw documents to packed training sequences: five stages, each a table that the next one reads.

language          documents without a recognisable language go
near_duplicates   of each group of similar documents (5-word shingles, Jaccard 0.8) one stays
decontamination   documents with a benchmark passage go
secrets           secrets in the texts are replaced by a mark
packing           the token ids of each document are placed in sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetflow.llm import decontaminate, jaccard, language, packing, secret_scan
from sheetflow.llm.common import stored, table
from sheetflow.llm.queries import tokenizer


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, language.fit(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, rule=jaccard.Rule(words=5, num=80, den=100))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs, length="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, tokenizer("word_bpe_49k.json"))).withColumnRenamed("key", "doc_id")


STAGES = [
    ("language", identified),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

# A tokenizer and a trained classifier are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
