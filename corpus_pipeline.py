"""The corpus pipeline: documents in, encoded training documents out.

Each stage works on all rows that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm import bpe, lines, mixing, simhash, toxicity
from wordloom.llm.common import documents
from wordloom.staging import fresh_path

#: Share of the tokens that mixing passes on, and how much more a token of these paths counts than others.
MIX_PERCENT = 90
MIX_WEIGHTS = {"d0/en": 2, "d1/en": 2, "d2/en": 2}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from their labels, does not predict toxic."""
    model = toxicity.fit_on_training_rows(spark, docs, sf_dir)
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of a larger id also holds; all documents stay."""
    kept = lines.dedup_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose 3-word SimHash fingerprints link within 3 bits: the smallest id."""
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, budget=simhash.BUDGET)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen so that sources keep to their weights, each at most once."""
    mixed = mixing.mix(docs, mixing.domain_of_source(), MIX_PERCENT, MIX_WEIGHTS, max_epochs=1)
    return mixed.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to."""
    return bpe.encode_and_decode(docs, bpe.word_vocabulary()).select("doc_id", "lang", "source", "n_tokens", "token_ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The learned toxicity model has no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = fresh_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
