"""Corpus pipeline: language ID, near-dedup, mixing to target weights, tokenising.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.llm import langid, mix, sentencepieces, simhash
from tonearm.llm.common import ship, table
from tonearm.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, without text or of no clear language go."""
    ship(spark)
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays: the smallest doc_id."""
    ship(spark)
    return simhash.keep_one(docs, words=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gives its target's words: documents repeat, leave or are cut at the budget."""
    return mix.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the pieces of every document of the mix."""
    ship(spark)
    tokens = sentencepieces.encode(docs)
    return tokens.select("row.doc_id", "row.lang", "row.source", F.size("token_ids").cast("long").alias("n_tokens"),
                         "token_ids")


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("sentencepiece", tokenise),
]

#: Learning, fingerprints and tokenising are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
