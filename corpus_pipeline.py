"""A corpus pipeline: five stages, each applying one operator to all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm import jaccard_join, mixing, quality_rules, secret_scan, trie_bpe
from emberlake.llm.common import store_once, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows that links connect one stays, that with the smallest doc_id (rows without one last), then the smallest
    hash. Rows of one doc_id whose texts nothing links all stay, and so do rows without words."""
    return jaccard_join.first_of_each_group(docs, jaccard_join.JoinSettings(counts=3))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay or go as the target weights ask for; none is repeated, as its copies have gone before."""
    return mixing.resample(docs, table(spark, sf_dir, "labels"), mixing.MixSettings(upsample=False, most_rate=1.0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, and the ids of each text."""
    return trie_bpe.encode(docs, VOCABULARY).drop("decoded").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("secret scans", secrets),
          ("mixing sources to target weights", mix), ("BPE encoding and decoding", encode)]
#: Hashes of Spark's own, an iterative join and a tokenizer take part, so SQL can't express run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; each one's result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
