"""From raw documents to token digests: the stages of a training-data pipeline in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.llm import bpe, jaccard_join, mixing, personal_data, quality_rules
from devicepulse.llm.common import stored, table
from devicepulse.llm.text_queries import bpe_digests, vocabulary_path


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    return quality_rules.apply(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies: five-word n-grams, a similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked; `n_chars`, where there is one, is counted anew."""
    made = personal_data.mask(docs)
    return made.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else made


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    return bpe_digests(docs, bpe.load(docs, vocabulary_path()))


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_copies),
    ("PII", privacy),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

# Token ids, links of near copies and spans of a trained model have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are stored and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
