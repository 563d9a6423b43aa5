"""Queries of the operators on document texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.llm import (
    alignment,
    bpe,
    jaccard_join,
    mixing,
    packing,
    personal_data,
    quality_model,
    quality_rules,
    substring_dedup,
)
from devicepulse.llm.coders import ByteLevel, Coder, Pieces
from devicepulse.llm.common import stored, table
from devicepulse.llm.registry import query


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_digests(docs: DataFrame, vocabulary) -> DataFrame:
    """Encode, then decode what was encoded, and give both as digests."""
    coded = bpe.encode(docs.select("doc_id", "text"), vocabulary, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe_digests(docs, bpe.load(docs, vocabulary_path()))


def _rules_sql() -> str:
    word = r"[^\x20\x09-\x0D]+"
    fails = " OR ".join(f"({r.fails})" for r in quality_rules.RULES if r.name in quality_rules.PRODUCTION.rules)
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS row FROM documents),
parts AS (
  SELECT doc_id, row, t, regexp_extract_all(t, '{word}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
  FROM texts),
windows AS (
  SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM parts)),
twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS place FROM twice)
  GROUP BY row),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(length(regexp_replace(t, '[^!]+', '', 'g')) AS BIGINT) AS n_exclamations
  FROM parts LEFT JOIN covered USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT ({fails}) AS kept
FROM measured"""


@query(_rules_sql())
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base rules are part of every policy, so a document that fails one is never kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = quality_rules.POLICIES[0]
    return quality_rules.ledger(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes(base)).alias("base_failed"),
        quality_rules.passes(quality_rules.PRODUCTION).alias("kept"),
    )


@query()
def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on labelled documents outside the held-out fifth of ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    labels = labels.where(~held_out & F.col("label").isNotNull())
    # The texts are read once: both the fit and the scores start from the stored statistics.
    statistics = stored(quality_model.with_statistics(docs), "statistics")
    model = quality_model.fit(statistics.join(labels, "doc_id"))
    return statistics.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query()
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each passage of a document that other documents hold too."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).drop("source")


@query()
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.detect(docs)
    counts = [f"n_{k}" for k in personal_data.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query()
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.link_documents(docs, jaccard_join.Join(width=4, share=85))


@query()
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bytes_, pieces = Coder(spark, vocabulary_path(), ByteLevel), Coder(spark, vocabulary_path("piece_bpe_32k.model"), Pieces)
    # The groups are only wanted as digests, which are much shorter to store.
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    index = alignment.index(docs, bytes_, pieces).withColumn("groups", digest)
    found = alignment.scored_documents(stored(index, "alignment"))
    counts = [*alignment.COUNTS, "n_best", "count_sum"]
    return found.select("doc.doc_id", *counts, F.col("groups").alias("groups_sha256"))


@query()
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.cut(docs, Coder(spark, vocabulary_path(), ByteLevel))
    # Tokens are not moved: the packing needs lengths only.
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("tokens").alias("ids_crc32"))
    return packing.pack(slim)
