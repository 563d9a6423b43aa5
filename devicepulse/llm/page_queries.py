"""Queries of the operators on web pages and on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.llm import url_filter, vector_search, warc, whitening
from devicepulse.llm.common import table
from devicepulse.llm.registry import query


@query(
    """
WITH paid AS (
  SELECT page_id, coalesce(html, '') AS t, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
firsts AS (SELECT t, max(page_id) AS first FROM paid WHERE n >= 1000 GROUP BY t HAVING count(*) > 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(t) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM paid LEFT JOIN firsts USING (t)"""
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = warc.write(pages, warc.new_folder(spark))
    return warc.read(archives, payloads=False).drop("url", "payload")


@query()
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).drop("url")


@query(
    """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""
)
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_search.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    made = whitening.transform(vectors, model)
    explained = F.array(*[F.lit(float(x)) for x in model.explained]).cast("array<double>")
    return made.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
