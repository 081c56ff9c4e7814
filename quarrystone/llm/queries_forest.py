"""Query ``op1_embedding_forest``: links and components of every vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm import forest


def op1_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = forest.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return made.withColumnRenamed("component", "component_id")


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
c AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
