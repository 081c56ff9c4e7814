"""Query ``op6_paragraph_dedup``: every paragraph that has an equal or near copy, with its cluster, and every repeated passage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import paragraphs


def op6_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = paragraphs.copies(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("doc").alias("doc_id"), "line", "start", "end", F.col("cluster_doc").alias("cluster_doc_id"), "cluster_line", "kept")
