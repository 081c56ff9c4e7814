"""Query ``op9_simhash``: fingerprints and components of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import simhash


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash.simhash_groups(docs).select("doc_id", simhash.hexadecimal().alias("fingerprint"), F.col("component").alias("component_id"))
