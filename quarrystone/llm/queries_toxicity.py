"""Query ``op8_toxicity``: a score for every document from a model that never saw the held-out third of the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import toxicity


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))
