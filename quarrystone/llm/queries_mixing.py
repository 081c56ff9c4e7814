"""Query ``op3_mixing``: the rate and copies of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import mixing


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labelled = mixing.language_and_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    made, report = mixing.mixed(docs.select("doc_id", "text"), labelled)
    domain = F.element_at(F.array(*map(F.lit, report["domains"])), F.array_position(F.array(*(F.col(f"p{k}") for k in range(len(report["domains"])))), F.greatest(*(F.col(f"p{k}") for k in range(len(report["domains"]))), F.lit(0.0))).cast("int"))
    return made.select(F.col("id").alias("doc_id"), "tokens", domain.alias("domain"), "rate", "copies")
