"""Query ``op2_secrets``: plain and decoded findings in every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import secrets


def _joined(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = secrets.with_findings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("findings", lambda f: f["depth"] == 0)

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: (f["depth"] == 0) & (f["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return made.select("doc_id", *map(count, secrets.KINDS), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("findings")).alias("spans"))
