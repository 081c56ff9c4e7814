"""Query ``op7_fingerprints``: every document's fingerprint against its edited text's and its successor's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import fingerprints


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints.compare_with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
