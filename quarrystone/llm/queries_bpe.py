"""Query ``op5_bpe``: token ids of every document and the text they decode to, as digests."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import bpe

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def tokenizer(spark: SparkSession, path: str | None = None) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, path or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = tokenizer(spark)
    made = own.encode(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), decoded="decoded")
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
