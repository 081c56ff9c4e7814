"""The corpus pipeline: five operators over ``documents``, each stage written as Parquet and read again by the next.

All stages but the last return the columns of ``documents``; the last adds the token ids
and the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import lines, mixing, scratch, simhash, toxicity
from quarrystone.llm.queries_bpe import tokenizer

ORACLE_SQL = None  # fitted models, fingerprints and tokens are beyond SQL; tests hold the stages against plain versions
#: Targets of the mixing stage lie this near to the domains' own shares (1: as they are, 0: all equal).
POWER = 0.9


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return toxicity.keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds."""
    return lines.deduped(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return simhash.first_of_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that expected tokens of each language and quality match the targets; none is lost."""
    labelled = mixing.language_and_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.resampled(docs, labelled, power=POWER, keep_all=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids in ``ids`` and, in ``decoded``, the text that the decoder makes of these."""
    made = tokenizer(spark).encode(docs, decoded="decoded")
    return made.withColumn("decoded", F.col("decoded").cast("string"))


STAGES = [("toxicity", reject_toxic), ("line dedup", dedup_lines), ("SimHash near-dedup", dedup_near), ("mixing sources to target weights", mix), ("byte-level BPE", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
