"""Reconciliation of base, addition and change rows by business key.

Within a role, rows of a key with one content hash collapse to the lowest row, and keys with several hashes are quarantined
whole. Among what is left the highest role wins; a key missing from a role is not a deletion. Both steps are windows over the
same keys: rows are shuffled by key once and Spark reuses that distribution for the coarser window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.functions import scalars as S

ORDER = "_row_order"


def with_order(rows: DataFrame) -> DataFrame:
    """Adds the physical row order of a Parquet scan, by file and position."""
    return rows.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(ORDER))


def key_stats(rows: DataFrame, keys: list[str], role: str = "_source_role", content: str = "record_content_hash", order: str = ORDER) -> DataFrame:
    """(role, keys, row_count, hash_count, first_row) of each key in each role."""
    return rows.groupBy(role, *keys).agg(F.count("*").alias("row_count"), F.count_distinct(content).alias("hash_count"), F.min(order).alias("first_row"))


def _marked(rows: DataFrame, keys: list[str], role: str, content: str, order: str) -> DataFrame:
    """Rows with ``_clash`` (the key has several contents in this role) and ``_place`` (position within the key and role)."""
    per_role = Window.partitionBy(*keys, role)
    clash = ~F.min(content).over(per_role).eqNullSafe(F.max(content).over(per_role))
    return rows.select("*", clash.alias("_clash"), F.row_number().over(per_role.orderBy(F.col(order).asc_nulls_last())).alias("_place"))


def _candidates(rows: DataFrame, keys: list[str], role: str, content: str, order: str) -> DataFrame:
    return _marked(rows, keys, role, content, order).where(~F.col("_clash") & (F.col("_place") == 1)).drop("_clash", "_place")


def selected(rows: DataFrame, keys: list[str], role: str = "_source_role", content: str = "record_content_hash", order: str = ORDER) -> DataFrame:
    """The winning row of every key, with its role's rank as ``selected_priority``; order columns are dropped."""
    ranked = _candidates(rows, keys, role, content, order).withColumn("selected_priority", S.priority(role))
    best = Window.partitionBy(*keys).orderBy(F.col("selected_priority").desc())
    return ranked.withColumn("_best", F.row_number().over(best)).where("_best = 1").drop("_best", order)


def conflicts(rows: DataFrame, keys: list[str], role: str = "_source_role", content: str = "record_content_hash", order: str = ORDER) -> DataFrame:
    """All rows of keys that have several contents within one role, with ``_conflict_reason``."""
    clashing = _marked(rows, keys, role, content, order).where("_clash").drop("_clash", "_place", order)
    return clashing.withColumn("_conflict_reason", F.lit("conflicting_duplicate"))


def key_priority(rows: DataFrame, keys: list[str], role: str = "_source_role") -> DataFrame:
    """The highest rank at which each key occurs."""
    return rows.groupBy(*keys).agg(F.max(S.priority(role)).alias("selected_priority"))


def stats(rows: DataFrame, keys: list[str], role: str = "_source_role", content: str = "record_content_hash", order: str = ORDER) -> DataFrame:
    """Per role: inserted, updated, unchanged, superseded keys, collapsed rows, quarantined keys and rows.

    Inserted keys have no row of a lower role; updated and unchanged ones are compared with the best lower row; superseded
    ones also have a row of a higher role.
    """
    ranked = _candidates(rows, keys, role, content, order).withColumn("_rank", S.priority(role))
    below = Window.partitionBy(*keys).orderBy("_rank")
    ranked = ranked.select(role, "_rank", content, F.lag("_rank").over(below).alias("_lower"), F.lag(content).over(below).alias("_lower_hash"), F.lead("_rank").over(below).alias("_higher"))

    def counted(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    same = F.col(content).eqNullSafe(F.col("_lower_hash"))
    moved = ranked.groupBy(role).agg(
        counted(F.col("_lower").isNull(), "inserted"), counted(F.col("_lower").isNotNull() & ~same, "updated"),
        counted(F.col("_lower").isNotNull() & same, "unchanged"), counted(F.col("_higher").isNotNull(), "superseded"))
    by_key = key_stats(rows, keys, role, content, order)
    doubled = by_key.groupBy(role).agg(
        F.coalesce(F.sum(F.when((F.col("hash_count") == 1) & (F.col("row_count") > 1), F.col("row_count") - 1)), F.lit(0)).alias("collapsed"),
        counted(F.col("hash_count") > 1, "quarantined_keys"), F.coalesce(F.sum(F.when(F.col("hash_count") > 1, F.col("row_count"))), F.lit(0)).alias("quarantined_rows"))
    return doubled.join(moved, role, "left").na.fill(0)


def selected_rows(stats_: DataFrame, by: str = "_source_role") -> DataFrame:
    """The net number of rows a table gains from its roles: inserted + updated + unchanged - superseded."""
    return stats_.agg(F.sum(F.col("inserted") + F.col("updated") + F.col("unchanged") - F.col("superseded")).alias("selected_rows"))


def reconcile(rows: DataFrame, keys: list[str], quarantine: bool = True, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(winning rows in key order, quarantined rows); without ``quarantine`` a conflict is an error."""
    held = conflicts(rows, keys, **columns)
    if not quarantine and not held.isEmpty():
        raise ValueError("rows of one business key differ within a role")
    return selected(rows, keys, **columns).orderBy(*(F.col(k).asc_nulls_last() for k in keys)), held
