"""Quality checks: each is one row (check, level, passed, message, numerator, denominator, threshold, observed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone import contracts as C
from quarrystone.functions import scalars as S

BLOCKING, WARNING = "blocking", "warning"


def _share(numerator: Column, denominator: Column, empty: float | Column = 0.0) -> Column:
    return F.when(denominator != 0, numerator.cast("double") / denominator).otherwise(empty)


def _row(counts: DataFrame, check: str, level: Column | str, passed: Column, good: str, bad: Column | str, threshold: Column | float, observed: Column) -> DataFrame:
    """Turns a row with ``numerator`` and ``denominator`` into a result."""
    level, bad = (F.lit(x) if isinstance(x, str) else x for x in (level, bad))
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return counts.select(
        F.lit(check).alias("check"), level.alias("level"), passed.alias("passed"), F.when(passed, good).otherwise(bad).alias("message"),
        F.col("numerator").cast("double").alias("numerator"), F.col("denominator").cast("double").alias("denominator"), threshold.cast("double").alias("threshold"), observed.cast("double").alias("observed"))


def _graded(counts: DataFrame, check: str, limit: float, none: str, some: str, many: str) -> DataFrame:
    """None is a pass, up to ``limit`` a failed warning, more a blocking failure."""
    seen, share = F.col("numerator"), _share(F.col("numerator"), F.col("denominator"))
    level = F.when((seen == 0) | (share <= limit), WARNING).otherwise(BLOCKING)
    return _row(counts, check, level, seen == 0, none, F.when(share <= limit, some).otherwise(many), limit, share)


def row_conservation(counts: DataFrame) -> DataFrame:
    """``counts`` is a row (seen, accepted, rejected)."""
    made = counts.select((F.col("accepted") + F.col("rejected")).alias("numerator"), F.col("seen").alias("denominator"))
    same = F.col("numerator") == F.col("denominator")
    return _row(made, "row_conservation", BLOCKING, same, "all source rows are accounted for", "accepted and rejected rows do not add up to the rows seen", F.col("denominator"), F.col("numerator"))


def reject_fraction(counts: DataFrame) -> DataFrame:
    made = counts.select(F.col("rejected").alias("numerator"), F.col("seen").alias("denominator"))
    return _graded(made, "reject_fraction", C.REJECTS_LIMIT, "no rows were rejected", "some source rows were rejected", "the share of rejected rows exceeds the limit")


def uniqueness(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each business key; a null counts as the value '<NULL>'."""
    key = F.struct(*(F.coalesce(S.text(k), F.lit("<NULL>")) for k in keys))
    made = rows.agg((F.count("*") - F.count_distinct(key)).alias("numerator"), F.count("*").alias("denominator"))
    bad = F.concat(F.lit("found "), F.col("numerator").cast("string"), F.lit(" duplicate business key rows"))
    return _row(made, "business_key_uniqueness", BLOCKING, F.col("numerator") == 0, "business keys are unique", bad, 0.0, _share(F.col("numerator"), F.col("denominator")))


def drift(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Row counts of one table and file in two snapshots."""
    made = current.agg(F.count("*").alias("numerator")).join(previous.agg(F.count("*").alias("denominator")))  # one row each
    good = (F.col("denominator") == 0) | (F.col("numerator") >= F.col("denominator") * C.DRIFT_LIMIT)
    none = F.when(F.col("numerator") == 0, 1.0).otherwise(float("inf"))
    return _row(made, "row_count_drift", BLOCKING, good, "row count is within tolerance", "row count has fallen below tolerance", C.DRIFT_LIMIT, _share(F.col("numerator"), F.col("denominator"), none))


def orphans(children: DataFrame, parents: DataFrame, key: str = "mdr_report_key") -> DataFrame:
    """Child rows whose report key no parent has; blank keys are not counted."""
    known = parents.select(S.text(key).alias("_parent")).distinct()
    rows = children.select(S.text(key).alias("_child")).where("_child IS NOT NULL AND _child <> ''")
    joined = rows.join(known, F.col("_child") == F.col("_parent"), "left")
    made = joined.agg(F.count_if(F.col("_parent").isNull()).alias("numerator"), F.count("*").alias("denominator"))
    return _graded(made, "orphan_fraction", C.ORPHANS_LIMIT, "no orphan keys found", "some child rows have no report", "the share of orphan rows exceeds the limit")


def truncation(archive: DataFrame, converted: DataFrame, text: str = "value") -> DataFrame:
    """Line feeds in two copies of a text, each given as rows of text."""

    def lines(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.coalesce(F.sum(F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit("")))), F.lit(0)).alias(name))

    made = lines(converted, "numerator").join(lines(archive, "denominator"))  # one row each
    share = _share(F.col("numerator"), F.col("denominator"), F.when(F.col("numerator") == 0, 1.0).otherwise(0.0))
    return _row(made, "truncation_comparison", BLOCKING, (F.col("denominator") == 0) | (share >= C.TRUNCATION_LIMIT), "the converted text has the lines of the archive", "the converted text looks truncated", C.TRUNCATION_LIMIT, share)


def date_failures(counts: DataFrame) -> DataFrame:
    """``counts`` is a row with ``numerator``, the failed dates, and ``denominator``, the rows."""
    return _row(counts, "date_parse_failure_count", WARNING, F.col("numerator") == 0, "all dates were parsed", "some dates could not be parsed", 0.0, F.col("numerator"))


def conflict_count(held: DataFrame) -> DataFrame:
    made = held.agg(F.count("*").alias("numerator"), F.count("*").alias("denominator"))
    return _row(made, "reconciliation_conflicts", WARNING, F.col("numerator") == 0, "no conflicting rows", "conflicting rows were quarantined", 0.0, F.col("numerator"))


def required_tables(spark: SparkSession, present: list[str]) -> DataFrame:
    missing = sorted(set(C.FAMILIES) - set(present))
    n = len(C.FAMILIES)
    made = spark.range(1).select(F.lit(n - len(missing)).alias("numerator"), F.lit(n).alias("denominator"))
    return _row(made, "required_table_set", BLOCKING, F.lit(not missing), "all required tables are present", f"missing required tables: {', '.join(missing)}", float(n), F.col("numerator"))


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """All results with the table each is about and their order."""
    parts = [df.select(F.lit(i).alias("position"), F.lit(name.partition("|")[0]).alias("table"), "*") for i, (name, df) in enumerate(checks.items())]
    return reduce(DataFrame.unionByName, parts)


def gate(results: DataFrame) -> DataFrame:
    """One row: whether nothing blocks, and the counts."""
    failed = ~F.col("passed")
    return results.agg(F.count("*").alias("checks"), F.count_if(failed & (F.col("level") == BLOCKING)).alias("blocking"), F.count_if(failed & (F.col("level") == WARNING)).alias("warnings")).withColumn("promotable", F.col("blocking") == 0)


def markdown(results: DataFrame) -> str:
    """A report for people: blocking failures first."""
    rows = sorted(results.collect(), key=lambda r: (r.passed, r.level != BLOCKING, r.position))  # a few checks a table
    lines = ["# Quality report", "", "| table | check | level | result | observed | threshold | message |", "|---|---|---|---|---|---|---|"]
    lines += [f"| {r.table} | {r.check} | {r.level} | {'pass' if r.passed else 'FAIL'} | {r.observed:g} | {r.threshold:g} | {r.message} |" for r in rows]
    return "\n".join(lines) + "\n"
