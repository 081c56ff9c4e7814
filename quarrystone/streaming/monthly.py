"""Monthly cohort counts over a stream of report indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.functions import scalars as S
from quarrystone.operators.signals import CATEGORIES


def streaming_cohorts(indicators: DataFrame, delay: str = "90 days", keys: tuple[str, ...] = ("report_id", "product_code")) -> DataFrame:
    """As :func:`quarrystone.operators.signals.monthly_cohorts` over a stream, each report and code counted once.

    A month's counts are final, and its state is dropped, once reports ``delay`` later have been seen; reports that come later
    than that are left out, as they would be counted again in a month already closed.
    """
    timed = indicators.where("date_received IS NOT NULL").withColumn("received_at", F.col("date_received").cast("timestamp")).withWatermark("received_at", delay)
    once = timed.dropDuplicatesWithinWatermark(list(keys))
    month = S.month_of("date_received").cast("timestamp").alias("month")
    counts = [F.count_if(F.col("reported_severity_category") == name).alias(column) for name, column in CATEGORIES.items()]
    return once.groupBy("product_code", F.window("received_at", "1 day").alias("day"), month).agg(F.count("*").alias("report_count"), *counts)


def by_month(daily: DataFrame) -> DataFrame:
    """The day rows that the stream has emitted, summed to months."""
    sums = [F.sum(c).alias(c) for c in ("report_count", *CATEGORIES.values())]
    return daily.groupBy("product_code", F.col("month").cast("date").alias("month")).agg(*sums)
