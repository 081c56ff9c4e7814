"""Report indicators, monthly cohorts and the robust volume change, as one declarative plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone import contracts as C
from quarrystone.functions import scalars as S

CATEGORIES = {"death": "reported_death_count", "injury": "reported_injury_count", "malfunction": "reported_malfunction_count", "other": "reported_other_count", "missing": "missing_event_type_count", "unrecognized": "unrecognized_event_type_count"}


def report_indicators(reports: DataFrame, devices: DataFrame) -> DataFrame:
    """One row per report and product code: the code, the raw event type and its category; a report without devices stays."""
    codes = devices.select(F.col("mdr_report_key").alias("_key"), S.product_code("device_report_product_code").alias("product_code")).distinct()
    joined = reports.join(codes, reports["mdr_report_key"] == codes["_key"], "left")
    return joined.select(
        "dataset_snapshot_id", S.text("mdr_report_key").alias("report_id"), F.col("date_received").try_cast("date").alias("date_received"), "product_code",
        S.text("event_type").alias("reported_event_type_raw"), S.outcome("event_type").alias("reported_severity_category")).distinct()


def monthly_cohorts(indicators: DataFrame) -> DataFrame:
    """Reports by product code and month, in all and by category; undated ones are left out."""
    counts = [F.count_if(F.col("reported_severity_category") == name).alias(column) for name, column in CATEGORIES.items()]
    return indicators.where("date_received IS NOT NULL").groupBy("product_code", S.month_of("date_received").alias("month")).agg(F.count("*").alias("report_count"), *counts)


def summary(indicators: DataFrame) -> DataFrame:
    return indicators.agg(F.count("*").alias("report_cohort_rows"), F.count_if(F.col("date_received").isNull()).alias("undated_rows"), F.min("date_received").alias("earliest"), F.max("date_received").alias("latest"))


def window_bounds(indicators: DataFrame, completed: dt.date) -> DataFrame:
    """One row: the latest complete month, and where the recent and the baseline window start.

    The latest complete month is the month of the last dated report or, if earlier, the one before the latest snapshot's
    completion.
    """
    day = F.lit(completed).cast("date")
    last = indicators.agg(F.least(S.month_of(F.max("date_received")), F.add_months(S.month_of(day), -1)).alias("latest_complete_month"), F.min("date_received").alias("earliest"))
    recent = F.add_months("latest_complete_month", 1 - C.RECENT_MONTHS)
    return last.select("latest_complete_month", recent.alias("recent_window_start"), F.add_months(recent, -C.BASELINE_MONTHS).alias("baseline_window_start"), "earliest")


def _months(bounds: DataFrame) -> DataFrame:
    return bounds.select("latest_complete_month", "recent_window_start", "baseline_window_start", F.explode(F.expr("sequence(baseline_window_start, latest_complete_month, interval 1 month)")).alias("month"))


def missing_months(monthly: DataFrame, bounds: DataFrame) -> DataFrame:
    """Months of the window in which no cohort at all has a report."""
    return _months(bounds).select("month").join(monthly.select("month").distinct(), "month", "left_anti")


def zero_filled(monthly: DataFrame, bounds: DataFrame) -> DataFrame:
    """(product_code, month, report_count, recent) for every cohort seen in the window and every month of it.

    ``bounds`` is one row, so the months are too few to matter and Spark broadcasts them by their size.
    """
    limits = bounds.select("latest_complete_month", "recent_window_start", "baseline_window_start")
    inside = monthly.join(F.broadcast(limits), F.col("month").between(F.col("baseline_window_start"), F.col("latest_complete_month")))
    counts = inside.groupBy("product_code").agg(F.map_from_entries(F.collect_list(F.struct("month", "report_count"))).alias("counts"), *(F.first(c).alias(c) for c in limits.columns))
    grid = counts.withColumn("month", F.explode(F.expr("sequence(baseline_window_start, latest_complete_month, interval 1 month)")))
    return grid.select("product_code", "month", F.coalesce(F.try_element_at("counts", F.col("month")), F.lit(0)).alias("report_count"), (F.col("month") >= F.col("recent_window_start")).alias("recent"), *limits.columns)


def _median(values: Column) -> Column:
    """Median of an array of exactly ``BASELINE_MONTHS`` numbers."""
    ordered, half = F.array_sort(values), C.BASELINE_MONTHS // 2
    return (F.element_at(ordered, half) + F.element_at(ordered, half + 1)) / 2 if C.BASELINE_MONTHS % 2 == 0 else F.element_at(ordered, half + 1).cast("double")


def volume_change(monthly: DataFrame, bounds: DataFrame) -> DataFrame:
    """The recent three months of every cohort against the median and MAD of the twelve before, zeros filled in.

    Only the counts of one window meet in a row, fifteen numbers at most, so the whole computation is one shuffle by cohort.
    """
    grid = zero_filled(monthly, bounds)
    windows = grid.groupBy("product_code", "baseline_window_start", "recent_window_start", "latest_complete_month").agg(
        F.collect_list(F.when(~F.col("recent"), F.col("report_count").cast("double"))).alias("baseline"), F.sum(F.when(F.col("recent"), F.col("report_count")).otherwise(0)).alias("recent_total_reports"))
    scored = windows.withColumn("median", _median(F.col("baseline")))
    scored = scored.withColumn("mad", _median(F.transform("baseline", lambda x: F.abs(x - F.col("median")))))
    average = F.col("recent_total_reports") / F.lit(float(C.RECENT_MONTHS))
    z = (average - F.col("median")) / F.greatest(F.lit(C.MAD_FACTOR) * F.col("mad"), F.lit(C.SCALE_FLOOR))
    extra = F.col("recent_total_reports") - F.col("median") * C.RECENT_MONTHS
    return scored.select(
        "product_code", "baseline_window_start", F.add_months("recent_window_start", -1).alias("baseline_window_end"), "recent_window_start", F.col("latest_complete_month").alias("recent_window_end"),
        F.col("median").alias("baseline_median_monthly_reports"), F.col("mad").alias("baseline_mad_monthly_reports"), "recent_total_reports", average.alias("recent_average_monthly_reports"),
        extra.alias("additional_reports_vs_baseline"), z.alias("robust_z_score"), (extra >= C.EXTRA_FLAG).alias("minimum_count_increase_met"), ((z >= C.Z_FLAG) & (extra >= C.EXTRA_FLAG)).alias("report_volume_change_flag"))


def checked_volume_change(monthly: DataFrame, bounds: DataFrame) -> DataFrame:
    """:func:`volume_change`, after an error where the baseline is not covered or a month has no reports at all."""
    row = bounds.first()
    if row is None or row.latest_complete_month is None:
        raise ValueError("no dated reports")
    if row.earliest.replace(day=1) > row.baseline_window_start:
        raise ValueError("reports do not cover the whole baseline")
    gaps = [str(r.month) for r in missing_months(monthly, bounds).orderBy("month").collect()]  # fifteen months at most
    if gaps:
        raise ValueError(f"months without reports: {', '.join(gaps)}")
    return volume_change(monthly, bounds)
