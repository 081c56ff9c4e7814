"""Bronze to Silver: blanks, dates, provenance and content hashes in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone import contracts
from quarrystone.functions import scalars as S


def failed_dates(silver: DataFrame, dates: tuple[str, ...]) -> Column:
    """Aggregate: how many date values are there but could not be parsed, over all date columns present."""
    present = [d for d in dates if f"{d}_raw" in silver.columns]
    bad = [F.count_if(F.col(f"{d}_raw").isNotNull() & F.col(d).isNull()) for d in present]
    return sum(bad[1:], bad[0]).cast("long") if bad else F.lit(0).cast("long")


def normalize_bronze(bronze: DataFrame, family: contracts.Family, snapshot_id: str) -> DataFrame:
    """Snake-case columns with blanks as null, each date as ``<name>_raw`` and parsed, provenance, snapshot and content hash.

    The hash covers every value but provenance, raw and parsed dates included, in column order.
    """
    frame = bronze.toDF(*contracts.normalized(bronze.columns))
    contracts.require(frame.columns, family.required, family.name)
    values: list[Column] = []
    names: list[str] = []
    for c in frame.columns:
        if c in contracts.PROVENANCE:
            continue
        raw = S.blank_to_null(c)
        if c in family.dates:
            names += [f"{c}_raw", c]
            values += [raw, S.parsed_date(c)]
        else:
            names.append(c)
            values.append(raw)
    carried = [F.col(c) for c in contracts.PROVENANCE if c in frame.columns]
    return frame.select(*(v.alias(n) for v, n in zip(values, names, strict=True)), *carried, F.lit(snapshot_id).alias("dataset_snapshot_id"), S.content_hash(values).alias("record_content_hash"))
