"""Pipe-delimited sources as a Spark data source, and their split into Bronze rows and rejects.

A ZIP member cannot be split, so each archive is one partition, streamed line by line with its physical line numbers.
"""

from __future__ import annotations

import glob
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarrystone import contracts as C
from quarrystone.sources import archive

FIELD_LIMIT, RAW_LIMIT, PARSER_VERSION = 16 << 20, 2000, "1.0.0"
BLANK = r"^[\s\p{Z}\p{Cc}]*$"


class _File(InputPartition):
    def __init__(self, path: str, encoding: str | None) -> None:
        self.path, self.encoding = path, encoding


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        path = self.options["path"]
        found = sorted(glob.glob(path)) if "://" not in path else [path]
        if not found:
            raise archive.SourceError(f"no source at {path}")
        return [_File(p, self.options.get("encoding")) for p in found]

    def read(self, partition: _File) -> Iterator[tuple]:
        for number, line in enumerate(archive.lines(partition.path, partition.encoding), 1):
            fields = line.split("|") if line else []
            if any(len(f) > FIELD_LIMIT for f in fields):
                raise archive.SourceError(f"{partition.path}: a field of line {number} is too long")
            yield partition.path, number, fields, line


class PipeSource(DataSource):
    """``spark.read.format("pipe_lines")``: (path, line, fields, raw); option ``encoding`` skips the detection."""

    @classmethod
    def name(cls) -> str:
        return "pipe_lines"

    def schema(self) -> str:
        return "path string, line long, fields array<string>, raw string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))


def classified(rows: DataFrame, header: list[str], keys: tuple[str, ...]) -> DataFrame:
    """Adds ``reason``: field_count for another number of fields, missing_business_key for a blank key, else null."""
    names = C.normalized(header)
    places = [names.index(k) for k in keys]
    blank: Column = F.lit(False)
    for p in places:
        blank = blank | F.coalesce(F.try_element_at("fields", F.lit(p + 1)), F.lit("")).rlike(BLANK)
    return rows.withColumn("reason", F.when(F.size("fields") != len(header), "field_count").when(blank, "missing_business_key"))


def bronze_rows(judged: DataFrame, header: list[str], sha256: str, filename: str, role: str) -> DataFrame:
    """Accepted rows as strings under the header's names, with provenance."""
    values = [F.element_at("fields", i + 1).alias(n) for i, n in enumerate(header)]
    marks = [F.col("line").cast("string").alias(C.PROVENANCE[0]), *(F.lit(v).alias(n) for n, v in zip(C.PROVENANCE[1:], (sha256, filename, role), strict=True))]
    return judged.where("reason IS NULL").select(*values, *marks)


def reject_rows(judged: DataFrame, header: list[str], sha256: str, filename: str) -> DataFrame:
    """Rejected rows for a JSON lines file; raw rows are cut to a fixed length."""
    return judged.where("reason IS NOT NULL").select(
        F.col("line").alias("line_number"), "reason", F.lit(len(header)).alias("expected_fields"), F.size("fields").alias("actual_fields"), F.substring("raw", 1, RAW_LIMIT).alias("raw_row"),
        F.lit(sha256).alias("source_snapshot_sha256"), F.lit(filename).alias("source_filename"), F.lit(PARSER_VERSION).alias("parser_version"))


def parse_counts(judged: DataFrame) -> DataFrame:
    """One row (seen, accepted, rejected)."""
    return judged.agg(F.count("*").alias("seen"), F.count_if(F.col("reason").isNull()).alias("accepted"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))


def parse(spark: SparkSession, path: str, role: str | None = None) -> tuple[C.Family, DataFrame, DataFrame, DataFrame]:
    """(family, Bronze rows, rejects, counts) of one source file."""
    spark.dataSource.register(PipeSource)
    seen = archive.inspect(path)
    name = (seen.member or path).rpartition("/")[2]
    header = seen.header()
    family = C.detect_family(name, header)
    rows = spark.read.format("pipe_lines").option("path", path).option("encoding", archive.encoding_of(path)).load().where("line > 1")
    judged = classified(rows, header, family.key)
    return family, bronze_rows(judged, header, seen.sha256, name, role or C.detect_role(path.rpartition("/")[2])), reject_rows(judged, header, seen.sha256, name), parse_counts(judged)
