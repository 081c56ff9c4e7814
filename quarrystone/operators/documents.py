"""Report documents, their modeling form, and corpora."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone import contracts as C
from quarrystone.functions import scalars as S

CLEANING = "narrative-clean-v1"


def device_metadata(devices: DataFrame) -> DataFrame:
    """Per report the distinct sorted product codes, brands and manufacturers; columns that a source lacks are empty."""
    brand, maker = C.first_present(C.BRAND_COLUMNS, devices.columns), C.first_present(C.MANUFACTURER_COLUMNS, devices.columns)

    def listed(name: str | None, alias: str) -> Column:
        return (S.sorted_set(F.col(name)) if name else F.first(F.array().cast("array<string>"))).alias(alias)

    return devices.groupBy(F.col("mdr_report_key").alias("_device_report")).agg(listed("device_report_product_code", "product_codes"), listed(brand, "brand_names"), listed(maker, "manufacturers"))


def narrative_evidence(narratives: DataFrame) -> DataFrame:
    """One row per report and text key: the first by file, line as a number, line, type and text."""
    line = F.col("_source_line_number")
    order = [F.col("_source_filename"), line.try_cast("long"), S.text(line), F.col("text_type_code"), F.col("foi_text")]
    first = Window.partitionBy("mdr_report_key", "mdr_text_key").orderBy(*(c.asc_nulls_last() for c in order))
    ranked = narratives.withColumn("_rank", F.row_number().over(first)).where("_rank = 1")
    return ranked.select("mdr_report_key", "mdr_text_key", "text_type_code", "foi_text", "_source_filename", "_source_line_number")


def report_documents(reports: DataFrame, devices: DataFrame, narratives: DataFrame) -> DataFrame:
    """A row per report and narrative; devices are reduced to one row a report before the join."""
    reports = reports.select("mdr_report_key", "event_type", "date_received", "dataset_snapshot_id")  # other tables share further names
    meta, texts = device_metadata(devices), narrative_evidence(narratives).withColumnRenamed("mdr_report_key", "_text_report")
    joined = reports.join(meta, reports["mdr_report_key"] == meta["_device_report"], "left").join(texts, reports["mdr_report_key"] == texts["_text_report"], "left")
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("mdr_report_key").alias("report_id"), F.col("event_type").alias("reported_event_type"), F.col("date_received").try_cast("date").alias("date_received"),
        *(F.coalesce(c, none).alias(c) for c in ("product_codes", "brand_names", "manufacturers")), S.text("dataset_snapshot_id").alias("dataset_snapshot_id"),
        "mdr_text_key", "text_type_code", "foi_text", "_source_filename", "_source_line_number")


def evidence_order(key: Column) -> Column:
    """Sorts text keys that are no numbers first, then by number, then by text."""
    return F.struct(F.coalesce(key.try_cast("long"), F.lit(-(2**63))).alias("number"), key.alias("key"))


def nested(rows: DataFrame) -> DataFrame:
    """One row per report with its narratives as an ordered array; a report without narratives has an empty one."""
    one = F.struct(evidence_order(F.col("mdr_text_key")).alias("place"), F.concat(F.lit("narrative:"), F.col("mdr_text_key")).alias("evidence_id"), "text_type_code", "foi_text", "_source_filename", "_source_line_number")
    held = F.array_sort(F.collect_list(F.when(F.col("mdr_text_key").isNotNull(), one)))
    keys = ["report_id", "dataset_snapshot_id", "reported_event_type", "date_received", "product_codes", "brand_names", "manufacturers"]
    return rows.groupBy(*keys).agg(held.alias("narratives"))


def lookup(documents: DataFrame, report_id: str) -> DataFrame:
    """The document of one report; the filter reaches the scan. None is a LookupError."""
    found = documents.where(F.col("report_id") == F.lit(report_id))
    if found.isEmpty():
        raise LookupError(report_id)
    return found


def modeling_documents(documents: DataFrame, cleaning: str = CLEANING) -> DataFrame:
    """Documents with cleaned narratives; blank narratives go, and reports left without any."""

    def prepared(n: Column) -> Column:
        parts = {
            "report_id": S.text("report_id"), "dataset_snapshot_id": S.text("dataset_snapshot_id"), "evidence_id": n["evidence_id"], "text_type_code": n["text_type_code"], "source_filename": S.text(n["_source_filename"]),
            "source_line_number": S.text(n["_source_line_number"]), "source_text_sha256": F.sha2(n["foi_text"], 256), "modeling_text": n["clean"], "cleaning_version": F.lit(cleaning)}
        return F.struct(*(v.alias(k) for k, v in parts.items()))

    each = documents.select("report_id", F.explode("narratives").alias("n"))
    each = each.select(F.col("report_id").alias("_id"), F.col("n").withField("clean", S.clean(F.col("n.foi_text"))).alias("n")).where("n.clean IS NOT NULL AND n.clean <> ''")
    texts = each.groupBy("_id").agg(F.array_sort(F.collect_list("n")).alias("kept"))
    joined = documents.drop("narratives").join(texts, F.col("report_id") == F.col("_id"))
    made = joined.withColumn("narratives", F.transform("kept", prepared)).withColumn("modeling_text", F.array_join(F.transform("narratives", lambda n: n["modeling_text"]), "\n\n"))
    return made.withColumn("cleaning_version", F.lit(cleaning)).select(C.DOCUMENT.fieldNames())


def corpus_counts(rows: DataFrame) -> DataFrame:
    """From :func:`report_documents`: reports seen, documents and narratives written, blank narratives left out."""
    there = F.col("mdr_text_key").isNotNull()
    filled = there & (F.coalesce(S.clean("foi_text"), F.lit("")) != "")
    per = rows.groupBy("report_id").agg(F.count_if(filled).alias("kept"), F.count_if(there & ~filled).alias("blank"))
    return per.agg(F.count("*").alias("reports_seen"), F.count_if(F.col("kept") > 0).alias("documents_written"), F.sum("kept").alias("narratives_written"), F.sum("blank").alias("blank_omitted"))


def overlapping_keys(sources: dict[str, DataFrame], key: str = "mdr_report_key") -> DataFrame:
    """Keys found in more than one source, with the number of sources."""
    parts = [df.select(F.lit(name).alias("source"), F.col(key)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.count_distinct("source").alias("sources")).where("sources > 1")


def research_corpus(sources: dict[str, DataFrame], key: str = "report_id") -> DataFrame:
    """The union of at least two corpora without a report in common."""
    if len(sources) < 2:
        raise ValueError("a research corpus needs at least two sources")
    if not overlapping_keys(sources, key).isEmpty():
        raise ValueError("sources share report keys")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [sources[name] for name in sorted(sources)])


def provenance(rows: DataFrame, column: str = "dataset_snapshot_id") -> DataFrame:
    """One row: rows, null and blank ids, and the least and greatest id, in one pass."""
    value = S.text(column)
    return rows.agg(F.count("*").alias("rows"), F.count_if(value.isNull()).alias("nulls"), F.count_if(F.trim(value) == "").alias("blanks"), F.min(value).alias("least"), F.max(value).alias("greatest"))


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def open_snapshot(spark, folder: str) -> dict[str, DataFrame]:  # noqa: ANN001
    """Registers reports, devices, patients, narratives and report_documents as views for SQL, after checking them.

    Each table may have either of its two names. Snapshot ids must be there, single and the same in all tables, and report
    keys must be unique.
    """
    views, ids = {}, set()
    for view, names in C.VIEWS.items():
        for name in names:
            try:
                views[view] = spark.read.parquet(f"{folder}/{name}.parquet")
                break
            except Exception as error:  # noqa: BLE001 - the reader has one error type for many causes
                if "PATH_NOT_FOUND" not in str(error):
                    raise
        else:
            raise FileNotFoundError(f"{folder}: neither {' nor '.join(names)}")
        C.require(views[view].columns, ("mdr_report_key", "dataset_snapshot_id"), view)
        row = provenance(views[view]).first()
        if row["rows"] and (row.nulls or row.blanks or row.least != row.greatest):
            raise ValueError(f"{view}: snapshot ids are missing or differ")
        if row["rows"]:
            ids.add(row.least)
    if len(ids) > 1:
        raise ValueError("tables belong to different snapshots")
    if not repeated_keys(views["reports"], "mdr_report_key").isEmpty():
        raise ValueError("report keys repeat")
    views["report_documents"] = report_documents(views["reports"], views["devices"], views["narratives"])
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
