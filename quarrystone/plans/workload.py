"""The driver's tables seen as reports, devices and narratives.

Each projection is SQL text that Spark and DuckDB read alike, so a query and its oracle start from the same rows; the
operators under test come after it.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

COMPLETED = dt.date(2001, 8, 15)

REPORTS = """
SELECT CAST(o_orderkey AS STRING) AS mdr_report_key, CAST(o_orderdate AS DATE) AS date_received,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'DEATH' WHEN '2-HIGH' THEN ' injury ' WHEN '3-MEDIUM' THEN 'Malfunction'
            WHEN '4-NOT SPECIFIED' THEN '' ELSE CASE WHEN o_orderstatus = 'P' THEN 'D' ELSE 'OTHER' END END AS event_type,
       'snapshot-1' AS dataset_snapshot_id
FROM orders
"""
DEVICES = """
SELECT CAST(l_orderkey AS STRING) AS mdr_report_key, CAST(l_linenumber AS STRING) AS device_sequence_no,
       concat(' ', lower(p_type), ' ') AS device_report_product_code, p_brand AS brand_name, s_name AS manufacturer_d_name,
       'snapshot-1' AS dataset_snapshot_id
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
"""
NARRATIVES = """
SELECT CAST(conv_id AS STRING) AS mdr_report_key, CAST(turn AS STRING) AS mdr_text_key, role AS text_type_code, text AS foi_text,
       'b.txt' AS _source_filename, CAST(turn + 10 AS STRING) AS _source_line_number, 'snapshot-1' AS dataset_snapshot_id
FROM conversations
UNION ALL
SELECT CAST(conv_id AS STRING), CAST(turn AS STRING), 'copy', CASE WHEN turn = 1 THEN '  ' ELSE text END,
       CASE WHEN turn % 2 = 0 THEN 'a.txt' ELSE 'c.txt' END, CAST(turn + 9 AS STRING), 'snapshot-1'
FROM conversations WHERE conv_id % 3 = 0
"""
#: Documents dated over the three splits, some undated; a seventh of them report under the key of an earlier one.
DATED = """
SELECT doc_id, CAST(doc_id - CASE WHEN doc_id % 7 = 0 AND doc_id >= 150 THEN 150 ELSE 0 END AS BIGINT) AS report_id, text,
       CASE WHEN doc_id % 97 = 0 THEN CAST(NULL AS DATE) ELSE CAST(DATE '2024-07-01' + CAST(doc_id % 730 AS INT) AS DATE) END AS received
FROM documents
"""
ROLES = """
SELECT CAST(l_orderkey AS STRING) AS report_key, CAST(l_linenumber AS STRING) AS sequence_no, CAST(l_suppkey % 4 AS STRING) AS payload,
       CASE l_returnflag WHEN 'R' THEN 'device.txt' WHEN 'N' THEN 'device_ADD.txt' ELSE 'deviceChange.zip' END AS _source_filename,
       l_orderkey * 1000000 + l_partkey * 100 + CAST(l_quantity AS BIGINT) AS row_no
FROM lineitem
"""
#: Orders as strings: dates in both layouts, some malformed, some padded or blank.
STRINGS = """
SELECT CAST(o_orderkey AS STRING) AS report_key,
       CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN concat(' ', o_orderpriority, ' ') ELSE o_orderpriority END AS note,
       CASE o_orderkey % 6
         WHEN 0 THEN concat(lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/', CAST(year(o_orderdate) AS STRING))
         WHEN 1 THEN concat(CAST(year(o_orderdate) AS STRING), '/', CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING))
         WHEN 2 THEN concat('13/', CAST(day(o_orderdate) + 40 AS STRING), '/2020')
         WHEN 3 THEN concat('  ', CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING), ' ')
         WHEN 4 THEN '' ELSE 'unknown' END AS date_text
FROM orders
"""

VIEWS = {"w_reports": REPORTS, "w_devices": DEVICES, "w_narratives": NARRATIVES, "w_dated": DATED, "w_roles": ROLES, "w_strings": STRINGS}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def projected(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of a projection; its tables are bound as arguments, so no view outlives the query."""
    names = set(re.findall(r"\b(?:FROM|JOIN) (\w+)", sql))
    return spark.sql(re.sub(r"\b(FROM|JOIN) (\w+)", r"\1 {\2} AS \2", sql), **{n: table(spark, sf_dir, n) for n in names})


def oracle(*views: str) -> str:
    """The beginning of an oracle: projections as common table expressions."""
    return "WITH " + ", ".join(f"{v} AS ({VIEWS[v]})" for v in views)
