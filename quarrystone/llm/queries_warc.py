"""Query ``op4_warc``: every page, as read back from the archives written for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm import scratch, warc


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.folder(spark, "warc")
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return warc.read_archives(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
q AS (SELECT page_id, strlen(h) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS owner,
             list_transform(range(0, 8), lambda i: CAST('0x' || substr(x, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS g FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(g, lambda n:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> 10) & 31) + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < owner THEN owner END AS refers_to
FROM q
"""
