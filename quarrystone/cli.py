"""Command line: ``python -m quarrystone.cli <command> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys
from pathlib import Path

from pyspark.sql import functions as F

from quarrystone import publish
from quarrystone.functions import scalars as S
from quarrystone.operators import duplicates, signals, tfidf
from quarrystone.session import session
from quarrystone.sources import audit

VERSION = "0.1.0"


def _narratives(corpus):  # noqa: ANN001, ANN202
    each = corpus.select("report_id", "date_received", F.explode("narratives").alias("n")).select("report_id", "date_received", F.concat_ws("|", "report_id", "n.evidence_id").alias("narrative_id"), "n.modeling_text")
    return duplicates.narratives(each, "narrative_id", "report_id", "modeling_text", "date_received")


def _signals(spark, lake, corpus: str, completed: str) -> dict:  # noqa: ANN001
    def build(folder: Path) -> dict:
        sources = json.loads((lake.root / "corpora" / corpus / "narrative-clean-v1" / "manifest.json").read_text())["source_snapshot_ids"]
        tables = [[spark.read.parquet(str(lake.silver(s) / f"{name}.parquet")) for s in sources] for name in ("master", "device")]
        reports, devices = (_union(t) for t in tables)
        signals.report_indicators(reports, devices).write.parquet(str(folder / "report_indicators.parquet"))
        indicators = spark.read.parquet(str(folder / "report_indicators.parquet"))
        signals.monthly_cohorts(indicators).write.parquet(str(folder / "monthly_cohorts.parquet"))
        monthly = spark.read.parquet(str(folder / "monthly_cohorts.parquet"))
        bounds = signals.window_bounds(indicators, dt.date.fromisoformat(completed))
        change = signals.checked_volume_change(monthly, bounds)
        change.repartition(1).sortWithinPartitions(F.col("product_code").asc_nulls_first()).write.option("compression", "zstd").parquet(str(folder / "volume_change.parquet"))
        return {k: str(v) for k, v in (signals.summary(indicators).first().asDict() | bounds.first().asDict()).items()}

    return lake.publish(lake.root / "features" / corpus / "reported-severity-volume-v1", build)


def _union(frames):  # noqa: ANN001, ANN202
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _audit(spark, lake, corpus: str) -> dict:  # noqa: ANN001
    def build(folder: Path) -> dict:
        rows = _narratives(publish.read_corpus(spark, lake, corpus))
        made = {
            "exact_groups": duplicates.exact_groups(rows).orderBy("text_hash"),
            "exact_members": duplicates.exact_members(rows).orderBy("text_hash", "narrative_id"),
            "report_key_overlaps": duplicates.key_overlaps(rows).orderBy("report_id"),
            "near_pairs": duplicates.near_pairs(rows).orderBy("target", "prior"),
        }
        for name, df in made.items():  # rows in order, keys in order: two runs write the same lines
            df.select(sorted(df.columns)).write.json(str(folder / f"{name}.jsonl"))
        return {name: spark.read.text(str(folder / f"{name}.jsonl")).count() for name in made}

    return lake.publish(lake.root / "audits" / corpus / "exact-jaccard-v1", build)


def _tfidf(spark, lake, corpus: str, sample: int) -> dict:  # noqa: ANN001
    def build(folder: Path) -> dict:
        docs = publish.read_corpus(spark, lake, corpus).select("report_id", "modeling_text", S.split_of("date_received").alias("split"))
        made = tfidf.baseline(docs, sample)
        for name, df in made.items():
            df.write.parquet(str(folder / f"{name}.parquet"))
        return {r["split"]: r["documents"] for r in made["split_counts"].collect()}

    return lake.publish(lake.root / "features" / corpus / f"tfidf-{sample}-v1", build)


def main(argv: list[str] | None = None) -> int:
    root = argparse.ArgumentParser(prog="quarrystone")
    root.add_argument("--data-root", default=os.environ.get("QUARRYSTONE_DATA_ROOT", "data"))
    root.add_argument("--master", help="Spark master, where spark-submit does not set it")
    commands = root.add_subparsers(dest="command", required=True)
    commands.add_parser("version")
    for name in ("ingest-local", "ingest-roles", "ingest-history"):
        p = commands.add_parser(name)
        p.add_argument("snapshot")
        p.add_argument("sources", nargs="+")
    commands.add_parser("audit-local").add_argument("folder")
    commands.add_parser("build-corpus").add_argument("snapshot")
    commands.add_parser("build-research-corpus").add_argument("snapshots", nargs="+")
    p = commands.add_parser("build-signals")
    p.add_argument("corpus")
    p.add_argument("--completed", required=True, help="date on which the latest source snapshot was complete")
    p = commands.add_parser("build-tfidf")
    p.add_argument("corpus")
    p.add_argument("--sample", type=int, default=tfidf.SAMPLE)
    commands.add_parser("audit-duplicates").add_argument("corpus")
    commands.add_parser("republish").add_argument("snapshot")
    p = commands.add_parser("sql")
    p.add_argument("snapshot")
    p.add_argument("text")
    args = root.parse_args(argv)
    if args.command == "version":
        print(VERSION)
        return 0
    lake = publish.Lake(args.data_root)
    if args.command == "audit-local":
        found = audit.audit_folder(args.folder)
        print(json.dumps(found, indent=1))
        return int(any(not f["passed"] for f in found))
    spark = session(args.master)
    if args.command.startswith("ingest"):
        made = publish.ingest(spark, lake, args.snapshot, args.sources, roles=args.command != "ingest-local", current=args.command != "ingest-history")
        print(json.dumps({"snapshot_id": made.snapshot_id, "status": made.status, "tables": made.tables}))
    elif args.command == "build-corpus":
        print(json.dumps(publish.build_corpus(spark, lake, args.snapshot)))
    elif args.command == "build-research-corpus":
        print(publish.build_research_corpus(spark, lake, args.snapshots))
    elif args.command == "build-signals":
        print(json.dumps(_signals(spark, lake, args.corpus, args.completed)))
    elif args.command == "build-tfidf":
        print(json.dumps(_tfidf(spark, lake, args.corpus, args.sample)))
    elif args.command == "audit-duplicates":
        print(json.dumps(_audit(spark, lake, args.corpus)))
    elif args.command == "republish":
        print(json.dumps(publish.republish(spark, lake, args.snapshot)))
    elif args.command == "sql":
        publish.documents.open_snapshot(spark, str(lake.silver(args.snapshot)))
        spark.sql(args.text).show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
