"""Snapshots: staged, validated and promoted, with manifests as the point of commit.

A snapshot is written below ``staging/<id>``, checked, renamed to ``silver/<id>`` and named by ``manifests/current.json``.
Manifests are replaced atomically and record the phase reached, so an interrupted promotion is finished or failed by the next
run. Folders are on a file system with atomic renames; tables within them are ordinary Spark output.
"""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone import contracts as C
from quarrystone.operators import documents, normalize, quality, reconcile
from quarrystone.sources import pipe

RUNNING, VALIDATED, PROMOTED, FAILED = "running", "validated", "promoted", "failed"
BLOCK = 1 << 20


class Blocked(RuntimeError):
    """A snapshot that a blocking check keeps from being promoted."""


def fingerprint(value: object) -> str:
    """The first sixteen hex digits of the SHA-256 of a value's canonical JSON."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def sha256_file(path: Path) -> str:
    digest = hashlib.sha256()
    with path.open("rb") as stream:
        while block := stream.read(BLOCK):
            digest.update(block)
    return digest.hexdigest()


def write_json(path: Path, value: object) -> None:
    """Replaces a file atomically and makes both it and its folder durable."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent)
    with os.fdopen(handle, "w", encoding="utf-8") as stream:
        json.dump(value, stream, indent=1, sort_keys=True)
        stream.flush()
        os.fsync(stream.fileno())
    os.replace(name, path)
    folder = os.open(path.parent, os.O_RDONLY)
    try:
        os.fsync(folder)
    finally:
        os.close(folder)


def checksums(folder: Path) -> dict[str, str]:
    return {str(p.relative_to(folder)): sha256_file(p) for p in sorted(folder.rglob("*")) if p.is_file() and not p.name.startswith((".", "_"))}


@dataclass
class Manifest:
    snapshot_id: str
    status: str
    inputs: list[list[str]]
    tables: dict[str, dict[str, int]] = field(default_factory=dict)
    checks: list[dict] = field(default_factory=list)
    artifacts: dict[str, str] = field(default_factory=dict)
    error: str = ""


class Lake:
    """The folders of one data root."""

    def __init__(self, root: str | Path) -> None:
        self.root = Path(root)

    def staging(self, snapshot: str) -> Path:
        return self.root / "staging" / snapshot

    def silver(self, snapshot: str) -> Path:
        return self.root / "silver" / snapshot

    def manifest_path(self, snapshot: str) -> Path:
        return self.root / "manifests" / f"{snapshot}.json"

    @property
    def pointer(self) -> Path:
        return self.root / "manifests" / "current.json"

    def manifest(self, snapshot: str) -> Manifest | None:
        path = self.manifest_path(snapshot)
        return Manifest(**json.loads(path.read_text())) if path.exists() else None

    def save(self, manifest: Manifest) -> None:
        write_json(self.manifest_path(manifest.snapshot_id), asdict(manifest))

    def current(self) -> str | None:
        return json.loads(self.pointer.read_text())["snapshot_id"] if self.pointer.exists() else None

    @contextlib.contextmanager
    def claimed(self, snapshot: str) -> Iterator[None]:
        """Holds the snapshot's lock; a second run of it fails at once."""
        if not C.valid_identifier(snapshot):
            raise ValueError(f"not a snapshot id: {snapshot}")
        path = self.root / "locks" / f"{snapshot}.lock"
        path.parent.mkdir(parents=True, exist_ok=True)
        with path.open("w") as handle:
            try:
                fcntl.flock(handle, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except BlockingIOError as error:
                raise RuntimeError(f"{snapshot} is being built by another run") from error
            yield

    def promote(self, manifest: Manifest, current: bool = True) -> Manifest:
        """Renames a validated snapshot into place and moves the pointer; safe to repeat after an interruption."""
        source, target = self.staging(manifest.snapshot_id) / "silver", self.silver(manifest.snapshot_id)
        if source.exists() and not target.exists():
            target.parent.mkdir(parents=True, exist_ok=True)
            os.replace(source, target)
        if checksums(target) != manifest.artifacts:
            raise RuntimeError(f"{manifest.snapshot_id}: artifacts differ from the manifest")
        manifest.status = PROMOTED
        self.save(manifest)
        if current:
            write_json(self.pointer, {"snapshot_id": manifest.snapshot_id})
        shutil.rmtree(self.staging(manifest.snapshot_id), ignore_errors=True)
        return manifest

    def publish(self, folder: Path, build: Callable[[Path], dict]) -> dict:
        """An immutable artifact folder: built aside and renamed, or reused after its checksums have been verified."""
        path = folder / "manifest.json"
        if path.exists():
            found = json.loads(path.read_text())
            held = {k: v for k, v in checksums(folder).items() if k != "manifest.json"}
            if held != found["artifacts"]:
                raise RuntimeError(f"{folder}: artifacts differ from the manifest")
            return found
        folder.parent.mkdir(parents=True, exist_ok=True)
        aside = Path(tempfile.mkdtemp(dir=folder.parent, prefix=".building-"))
        try:
            found = build(aside) | {"artifacts": {}}
            found["artifacts"] = checksums(aside)
            write_json(aside / "manifest.json", found)
            os.replace(aside, folder)
        finally:
            shutil.rmtree(aside, ignore_errors=True)
        return found


def grid_errors(pairs: list[tuple[str, str]]) -> list[str]:
    """Which combinations of family and role are missing or repeated."""
    return [f"{f}/{r} occurs {n} times" for f in C.FAMILIES for r in C.ROLES if (n := pairs.count((f, r))) != 1]


def ingest(spark: SparkSession, lake: Lake, snapshot: str, sources: list[str], roles: bool = False, current: bool = True) -> Manifest:
    """Builds and promotes a snapshot from source files, one per family, or with ``roles`` any number per family.

    An unchanged promoted snapshot is returned as it is; one that was interrupted after validation is finished; inputs that
    differ from an earlier run of the same id are an error. A blocking check leaves the manifest failed.
    """
    with lake.claimed(snapshot):
        inspected = [(p, pipe.archive.inspect(p)) for p in sorted(sources)]
        inputs = sorted([p.rpartition("/")[2], i.sha256] for p, i in inspected)
        before = lake.manifest(snapshot)
        if before and before.inputs != inputs:
            raise ValueError(f"{snapshot} was built from other inputs")
        if before and before.status == PROMOTED:
            return before
        if before and before.status == VALIDATED:
            return lake.promote(before, current)
        manifest = Manifest(snapshot, RUNNING, inputs)
        lake.save(manifest)
        stage = lake.staging(snapshot)
        shutil.rmtree(stage, ignore_errors=True)
        try:
            _build(spark, lake, manifest, stage, [p for p, _ in inspected], roles)
        except Exception as error:
            manifest.status, manifest.error = FAILED, f"{type(error).__name__}: {str(error)[:500]}"
            lake.save(manifest)
            raise
        manifest.status = VALIDATED
        lake.save(manifest)
        return lake.promote(manifest, current)


def _build(spark: SparkSession, lake: Lake, manifest: Manifest, stage: Path, paths: list[str], roles: bool) -> None:
    parts: dict[str, list[DataFrame]] = {}
    checks: dict[str, DataFrame] = {}
    for path in paths:
        family, bronze, rejects, counts = pipe.parse(spark, path, None if roles else "base")
        if family.name in parts and not roles:
            raise ValueError(f"two sources for {family.name}")
        name = path.rpartition("/")[2]
        bronze.write.parquet(str(stage / "bronze" / name))
        rejects.write.json(str(stage / "rejects" / name))
        kept = spark.read.parquet(str(stage / "bronze" / name))
        seen = counts.first()
        manifest.tables.setdefault(family.name, {}).update({f"{name}:seen": seen.seen, f"{name}:accepted": seen.accepted, f"{name}:rejected": seen.rejected})
        tallied = spark.createDataFrame([(seen.seen, kept.count(), seen.rejected)], "seen long, accepted long, rejected long")
        checks[f"{family.name}|conservation {name}"] = quality.row_conservation(tallied)
        checks[f"{family.name}|rejects {name}"] = quality.reject_fraction(tallied)
        parts.setdefault(family.name, []).append(reconcile.with_order(kept))
    silver = stage / "silver"
    for name, frames in parts.items():
        family = C.FAMILIES[name]
        union = frames[0].drop(reconcile.ORDER)
        for other in frames[1:]:
            union = union.unionByName(other.drop(reconcile.ORDER), allowMissingColumns=True)
        rows = normalize.normalize_bronze(union, family, manifest.snapshot_id)
        failed = rows.agg(normalize.failed_dates(rows, family.dates).alias("numerator"), F.count("*").alias("denominator"))
        checks[f"{name}|dates"] = quality.date_failures(failed)
        if roles:
            order = "_line"
            ordered = rows.withColumn(order, F.struct(F.col("_source_filename"), F.col("_source_line_number").try_cast("long")))
            won, held = reconcile.reconcile(ordered, list(family.key), order=order)
            held.write.parquet(str(stage / "_conflicts" / f"{name}.parquet"))
            checks[f"{name}|conflicts"] = quality.conflict_count(held)
            rows = won.drop("selected_priority")
        rows.write.parquet(str(silver / f"{name}.parquet"))
        written = spark.read.parquet(str(silver / f"{name}.parquet"))
        manifest.tables[name]["rows"] = written.count()
        checks[f"{name}|unique"] = quality.uniqueness(written, list(family.key))
        previous = lake.current()
        if previous and (lake.silver(previous) / f"{name}.parquet").exists():
            checks[f"{name}|drift"] = quality.drift(written, spark.read.parquet(str(lake.silver(previous) / f"{name}.parquet")))
    if "master" in parts:
        parents = spark.read.parquet(str(silver / "master.parquet"))
        for child in sorted(set(parts) - {"master"}):
            checks[f"{child}|orphans"] = quality.orphans(spark.read.parquet(str(silver / f"{child}.parquet")), parents)
    results = quality.report({"all": quality.required_tables(spark, list(parts))} | checks)
    manifest.checks = [r.asDict() for r in results.orderBy("position").collect()]  # a few checks a table
    (stage / "quality.md").write_text(quality.markdown(results))
    if blocking := [c for c in manifest.checks if not c["passed"] and c["level"] == quality.BLOCKING]:
        raise Blocked("; ".join(f"{c['table']}: {c['message']}" for c in blocking))
    manifest.artifacts = checksums(silver)


def republish(spark: SparkSession, lake: Lake, snapshot: str) -> str:
    """Makes an earlier promoted snapshot current again, if its row counts pass the drift check against the present one."""
    held, now = lake.manifest(snapshot), lake.current()
    if held is None or held.status != PROMOTED or checksums(lake.silver(snapshot)) != held.artifacts:
        raise ValueError(f"{snapshot} is not promoted or has changed")
    if now and now != snapshot:
        tables = [(spark.read.parquet(str(lake.silver(s) / f"{name}.parquet")) for s in (snapshot, now)) for name in held.tables if (lake.silver(now) / f"{name}.parquet").exists()]
        if tables and not quality.gate(quality.report({f"{i}": quality.drift(*pair) for i, pair in enumerate(tables)})).first().promotable:
            raise Blocked(f"{snapshot} has too few rows to replace {now}")
    write_json(lake.pointer, {"snapshot_id": snapshot})
    return snapshot


def build_corpus(spark: SparkSession, lake: Lake, snapshot: str) -> dict:
    """The modeling corpus of a promoted snapshot, as JSON lines; built once."""
    held = lake.manifest(snapshot)
    if held is None or held.status != PROMOTED:
        raise ValueError(f"{snapshot} is not promoted")

    def build(folder: Path) -> dict:
        views = documents.open_snapshot(spark, str(lake.silver(snapshot)))
        rows = views["report_documents"]
        documents.modeling_documents(documents.nested(rows)).write.json(str(folder / "documents.jsonl"))
        return documents.corpus_counts(rows).first().asDict() | {"snapshot_id": snapshot, "cleaning_version": documents.CLEANING}

    return lake.publish(lake.root / "corpora" / snapshot / documents.CLEANING, build)


def read_corpus(spark: SparkSession, lake: Lake, corpus: str) -> DataFrame:
    return spark.read.schema(C.DOCUMENT).json(str(lake.root / "corpora" / corpus / documents.CLEANING / "documents.jsonl"))


def build_research_corpus(spark: SparkSession, lake: Lake, snapshots: list[str]) -> str:
    """A corpus of several snapshots without a report in common, named by the hash of its sources."""
    if len(set(snapshots)) != len(snapshots) or len(snapshots) < 2:
        raise ValueError("a research corpus needs at least two different snapshots")
    sources = {s: lake.manifest(s) for s in sorted(snapshots)}
    if any(m is None or m.status != PROMOTED for m in sources.values()):
        raise ValueError("every source must be promoted")
    name = "research-" + fingerprint({s: m.artifacts for s, m in sources.items()})

    def build(folder: Path) -> dict:
        for s in sources:
            build_corpus(spark, lake, s)
        union = documents.research_corpus({s: read_corpus(spark, lake, s) for s in sources})
        union.write.json(str(folder / "documents.jsonl"))
        return {"corpus_id": name, "source_snapshot_ids": sorted(sources)}

    lake.publish(lake.root / "corpora" / name / documents.CLEANING, build)
    return name
