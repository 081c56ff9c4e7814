"""Audit of a local folder of source archives before they are ingested."""

from __future__ import annotations

from pathlib import Path

from quarrystone import contracts as C
from quarrystone.sources import archive


def _finding(check: str, passed: bool, message: str, path: Path | None = None, family: str | None = None) -> dict:
    return {"check": check, "level": "blocking", "passed": passed, "message": message, "path": str(path) if path else None, "family": family}


def _conversion(path: Path, family: str) -> dict:
    """Compares line feeds with a converted text beside the archive."""
    other = path.with_name(f"{path.stem}_UTF8.txt")
    try:
        before, after = archive.newline_count(str(path)), archive.newline_count(str(other))
    except (OSError, archive.SourceError) as error:
        return _finding("conversion_inspection", False, str(error), other, family)
    whole = before == 0 or after >= C.TRUNCATION_LIMIT * before
    return _finding("truncation_comparison", whole, f"{after} of {before} lines", other, family)


def audit_folder(folder: str) -> list[dict]:
    """Findings on every archive of a folder: one per family is expected; archives of additions are left out."""
    root = Path(folder)
    if not root.is_dir():
        return [_finding("source_root", False, "no such folder", root)]
    found, held = [_finding("source_root", True, "folder exists", root)], {}
    for path in sorted(root.glob("*.zip")):
        if C.detect_role(path.name) == "add":
            continue
        try:
            seen = archive.inspect(str(path))
        except (OSError, ValueError, NotImplementedError) as error:
            found.append(_finding("archive_integrity", False, str(error), path))
            continue
        if C.detect_role(seen.member or "") == "add":
            found.append(_finding("additive_archive_member", False, "a base archive holds additions", path))
            continue
        try:
            family = C.detect_family(seen.member or path.name, seen.header())
        except ValueError as error:
            found.append(_finding("schema_detection", False, str(error), path))
            continue
        found.append(_finding("archive_inspection", True, f"{seen.size} bytes, sha256 {seen.sha256}", path, family.name))
        held.setdefault(family.name, []).append(path)
        if path.with_name(f"{path.stem}_UTF8.txt").exists():
            found.append(_conversion(path, family.name))
    for name in C.FAMILIES:
        paths = held.get(name, [])
        found.append(_finding("archive_family_ambiguity", len(paths) == 1, f"{len(paths)} archives", paths[0] if paths else None, name))
    return found


def blocking(findings: list[dict], conversions: bool = True) -> list[dict]:
    """Failed findings, with or without those about converted texts."""
    return [f for f in findings if not f["passed"] and f["level"] == "blocking" and (conversions or f["check"] not in {"truncation_comparison", "conversion_inspection"})]


def canonical(findings: list[dict]) -> list[dict]:
    """The archive of each family, in family order."""
    by = {f["family"]: f for f in findings if f["check"] == "archive_inspection" and f["passed"]}
    return [by[name] for name in C.FAMILIES if name in by]
