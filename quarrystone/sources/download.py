"""Catalog and archive downloads into a content-addressed store, and the refresh built on them.

The network is one function from URL to an open response, so tests and other transports replace it. Everything downloaded is
verified before it is admitted: the link, the size, the archive, and the family and role of the text inside.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from collections.abc import Callable
from dataclasses import asdict, dataclass
from pathlib import Path
from typing import IO
from urllib.parse import urlsplit
from urllib.request import Request, urlopen

from pyspark.sql import SparkSession

from quarrystone import contracts as C
from quarrystone import publish
from quarrystone.sources import archive, catalog

TIMEOUT, ARCHIVE_LIMIT, BLOCK = 30, 2 << 30, 1 << 20
Open = Callable[[str], IO[bytes]]


class DownloadError(RuntimeError):
    """A response that is not what was asked for."""


@dataclass(frozen=True)
class Downloaded:
    url: str
    filename: str
    family: str
    role: str
    sha256: str
    size: int
    path: str


def over_http(url: str) -> IO[bytes]:
    return urlopen(Request(url, headers={"User-Agent": "quarrystone"}), timeout=TIMEOUT)  # noqa: S310 - callers check the scheme


def _stated_length(response: IO[bytes]) -> int | None:
    value = getattr(response, "headers", {}).get("Content-Length")
    return int(value) if value and value.isdigit() else None


def fetch_catalog(url: str, host: str, open_url: Open = over_http) -> tuple[str, str]:
    """The page's text and its SHA-256."""
    if not catalog.trusted(url, host):
        raise DownloadError(f"untrusted catalog {url}")
    with open_url(url) as response:
        data = response.read(catalog.LIMIT + 1)
    if len(data) > catalog.LIMIT:
        raise DownloadError("the catalog is too large")
    return archive.decoded(data), hashlib.sha256(data).hexdigest()


class RawStore:
    """Files by the hash of their content, admitted once."""

    def __init__(self, root: str | Path) -> None:
        self.root = Path(root) / "raw" / "sha256"

    def place(self, sha256: str) -> Path:
        return self.root / sha256[:2] / f"{sha256}.zip"

    def admit(self, source: Path, sha256: str) -> Path:
        """Moves a file to its place; one that is there already must have the content its name says."""
        if publish.sha256_file(source) != sha256:
            raise DownloadError(f"{source} changed while it was admitted")
        target = self.place(sha256)
        if target.exists():
            if publish.sha256_file(target) != sha256:
                raise DownloadError(f"{target} is damaged")
            source.unlink()
        else:
            target.parent.mkdir(parents=True, exist_ok=True)
            os.replace(source, target)
        return target

    def reusable(self, artifact: catalog.Artifact, known: list[Downloaded]) -> Downloaded | None:
        """An earlier download of the same link, family and role whose file is still whole."""
        for d in known:
            same = (d.url, d.filename, d.family, d.role) == (artifact.url, artifact.filename, artifact.family, artifact.role)
            path = self.place(d.sha256)
            if same and path.exists() and path.stat().st_size == d.size and publish.sha256_file(path) == d.sha256:
                return d
        return None


def download(artifact: catalog.Artifact, store: RawStore, host: str, open_url: Open = over_http, limit: int = ARCHIVE_LIMIT) -> Downloaded:
    """One archive, verified and admitted."""
    if not catalog.trusted(artifact.url, host):
        raise DownloadError(f"untrusted link {artifact.url}")
    store.root.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=store.root, suffix=".zip")
    aside = Path(name)
    try:
        digest, size = hashlib.sha256(), 0
        with os.fdopen(handle, "wb") as out, open_url(artifact.url) as response:
            final = getattr(response, "url", None) or artifact.url
            if not catalog.trusted(final, host) or urlsplit(final).path.rpartition("/")[2].lower() != artifact.filename.lower():
                raise DownloadError(f"{artifact.url} leads to {final}")
            stated = _stated_length(response)
            if stated is not None and stated > limit:
                raise DownloadError(f"{artifact.filename} is too large")
            while block := response.read(BLOCK):
                size += len(block)
                if size > limit:
                    raise DownloadError(f"{artifact.filename} is too large")
                digest.update(block)
                out.write(block)
        if stated is not None and stated != size:
            raise DownloadError(f"{artifact.filename}: {size} of {stated} bytes")
        seen = archive.inspect(str(aside))
        family = C.detect_family(seen.member or artifact.filename, seen.header())
        if family.name != artifact.family or C.detect_role(artifact.filename) != artifact.role:
            raise DownloadError(f"{artifact.filename} holds {family.name}, not {artifact.family} / {artifact.role}")
        path = store.admit(aside, digest.hexdigest())
        return Downloaded(artifact.url, artifact.filename, artifact.family, artifact.role, digest.hexdigest(), size, str(path))
    finally:
        aside.unlink(missing_ok=True)


def acquire(artifacts: list[catalog.Artifact], store: RawStore, record: Path, catalog_sha256: str, host: str, open_url: Open = over_http) -> list[Downloaded]:
    """All archives of a catalog; what an interrupted run of the same catalog has verified is used again."""
    held = json.loads(record.read_text()) if record.exists() else {}
    known = [Downloaded(**d) for d in held.get("artifacts", [])] if held.get("catalog_sha256") == catalog_sha256 else []
    found: list[Downloaded] = []
    for artifact in artifacts:
        found.append(store.reusable(artifact, known) or download(artifact, store, host, open_url))
        publish.write_json(record, {"catalog_sha256": catalog_sha256, "artifacts": [asdict(d) for d in found]})
    return found


def named_copies(found: list[Downloaded], folder: Path) -> list[str]:
    """Links with the archives' own names, which carry family and role, to the files of the store."""
    folder.mkdir(parents=True, exist_ok=True)
    paths = []
    for d in found:
        path = folder / d.filename
        path.unlink(missing_ok=True)
        path.symlink_to(Path(d.path).resolve())
        paths.append(str(path))
    return paths


def refresh(spark: SparkSession, lake: publish.Lake, url: str, host: str, begin: str, end: str | None, allowed: dict[str, tuple[str, str]], open_url: Open = over_http, prefix: str = "current", current: bool = True) -> tuple[str, str]:
    """(outcome, snapshot id) of bringing the lake up to a catalog: ``unchanged`` or ``promoted``.

    The id is the hash of the archives, so a catalog that lists the same content leads to the same snapshot. Every
    combination of family and role must be listed once when ``current`` is on.
    """
    page, page_hash = fetch_catalog(url, host, open_url)
    artifacts = catalog.discover(page, url, host, begin, end, allowed)
    if current and (problems := catalog.grid_problems([(a.family, a.role) for a in artifacts])):
        raise catalog.CatalogError("; ".join(problems))
    store = RawStore(lake.root)
    found = acquire(artifacts, store, lake.root / "refresh-runs" / f"{page_hash[:16]}.json", page_hash, host, open_url)
    snapshot = f"{prefix}-{publish.fingerprint(sorted((d.filename, d.sha256) for d in found))}"
    before = lake.manifest(snapshot)
    if before and before.status == publish.PROMOTED and (not current or lake.current() == snapshot):
        return "unchanged", snapshot
    made = publish.ingest(spark, lake, snapshot, named_copies(found, lake.root / "refresh-runs" / snapshot), roles=True, current=current)
    return made.status, snapshot
