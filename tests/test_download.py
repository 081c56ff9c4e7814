"""Downloads and the refresh, over a transport that reads local files."""

from __future__ import annotations

import io

import pytest

from quarrystone import publish
from quarrystone.sources import catalog, download
from tests.test_pipeline_and_sources import sources

HOST, URL = "h.org", "https://h.org/list"


class Response(io.BytesIO):
    def __init__(self, data, url, length=None):
        super().__init__(data)
        self.url, self.headers = url, {"Content-Length": str(len(data) if length is None else length)}


def site(tmp_path):
    files = {}
    for suffix, role in (("", "base"), ("Add", "add"), ("Change", "change")):
        for path in sources(tmp_path / "site", {"base": "1", "add": "2", "change": "1"}[role], suffix):
            files[path.rpartition("/")[2]] = open(path, "rb").read()
    page = "<h2>Files</h2>" + "".join(f'<a href="/f/{n}">x</a>' for n in files)
    families = {"mdrfoi": "master", "device": "device", "patient": "patient", "foitext": "narrative"}
    allowed = {n.lower(): (next(f for s, f in families.items() if n.startswith(s)), "add" if "Add" in n else "change" if "Change" in n else "base") for n in files}
    asked = []

    def open_url(url):
        asked.append(url)
        return Response(page.encode(), url) if url == URL else Response(files[url.rpartition("/")[2]], url)

    return files, allowed, open_url, asked


def test_refresh_promotes_once_and_resumes(spark, tmp_path):
    files, allowed, open_url, asked = site(tmp_path)
    lake = publish.Lake(tmp_path / "lake")
    outcome, snapshot = download.refresh(spark, lake, URL, HOST, "Files", None, allowed, open_url)
    assert outcome == publish.PROMOTED and lake.current() == snapshot and len(asked) == 13
    assert download.refresh(spark, lake, URL, HOST, "Files", None, allowed, open_url) == ("unchanged", snapshot)
    assert len(asked) == 14  # the catalog alone is read again


def test_bad_responses_are_refused(tmp_path):
    files, allowed, open_url, _ = site(tmp_path)
    store = download.RawStore(tmp_path / "lake")
    good = catalog.Artifact("https://h.org/f/device.zip", "device.zip", "device", "base")
    held = download.download(good, store, HOST, open_url)
    assert download.download(good, store, HOST, open_url) == held and store.reusable(good, [held]) == held
    data = files["device.zip"]
    for bad in (
        lambda u: Response(data, "https://h.org/f/other.zip"), lambda u: Response(data, "https://evil.org/f/device.zip"), lambda u: Response(data, u, len(data) + 1),
        lambda u: Response(data, u, download.ARCHIVE_LIMIT + 1), lambda u: Response(b"junk", u), lambda u: Response(files["patient.zip"], u)):
        with pytest.raises((download.DownloadError, ValueError)):
            download.download(good, store, HOST, bad)
    with pytest.raises(download.DownloadError):
        download.download(catalog.Artifact("http://h.org/f/device.zip", "device.zip", "device", "base"), store, HOST, open_url)
    store.place(held.sha256).write_bytes(b"damaged")
    assert store.reusable(good, [held]) is None
    with pytest.raises(download.DownloadError):
        download.download(good, store, HOST, open_url)
    assert not [p for p in store.root.glob("*.zip")]
