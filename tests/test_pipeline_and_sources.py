"""Sources, snapshots, catalogs and the command line."""

from __future__ import annotations

import json
import zipfile

import pytest

from quarrystone import cli, publish
from quarrystone.sources import archive, audit, catalog, pipe

HEADS = {
    "mdrfoi": "MDR_REPORT_KEY|DATE_RECEIVED|EVENT_TYPE\n{k}|01/02/2025|D\n{k}0|01/03/2025|M\n",
    "device": "MDR_REPORT_KEY|DEVICE_SEQUENCE_NO|DEVICE_REPORT_PRODUCT_CODE\n{k}|1|ABC\n",
    "patient": "MDR_REPORT_KEY|PATIENT_SEQUENCE_NUMBER\n{k}0|1\n",
    "foitext": "MDR_REPORT_KEY|MDR_TEXT_KEY|TEXT_TYPE_CODE|DATE_REPORT|FOI_TEXT\n{k}|1{k}|N|01/04/2025|Pump stopped unexpectedly\n",
}


def sources(folder, key="1", suffix=""):
    folder.mkdir(parents=True, exist_ok=True)
    made = []
    for stem, text in HEADS.items():
        path = folder / f"{stem}{suffix}.zip"
        if not path.exists():
            with zipfile.ZipFile(path, "w") as z:
                z.writestr(f"{stem}{suffix}.txt", text.format(k=key))
        made.append(str(path))
    return made


def test_encodings_and_line_ends(tmp_path):
    path = tmp_path / "a.txt"
    path.write_bytes("é|b\r\nc\rd\n\nlast".encode())
    assert archive.encoding_of(str(path)) == "utf-8" and list(archive.lines(str(path))) == ["é|b", "c", "d", "", "last"]
    path.write_bytes(b"caf\xe9|x")
    assert archive.encoding_of(str(path)) == "cp1252" and list(archive.lines(str(path))) == ["café|x"]
    for bad in (b"a\x00b", b"\x81"):
        path.write_bytes(bad)
        with pytest.raises(archive.SourceError):
            archive.encoding_of(str(path))


def test_archives_are_checked(tmp_path):
    for name, members in (("two.zip", ["a.txt", "b.txt"]), ("up.zip", ["../a.txt"]), ("none.zip", ["a.csv"])):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for m in members:
                z.writestr(m, "x")
        with pytest.raises(archive.SourceError):
            archive.inspect(str(tmp_path / name))


def test_parse_splits_rows_and_rejects(spark, tmp_path):
    path = tmp_path / "foitext.txt"
    path.write_bytes(b"MDR REPORT KEY|MDR_TEXT_KEY|TEXT_TYPE_CODE|DATE_REPORT|FOI_TEXT\r\n1|10|N||ok \"quoted\r\n1|11|N|short\r\n1| |N||no key\r\n\r\n1|12|N||" + b"x" * 200_000 + b"\r\n")
    family, bronze, rejects, counts = pipe.parse(spark, str(path))
    assert family.name == "narrative" and tuple(counts.first()) == (5, 2, 3)
    assert {(r.line_number, r.reason, r.actual_fields) for r in rejects.collect()} == {(3, "field_count", 4), (4, "missing_business_key", 5), (5, "field_count", 0)}
    rows = bronze.collect()
    assert rows[0]["FOI_TEXT"] == 'ok "quoted' and len(rows[1]["FOI_TEXT"]) == 200_000 and rows[0]["_source_line_number"] == "2" and rows[0]["_source_role"] == "base"


def test_ingest_promotes_reuses_and_builds_corpora(spark, tmp_path, capsys):
    lake = publish.Lake(tmp_path / "lake")
    first = publish.ingest(spark, lake, "snap-1", sources(tmp_path / "one"))
    assert first.status == publish.PROMOTED and lake.current() == "snap-1" and first.tables["master"]["rows"] == 2
    assert publish.ingest(spark, lake, "snap-1", sources(tmp_path / "one")).artifacts == first.artifacts
    with pytest.raises(ValueError):
        publish.ingest(spark, lake, "snap-1", sources(tmp_path / "other", "9"))
    publish.ingest(spark, lake, "snap-2", sources(tmp_path / "two", "7"))
    corpus = publish.build_research_corpus(spark, lake, ["snap-1", "snap-2"])
    assert {r.report_id for r in publish.read_corpus(spark, lake, corpus).collect()} == {"1", "7"}
    assert publish.build_research_corpus(spark, lake, ["snap-2", "snap-1"]) == corpus
    assert cli.main(["--data-root", str(lake.root), "audit-duplicates", corpus]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["exact_groups"] == 1
    assert cli.main(["--data-root", str(lake.root), "build-tfidf", corpus, "--sample", "10"]) == 0
    assert publish.republish(spark, lake, "snap-1") == "snap-1" == lake.current()
    assert cli.main(["version"]) == 0


def test_roles_conflicts_and_blocking(spark, tmp_path):
    lake = publish.Lake(tmp_path / "lake")
    made = sources(tmp_path / "s", "1") + sources(tmp_path / "s", "2", "Add") + sources(tmp_path / "s", "1", "Change")
    held = publish.ingest(spark, lake, "roles", made, roles=True)
    assert held.tables["master"]["rows"] == 4
    rows = spark.read.parquet(str(lake.silver("roles") / "master.parquet"))
    assert {(r.mdr_report_key, r._source_role) for r in rows.collect()} == {("1", "change"), ("10", "change"), ("2", "add"), ("20", "add")}
    with pytest.raises(publish.Blocked):
        publish.ingest(spark, lake, "part", sources(tmp_path / "p")[:3])
    assert lake.manifest("part").status == publish.FAILED and lake.current() == "roles"


def test_interrupted_promotion_is_finished(spark, tmp_path, monkeypatch):
    lake = publish.Lake(tmp_path / "lake")
    monkeypatch.setattr(publish.Lake, "promote", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        publish.ingest(spark, lake, "s", sources(tmp_path / "one"))
    assert lake.manifest("s").status == publish.VALIDATED
    monkeypatch.undo()
    assert publish.ingest(spark, lake, "s", sources(tmp_path / "one")).status == publish.PROMOTED
    with lake.claimed("s"), pytest.raises(RuntimeError):
        publish.ingest(spark, lake, "s", sources(tmp_path / "one"))


def test_local_audit(tmp_path):
    sources(tmp_path)
    assert not audit.blocking(audit.audit_folder(str(tmp_path))) and len(audit.canonical(audit.audit_folder(str(tmp_path)))) == 4
    (tmp_path / "device_UTF8.txt").write_text("")
    (tmp_path / "patient.zip").write_bytes(b"junk")
    found = audit.blocking(audit.audit_folder(str(tmp_path)))
    assert {f["check"] for f in found} == {"truncation_comparison", "archive_integrity", "archive_family_ambiguity"}
    assert "truncation_comparison" not in {f["check"] for f in audit.blocking(audit.audit_folder(str(tmp_path)), conversions=False)}
    assert audit.audit_folder(str(tmp_path / "no"))[0]["check"] == "source_root"


def test_catalog():
    allowed = {"device.zip": ("device", "base"), "mdrfoi.zip": ("master", "base")}
    page = '<h2>Other</h2><a href="/f/device.zip">x</a><h2>Data <b>files</b></h2><a href="/f/device.zip">d</a><a href="https://h.org/f/MDRFOI.zip">m</a><a href="/x.pdf">n</a><h2>End</h2><a href="/f/device.zip">y</a>'
    found = catalog.discover(page, "https://h.org/list", "h.org", "Data files", "End", allowed)
    assert [(a.filename, a.family) for a in found] == [("MDRFOI.zip", "master"), ("device.zip", "device")]
    for bad in (page.replace("https://h.org/f/M", "http://h.org/f/M"), page.replace("/f/device.zip\">d", "/f/none.zip\">d"), page.replace("/x.pdf", "/f/device.zip")):
        with pytest.raises(catalog.CatalogError):
            catalog.discover(bad, "https://h.org/list", "h.org", "Data files", "End", allowed)
    assert catalog.trusted("https://h.org/a", "h.org") and not any(catalog.trusted(u, "h.org") for u in ("https://u@h.org/a", "https://h.org:1/a", "https://h.org/a?b", "https://h.org/#c", "http://h.org/"))
    assert catalog.grid_problems([("master", "base")]) and publish.grid_errors([(f, r) for f in publish.C.FAMILIES for r in publish.C.ROLES]) == []


def test_streaming_counts(spark, tmp_path):
    from quarrystone.streaming import monthly

    rows = [("1", "A", "2025-01-05", "death"), ("1", "A", "2025-01-05", "death"), ("2", "A", "2025-01-20", "injury"), ("3", None, "2025-02-01", "other"), ("4", "A", "2026-01-01", "other")]
    frame = spark.createDataFrame(rows, "report_id string, product_code string, date_received string, reported_severity_category string").selectExpr("report_id", "product_code", "CAST(date_received AS DATE) AS date_received", "reported_severity_category")
    frame.write.parquet(str(tmp_path / "in"))
    stream = monthly.streaming_cohorts(spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in")))
    job = stream.writeStream.format("memory").queryName("cohorts").outputMode("append").trigger(availableNow=True).start()
    job.awaitTermination()
    got = {(r.product_code, str(r.month)): r.report_count for r in monthly.by_month(spark.table("cohorts")).collect()}
    assert got == {("A", "2025-01-01"): 2, (None, "2025-02-01"): 1}
