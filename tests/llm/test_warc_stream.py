"""The archive reader holds a record at a time, whatever the archive's size."""

from __future__ import annotations

import random
import tracemalloc

from quarrystone.llm import scratch, warc


def test_an_archive_larger_than_the_buffer_is_read_by_pieces(tmp_path):
    rng = random.Random(4)
    path = tmp_path / "big.warc.gz"
    with path.open("wb") as out:
        for i in range(160):
            out.write(warc.page_member(i, f"u{i}", rng.randbytes(100_000), None, False))
    assert path.stat().st_size > 200 * warc.PIECE
    tracemalloc.start()
    with path.open("rb") as stream:
        found = sum(len(r.http()[1]) for r in warc.read(iter(lambda: stream.read(warc.PIECE), b"")))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 160 * 100_000 and peak < 2_000_000


def test_rows_leave_in_batches_and_across_archives(spark, monkeypatch):
    rows = [(i, f"u{i}", f"{i} " * (i % 50)) for i in range(500)]
    folder = scratch.folder(spark, "test-warc")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), folder, archive=3000)
    got = {r.page_id: r for r in warc.read_archives(spark, folder).collect()}
    assert len(got) == 500
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got.values())
    assert all(got[r.refers_to].payload.decode() == rows[i][2] for i, r in got.items() if r.refers_to is not None)


def test_blanks_in_a_folder_name_are_no_obstacle(spark, tmp_path):
    folder = f"file://{tmp_path}/a b%20c"
    warc.write(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), folder)
    assert [r.page_id for r in warc.read_archives(spark, folder).collect()] == [1]
