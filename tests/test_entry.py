"""The driver's entry points, and oracles of a few queries run side by side."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from quarrystone.plans import catalogue

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(catalogue.ORACLES) == set(catalogue.QUERIES)


def test_flagship(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.count() > 0 and "robust_z_score" in rows.columns


@pytest.mark.parametrize("name", ["signal_volume_change", "reconcile_stats", "quality_gate", "device_metadata_lists", "exact_duplicate_groups"])
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = catalogue.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    found = con.execute(f"SELECT {', '.join(columns)} FROM ({catalogue.ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, found))


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "an empty package", "no pipeline"])
def test_entry_without_the_optional_parts(tmp_path, left):
    root = Path(__spark_entry__.__file__).parent
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "tests", "__pycache__", *(["corpus_pipeline.py"] if left == "no pipeline" else [])))
    shutil.rmtree(tmp_path / "r/quarrystone/llm", ignore_errors=True)
    if left.startswith("an empty"):
        (tmp_path / "r/quarrystone/llm").mkdir()
    if left == "an empty package":
        (tmp_path / "r/quarrystone/llm/__init__.py").touch()
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path / "r", capture_output=True, text=True)
    assert said.stdout.split() == [str(len(catalogue.QUERIES)), str(len(catalogue.ORACLES))], said.stderr
