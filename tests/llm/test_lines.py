from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from quarrystone.llm import lines

WS = "\x20\x09\x0a\x0b\x0c\x0d"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WS))


def slow(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(doc)
    def stays(doc, line):
        held = holders.get(key(line), {doc})
        return len(held) < 2 or doc == min(held, key=lambda x: (x is None, x))
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if stays(doc, x)]
        out.append((doc, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("batches,fanout", [(4, 2), (1, 2), (7, 3)])
def test_equals_brute_force(spark, batches, fanout):
    rng = random.Random(batches)
    pool = [f"{rng.choice(['', ' ', chr(9)])}Shared LINE number {i} É{rng.choice(['', ' ', chr(13)])}" for i in range(30)] + ["short", "", " ", "exactly10!", "ExActly10!", "ünïcödé lïné ß"]
    rows = [(i * 3 % 101, "\n".join(rng.choice(pool + [f"own line of {i} {j}"]) for j in range(rng.randint(1, 9)))) for i in range(90)]
    rows += [(500, None), (501, ""), (None, "no id here\nshared line number 3 é"), (502, "\n" * 4000 + "exactly10!"), (503, "x" * 200_000)]
    rows.append(rows[4])
    docs = spark.createDataFrame([(a, b, "e", 7) for a, b in rows], "doc_id long, text string, digest string, n_lines int").repartition(5)
    got = lines.dedup_lines(docs, batches=batches, fanout=fanout)
    assert got.columns == ["doc_id", "text", "digest", "n_lines", "n_dropped"]
    assert ordered([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]) == ordered(slow(rows))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("quarrystone_run_")]


def test_empty_table_and_pipeline_form(spark):
    docs = spark.createDataFrame([(1, "a line that repeats\nb", 21), (2, "a line that repeats\nc", 21)], "doc_id long, text string, n_chars long")
    assert lines.dedup_lines(docs.limit(0)).count() == 0
    assert {tuple(r) for r in lines.deduped(docs).collect()} == {(1, "a line that repeats\nb", 21), (2, "c", 1)}
