from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarrystone.llm import simhash
from quarrystone.llm.components import components

SCHEMA = "doc_id long, text string, fp string, component string"


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    group = {i: i for i in fps}
    while True:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4 and group[b] < group[a]:
                    group[a], changed = group[b], True
        if not changed:
            return group


def test_fingerprint_equals_the_plain_definition():
    for text in ("", None, "a", "One two\tTHREE", "a b c d", "É é x\x0by z w a b c", "x " * 17_000, "a\xa0b c d e"):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_spark_xxhash_agrees(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij", "kl"], 200)) for _ in range(12)]
    rows, at = [], 0
    for text in base:
        for _ in range(5):
            words = text.split()
            words[int(rng.integers(len(words)))] = "zz"
            rows.append((at := at + 1, " ".join(words)))
        rows.append((at := at + 1, text))
    rows += [(at := at + 1, None), (at := at + 1, ""), (at := at + 1, " \n ")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    want = slow_components({i: slow_fingerprint(t) for i, t in rows})
    for block in (simhash.BLOCK, 7):
        got = {r.doc_id: r.component for r in simhash.simhash_groups(docs, block=block).collect()}
        assert got == want
    assert len(set(want.values())) < len(want)
    kept = {r.doc_id for r in simhash.first_of_group(docs).collect()}
    assert kept == set(want.values())
    assert simhash.first_of_group(docs).columns == docs.columns


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "q w e r t"), (5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.component or 0) for r in simhash.simhash_groups(docs).collect()))
    assert got == [(0, 0), (0, 5), (5, 5), (5, 5), (9, 5)]
    assert simhash.first_of_group(docs).count() == 4
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_links_skip_no_tile():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    x[1500:] = x[:1500] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    x = x[np.lexsort(simhash._quarters(x).T[::-1])]
    found = {(int(i), int(j)) for a, b in simhash.links(x, x, 4, True) for i, j in zip(a, b)}
    want = np.bitwise_count(x[:, None] ^ x[None]) <= 4
    assert found == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(want, 1)))}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(90, 91), (91, 92), (92, 90)], [(None, 1), (3, 2), (2, 3)]])
def test_components(spark, edges):
    want = {n: n for e in edges if None not in e for n in e if e[0] != e[1]}
    for _ in want:
        for a, b in edges:
            if a is not None and b is not None and a != b:
                want[a] = want[b] = min(want[a], want[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
