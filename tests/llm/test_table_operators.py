"""Embedding forest, WARC, paragraphs, mixing and the pipeline against plain versions."""

from __future__ import annotations

import base64
import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.llm import forest, mixing, paragraphs, scratch, warc


def reach(nodes, links):
    group = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    return group


# ---------------------------------------------------------------- embeddings


def vectors(n=600):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * 0.12 * (i % 3)).astype(np.float32).tolist(), i % 4) for i in range(n)]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(60)]
    return rows


@pytest.mark.parametrize("how", [{}, {"leaf": 64, "sample": 400}, {"large": 40, "chunk": 16, "leaf": 100}])
def test_links_and_components_equal_brute_force(spark, how):
    rows = vectors()
    odd = [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] + [1.0] * 15, 1), (2004, [1.0] * 16, None), (2005, [], 1), (2006, [float("inf")] + [1.0] * 15, 1), (2007, [1.0] * 8, 1), (None, rows[0][1], 0)]
    data = spark.createDataFrame([(a, b, c, "x") for a, b, c in rows + odd], "vec_id long, embedding array<float>, label int, key string")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.93
    links = [(rows[i][0], rows[j][0]) for i, j in combinations(range(len(rows)), 2) if near[i, j] and rows[i][2] == rows[j][2]]
    count = {r[0]: 0 for r in rows}
    for a, b in links:
        count[a], count[b] = count[a] + 1, count[b] + 1
    got = forest.near_vectors(data, **how).collect()
    mine = {r.vec_id: r for r in got if r.vec_id is not None and r.vec_id < 2000}
    assert len(got) == len(rows) + len(odd)
    assert all(mine[i].n_links <= count[i] for i in count)
    assert sum(r.n_links for r in mine.values()) >= 0.99 * sum(count.values())
    group = reach(count, links)
    assert sum(mine[i].component == group[i] for i in count) >= 0.99 * len(count)
    assert all((r.n_links, r.component, r.kept) == (0, r.vec_id, True) for r in got if r.vec_id is None or r.vec_id >= 2000)
    assert all(r.kept == (r.component == r.vec_id) for r in mine.values())


def test_no_vectors(spark):
    data = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<double>, label int")
    assert [tuple(r) for r in forest.near_vectors(data).collect()] == [(1, 0, 1, True)]
    assert forest.near_vectors(data.limit(0)).count() == 0


# ---------------------------------------------------------------- WARC


def test_round_trip(spark):
    rows = [(i, f"http://h/{i} ü\n", "same" if i % 3 == 0 else f"<p>é {i}</p>" * (i % 5), "z") for i in range(60)] + [(70, None, None, "z"), (71, "u", "", None), (None, "n", "only here", "z"), (None, "n", "same", "z"), (5, "twice", "repeated", "z"), (5, "twice", "repeated", "z"), (80, "long", "x\r\n\r\n" * 100_000, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, id string").repartition(4)
    folder = scratch.folder(spark, "test-warc")
    manifest = warc.write(pages, folder, archive=4000)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = warc.read_archives(spark, folder).collect()
    largest = {}
    for page, _, html, _ in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    want = []
    for page, _, html, _ in rows:
        body = (html or "").encode()
        revisit = largest.get(html or "", page) != page
        want.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", largest[html or ""] if revisit else None, None if revisit else body))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got), key=str) == sorted(want, key=str)


def test_least_payload_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyy"), (4, "d", "yyyy")], "page_id long, url string, html string")
    folder = scratch.folder(spark, "test-warc")
    warc.write(pages, folder, least=3)
    assert {(r.page_id, r.record_type) for r in warc.read_archives(spark, folder, payloads=False).collect()} == {(1, "response"), (2, "response"), (3, "revisit"), (4, "response")}
    assert warc.write(pages.limit(0), scratch.folder(spark, "test-warc")).count() == 0


def test_reader_takes_any_pieces_and_finds_damage():
    data = b"".join(warc.page_member(i, f"u{i}", bytes([65 + i]) * 5000 * i, None, False) for i in range(4))
    for size in (1, 7, 1 << 20):
        assert [len(r.http()[1]) for r in warc.read(data[i : i + size] for i in range(0, len(data), size))] == [0, 5000, 10000, 15000]
    bad = warc.member({"WARC-Type": "response", "WARC-Payload-Digest": "sha1:WRONG"}, b"HTTP/1.1 200 OK\r\n\r\nx")
    for damaged in (data[:-9], data[:40] + b"\x00\x01" + data[42:], bad):
        with pytest.raises(warc.Damaged):
            list(warc.read([damaged]))


# ---------------------------------------------------------------- paragraphs


def test_tuning_reaches_the_recall():
    bands, rows = paragraphs.tune()
    assert 1 - (1 - 0.8**rows) ** bands >= paragraphs.RECALL and bands <= paragraphs.BANDS


def test_clusters_equal_brute_force(spark):
    rng = random.Random(8)
    def text(n):
        return " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))

    base = [text(rng.randint(60, 120)) for _ in range(12)]
    rows = []
    for doc in range(80):
        parts = [text(8)]
        for _ in range(2):
            words = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = "edit"
            parts.append(" ".join(words).upper() if rng.random() < 0.2 else "  ".join(words))
        rows.append((doc, "\n".join(parts + ([text(70)] if doc % 4 else []))))
    rows += [(500, None), (501, ""), (None, base[0])]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, line int")
    sets = {}
    for doc, t in rows:
        for line, _, _, words in paragraphs.paragraphs(t):
            sets[doc if doc is not None else 10**6, line] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group = reach(sets, links)
    linked = {n for pair in links for n in pair}
    for chunk in (paragraphs.CHUNK, 3):
        found = paragraphs.clusters(docs, chunk=chunk)
        got = {(r.doc if r.doc is not None else 10**6, r.line): (r.cluster_doc, r.cluster_line) for r in found.collect()}
        assert got == {n: group[n] for n in linked}
    slim = paragraphs.without_copies(docs, found)
    assert slim.columns == docs.columns and slim.count() == len(rows)
    assert paragraphs.clusters(slim).count() == 0
    assert paragraphs.clusters(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- mixing


def mixing_rows(n=900):
    rng, rows = random.Random(3), []
    words = {"a": ["alpha", "apple", "arrow", "shared"], "b": ["bravo", "berry", "brick", "shared"], "c": ["cargo", "cedar", "cliff", "shared"]}
    for i in range(n):
        domain = "a" if i % 3 or i % 9 == 0 else "b" if i % 2 else "c"
        rows.append((i, " ".join(rng.choice(words[domain]) for _ in range(rng.randint(5, 60))), domain))
    return rows


def test_rates_match_targets(spark):
    rows = mixing_rows()
    docs = spark.createDataFrame([(a, b, 0.1) for a, b, _ in rows] + [(None, None, None), (7777, "", 0.1)], "doc_id long, text string, rate double")
    labelled = spark.createDataFrame([(a, c) for a, _, c in rows if a % 7 < 3] + [(None, "a"), (1, None)], "doc_id long, domain string")
    made, report = mixing.mixed(docs, labelled, targets={"a": 0.2, "b": 0.5, "c": 0.3})
    got = made.collect()
    assert report["domains"] == ["a", "b", "c"] and len(got) == len(rows) + 2
    assert all(abs(x - y) < 0.01 for x, y in zip(report["reached"], [0.2, 0.5, 0.3]))
    total = sum(r.tokens for r in got)
    for k in range(3):
        assert abs(sum(r.rate * r.tokens * r[f"p{k}"] for r in got) / total - report["reached"][k]) < 1e-9
    assert all(r.rate >= 0 and abs(r.p0 + r.p1 + r.p2 - 1) < 1e-9 for r in got)
    truth = {a: c for a, _, c in rows}
    right = sum("abc"[max(range(3), key=lambda k: r[f"p{k}"])] == truth[r.id] for r in got if r.id in truth and r.id % 7 >= 3)
    assert right >= 0.95 * sum(1 for i in truth if i % 7 >= 3)
    realised = sum(r.copies * r.tokens * r.p1 for r in got) / sum(r.copies * r.tokens for r in got)
    assert abs(realised - 0.5) < 0.05


@pytest.mark.parametrize(("targets", "steps"), [([0.0, 0.7, 0.3], 12), ([0.2, 0.5, 0.3], 40), ([0.6, 0.2, 0.2], 1)])
def test_rates_are_projected_least_squares(spark, targets, steps):
    """The chain of steps equals the same iteration in numpy, no rate is negative, and the report says whether it came near."""
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 100, 400)
    soft = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(400)], "id long, tokens long, p0 double, p1 double, p2 double")
    made, report = mixing.rates(soft, 3, targets, steps=steps)
    got = np.array([r.rate for r in made.orderBy("id").collect()])
    s = (p * n[:, None]).sum(0) / n.sum()
    goal, r, near = np.array(targets), np.ones(400), False
    for _ in range(steps):
        off = (r * n) @ p / n.sum() - goal
        near = bool((np.abs(off) <= mixing.CLOSE * np.maximum(goal, s)).all())
        if near:
            break
        r = np.maximum(0, r - p @ (off / s))
    reached = (r * n) @ p / n.sum()
    assert np.allclose(got, r, atol=1e-9) and (got >= 0).all() and np.allclose(report["reached"], reached)
    assert report["converged"] == bool((np.abs(reached - goal) <= mixing.CLOSE * np.maximum(goal, s)).all())


def test_resampling_keeps_all_and_columns(spark):
    rows = mixing_rows(300)
    docs = spark.createDataFrame([(a, b, "k") for a, b, _ in rows] + [(None, "alpha", "k"), (3, "twice", "k")], "doc_id long, text string, copies string")
    labelled = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, domain string")
    out = mixing.resampled(docs, labelled, power=0.5, keep_all=True)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} and out.count() > docs.count()
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert mixing.resampled(docs, none).count() == docs.count() and mixing.resampled(docs.limit(0), labelled).count() == 0


def test_the_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c d", "y")], "doc_id long, text string, domain string")
    made, _ = mixing.mixed(docs, docs.select("doc_id", "domain"))
    plan = made._jdf.queryExecution().toString() + mixing.posteriors(docs, mixing.fit(docs, docs.select("doc_id", "domain")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = scratch.keep(stage(spark, seen, sf), "test-stage")
        assert seen.columns == columns, name
    ids = {r.doc_id for r in seen.collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    assert 0 < len(ids) < docs.count() and len(ids & toxic) <= 0.5 * max(1, len(toxic))
    last = corpus_pipeline.STAGES[-1][1](spark, seen, sf)
    assert last.where("decoded IS NULL OR decoded != coalesce(text, '')").count() == 0
    assert last.columns == [*columns, "ids", "decoded"] and last.where(F.size("ids") == 0).count() <= seen.where("text = ''").count()
