"""Verbatim passages against a plain comparison of all windows."""

from __future__ import annotations

import random
from collections import defaultdict

from quarrystone.llm import passages, paragraphs


def brute(rows, span):
    """Code points covered by windows that occur elsewhere: (copies, first occurrences) by row."""
    places = defaultdict(set)
    cuts = {}
    for doc, text in rows:
        start, end = passages.borders((text or "").encode())
        words = (text or "").encode().lower().split()
        rank = (doc is None, doc or 0, text if doc is None else "")
        cuts[rank] = start, end
        for p in range(len(words) - span + 1):
            places[tuple(words[p : p + span])].add((rank, p))
    copies, firsts = defaultdict(set), defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            for rank, p in found:
                (firsts if (rank, p) == min(found) else copies)[rank[1] if not rank[0] else None].update(range(cuts[rank][0][p], cuts[rank][1][p + span - 1]))
    return copies, firsts


def test_passages_equal_brute_force(spark):
    rng = random.Random(3)

    def text(n):
        return [f"w{rng.randrange(10**5)}" for _ in range(n)]

    base = [text(rng.randint(50, 140)) for _ in range(6)]
    rows = []
    for doc in range(60):
        words = text(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            one = rng.choice(base)
            low = rng.randint(0, len(one) - 50)
            words += one[low : rng.randint(low + 40, len(one))] + text(rng.randint(0, 60))
        rows.append((doc, "".join(w.upper() + rng.choice([" ", "\n", " é\t", "\r\n"] if rng.random() < 0.02 else [" ", "\n", "  "]) for w in words)))
    rows += [(100, None), (101, ""), (102, "a " * 130), (None, " ".join(base[0]))]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, at int").repartition(5)
    copies, firsts = brute(rows, passages.SPAN)
    got = passages.repeated(docs).collect()
    mine = {False: defaultdict(set), True: defaultdict(set)}
    for r in got:
        mine[r.kept][r.doc].update(range(r.start, r.end))
        assert not r.kept or r.cluster_doc == r.doc
    assert mine[False] == copies and mine[True] == firsts and len(copies) > 10
    assert passages.repeated(docs.limit(0)).count() == 0


def test_passage_in_other_lines_is_reported_and_cut(spark, tmp_path):
    rng = random.Random(4)
    own = [[f"{c}{rng.randrange(10**6)}" for _ in range(90)] for c in "ab"]
    shared = [f"s{rng.randrange(10**6)}" for _ in range(60)]
    long = " ".join(own[0][:40] + shared + own[0][40:])
    wrapped = "\n".join(" ".join(x) for x in (own[1][:5] + shared[:8], shared[8:27], shared[27:45], shared[45:] + own[1][5:9]))
    docs = spark.createDataFrame([(1, long), (2, wrapped)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    from quarrystone.llm.queries_paragraphs import op6_paragraph_dedup

    got = {r.doc_id: r for r in op6_paragraph_dedup(spark, str(tmp_path)).collect()}
    assert {i: (r.cluster_doc_id, r.kept, r.line) for i, r in got.items()} == {1: (1, True, None), 2: (1, False, None)}
    assert [t[got[i].start : got[i].end].split() for i, t in ((1, long), (2, wrapped))] == [shared, shared]
    slim = {r.doc_id: r.text for r in paragraphs.without_copies(docs, paragraphs.copies(docs)).collect()}
    assert slim[1] == long and slim[2].split() == own[1][:9]


def test_rows_that_share_an_id_keep_their_own_texts(spark):
    rng = random.Random(5)

    def text(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    rows = []
    for doc in range(12):
        for copy in (0, 1):  # two texts of one id, each with a near copy under an id of its own
            words = text(70)
            rows += [(doc, " ".join(words)), (1000 + 2 * doc + copy, " ".join([*words[:30], "edit", *words[31:]]))]
    docs = spark.createDataFrame([(None, rows[0][1].replace("w", "v")), (None, rows[0][1]), *rows], "doc_id long, text string").repartition(3)
    found = {(r.doc, r.cluster_doc) for r in paragraphs.clusters(docs).collect()}
    assert {(1000 + 2 * doc + copy, doc) for doc in range(12) for copy in (0, 1)} <= found and (None, 0) in found
