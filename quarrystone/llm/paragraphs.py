"""Substring dedup by paragraphs: MinHash banding, exact verification, removal by connected components.

Verbatim passages inside other text, or over several lines, are found by :mod:`quarrystone.llm.passages`. A paragraph is a line
of at least ``WORDS`` words. Equal paragraphs (A-Z lower-cased, white space collapsed) are one class. Classes whose MinHash
signatures agree in a band share a bucket. Buckets are worked off in two passes, so that no pair list of a bucket is ever written:

1. every class of a bucket is verified against the bucket's most frequent class, and what links is united;
2. buckets that still hold classes of different components are gone through again: those outside the bucket's largest component
   are compared with all its classes inside tasks, in chunks where a bucket is large, skipping pairs already united, and each
   task returns only links that unite two components.

Pass 1 settles groups of near copies however large; pass 2 sees the rest, so that every link between two classes that share a
bucket takes effect. Shingles are fetched only for classes that share a bucket at all, once. Joins on hot keys are between
written tables, where adaptive execution splits them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import passages, pieces, scratch
from quarrystone.llm.components import components

WORDS, WIDTH, SIMILARITY, RECALL, BANDS, CHUNK = 20, 5, 0.8, 0.9995, 24, 512
BLOCK = 64  # sets compared with one set at a time
Norm = list[bytes]


def tune(similarity: float = SIMILARITY, recall: float = RECALL, most: int = BANDS) -> tuple[int, int]:
    """(bands, rows): the most selective banding of at most ``most`` bands that finds a pair at ``similarity`` this surely."""
    best = (most, 1)
    for rows in range(1, 17):
        for bands in range(1, most + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                best = (bands, rows)
                break
        else:
            break
    return best


def paragraphs(text: str | None, least: int = WORDS) -> Iterator[tuple[int, int, int, Norm]]:
    """(line number, start, end in code points, words) of each line of at least ``least`` words."""
    at = 0
    for number, line in enumerate((text or "").split("\n")):
        words = line.encode().lower().split()
        if len(words) >= least:
            yield number, at, at + len(line), words
        at += len(line) + 1


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the exact Jaccard similarity of two sorted sets reaches the threshold."""
    small, large = sorted((len(a), len(b)))
    if small < similarity * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements each of ``others`` shares with ``one``; all are sorted and distinct."""
    if not others or not len(one):
        return np.zeros(len(others), np.int64)
    every = np.concatenate(others)
    same = one[np.minimum(np.searchsorted(one, every), len(one) - 1)] == every
    return np.bincount(np.repeat(np.arange(len(others)), [len(x) for x in others])[same], minlength=len(others))


def _bucket(node: np.ndarray, root: np.ndarray, side: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that join components which meet in one bucket, of its rows on side 1 with all rows: (node, other node)."""
    group = {r: r for r in root.tolist()}

    def top(r: int) -> int:
        while group[r] != r:
            group[r] = group[group[r]]
            r = group[r]
        return r

    found = []
    size = np.array([len(x) for x in sets])
    for i in np.flatnonzero(side).tolist():
        fits = (size >= similarity * size[i]) & (similarity * size <= size[i]) & (root != root[i])
        others = np.flatnonzero(fits).tolist()
        for at in range(0, len(others), BLOCK):
            some = [j for j in others[at : at + BLOCK] if top(int(root[j])) != top(int(root[i]))]
            both = shared(sets[i], [sets[j] for j in some])
            for k in np.flatnonzero(both >= similarity * (size[i] + size[some] - both)).tolist() if some else ():
                x, y = top(int(root[i])), top(int(root[some[k]]))
                if x != y:
                    group[max(x, y)] = min(x, y)
                    found.append((int(node[some[k]]), int(node[i])))
    return found


def _compared(rest: DataFrame, similarity: float) -> DataFrame:
    """(u, v) links of all groups of ``rest`` (bucket, a, b, node, root, side, grams): rows of a group are brought together
    and sorted, and a task goes through its groups one after another, holding no more than two chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> list[tuple[int, int]]:
            node, root, side = (np.array([h[k] for h in held], np.int64) for k in (3, 4, 5))
            return _bucket(node, root, side, [np.frombuffer(h[6], np.uint64) for h in held], similarity)

        def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"])

        for batch in batches:
            links: list[tuple[int, int]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    links += close()
                    held = []
                held.append(row)
            yield out(links)
        if held:
            yield out(close())

    columns = ["bucket", "a", "b", "node", "root", "side", "grams"]
    return rest.select(columns).repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b", "node").mapInArrow(run, "u long, v long")


def _candidates(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A scan's lines without their bands, the classes of lines (key, first place, n, node), and the members (bucket, node, n) of the
    buckets that several classes share."""
    lines = found.where("line IS NOT NULL")
    plain = scratch.keep(lines.select("doc", "line", F.col("start").cast("long"), F.col("end").cast("long"), "key"), "paragraph-lines")
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "line", "t")
    classes = scratch.keep(lines.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n")).withColumn("node", F.monotonically_increasing_id()), "paragraph-classes")
    each = lines.where("buckets IS NOT NULL").select(F.xxhash64("key").alias("h"), F.explode("buckets").alias("bucket"))  # h stands for the key until members are few
    shared = scratch.keep(each.groupBy("bucket").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low != high").select("bucket"), "paragraph-buckets")
    some = scratch.keep(each.join(shared, "bucket").groupBy("bucket", "h").agg(F.count("*").alias("times")).drop("times"), "paragraph-some")
    wanted = scratch.keep(some.select("h").distinct().join(classes.select(F.xxhash64("key").alias("h"), "node", "n"), "h"), "paragraph-nodes")
    members = scratch.keep(some.join(wanted, "h").select("bucket", "node", "n"), "paragraph-members")
    scratch.drop(shared, some, wanted)
    return plain, classes, members


def _linked(members: DataFrame, sets: DataFrame, similarity: float, chunk: int) -> DataFrame:
    """(node, component) of the classes that link with another of their bucket."""

    def verify(x: pa.Array, y: pa.Array) -> pa.Array:
        (a, a_at), (b, b_at) = pieces.flat(x, np.uint64), pieces.flat(y, np.uint64)
        return pa.array([alike(a[i:j], b[k:m], similarity) for i, j, k, m in zip(a_at[:-1], a_at[1:], b_at[:-1], b_at[1:], strict=True)], pa.bool_())

    leaders = members.groupBy("bucket").agg(F.min(F.struct((-F.col("n")).alias("n"), "node")).alias("leader")).select("bucket", F.col("leader.node").alias("leader"))
    pairs = scratch.keep(members.join(scratch.keep(leaders, "paragraph-leaders"), "bucket").where("node != leader").select("node", "leader").distinct(), "paragraph-pairs")
    one = scratch.keep(pairs.join(sets, "node"), "paragraph-left")
    both = one.join(sets.select(F.col("node").alias("leader"), F.col("grams").alias("others")), "leader")
    links = scratch.keep(both.where(F.arrow_udf(verify, "boolean")("grams", "others")).select(F.col("node").alias("u"), F.col("leader").alias("v")), "paragraph-links")
    scratch.drop(pairs, one)
    roots = scratch.keep(components(links), "paragraph-roots")
    placed = members.select("bucket", "node").join(roots, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("root"))
    placed = scratch.keep(placed, "paragraph-placed")
    # buckets of several bands often hold the same classes: one of those with equal members (by 128 bits) stands for all
    marks = [F.bit_xor(F.xxhash64(*k)).alias(n) for n, k in (("x", ["node"]), ("y", ["node", F.lit("again")]))]
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"), *marks).where("low != high")
    mixed = scratch.keep(mixed.groupBy("x", "y", "size").agg(F.min("bucket").alias("bucket")).select("bucket", "size"), "paragraph-mixed")
    rest = scratch.keep(placed.join(mixed, "bucket"), "paragraph-rest")
    largest = rest.groupBy("bucket", "root").agg(F.count("*").alias("own")).groupBy("bucket").agg(F.max(F.struct("own", "root")).alias("most"))
    largest = scratch.keep(largest.select("bucket", F.col("most.own").alias("own"), F.col("most.root").alias("main")), "paragraph-largest")
    cut = rest.join(largest, "bucket").withColumns({"chunks": F.ceil(F.col("size") / chunk).cast("int"), "parts": F.ceil((F.col("size") - F.col("own")) / chunk).cast("int")})
    every = cut.select("bucket", "node", "root", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("b"), F.lit(0).alias("side"))
    outer = cut.where("root != main").select("bucket", "node", "root", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("a"), F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("b"), F.lit(1).alias("side"))
    dealt = every.unionByName(outer).join(sets, "node")
    more = scratch.keep(_compared(dealt, similarity), "paragraph-more")
    scratch.drop(links, placed, mixed, rest, largest)
    return roots if more.isEmpty() else _joined(roots, more)


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """(node, component) where links ``more`` (u, v) unite components of ``roots``, or classes that are in none."""
    for side in ("u", "v"):
        more = more.join(roots.select(F.col("node").alias(side), F.col("component").alias(f"{side}_root")), side, "left").withColumn(f"{side}_root", F.coalesce(f"{side}_root", side))
    tops = scratch.keep(components(more, "u_root", "v_root"), "paragraph-tops")
    moved = roots.join(tops.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return scratch.keep(moved.unionByName(tops.join(roots, "node", "left_anti")), "paragraph-components")


def _named(lines: DataFrame, classes: DataFrame, linked: DataFrame) -> DataFrame:
    """(doc, line, start, end, cluster_doc, cluster_line, kept) of the lines whose class has copies or links."""
    named = classes.select("node", "key", "first", "n").join(linked, "node", "left").where("component IS NOT NULL OR n > 1").withColumn("component", F.coalesce("component", "node"))
    named = scratch.keep(named, "paragraph-named")
    heads = scratch.keep(named.groupBy("component").agg(F.min("first").alias("head")), "paragraph-heads")
    labels = scratch.keep(named.join(heads, "component").select("key", F.col("head.doc").alias("cluster_doc"), F.col("head.line").alias("cluster_line")), "paragraph-labels")
    out = lines.join(labels, "key")
    kept = F.col("doc").eqNullSafe(F.col("cluster_doc")) & (F.col("line") == F.col("cluster_line"))
    return out.select("doc", "line", "start", "end", "cluster_doc", "cluster_line", kept.alias("kept"))


def _wanted(classes: DataFrame, members: DataFrame) -> DataFrame:
    """(doc, t, line, key, node): where the shingles of the members' classes are to be looked up."""
    return members.select("node").distinct().join(classes, "node").select("first.doc", "first.t", "first.line", "key", "node")


def clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = WORDS, similarity: float = SIMILARITY, chunk: int = CHUNK) -> DataFrame:
    """(doc, line, start, end, cluster_doc, cluster_line, kept): the paragraphs that have an equal or near copy.

    Two paragraphs are near copies if the Jaccard similarity of their word shingles is ``similarity`` or more; a cluster is a
    component under this relation among paragraphs found by the bands. It is named by its first paragraph, by document and
    line, which alone is kept. Start and end are code points, end exclusive. Paragraphs without a copy are absent. A null
    text is empty; rows that repeat a document repeat its paragraphs, of which all at the first place are kept; rows that share
    an id but not the text are compared each with its own text; a null id ranks after all others. ``least`` is at least
    ``WIDTH``. Other columns are not read; an empty table gives an empty result.
    """
    bands, rows = tune(similarity)
    texts = pieces.texts(docs, id_col, text_col)
    found = scratch.keep(pieces.scan(texts, max(least, WIDTH), WIDTH, bands, rows, None, 0), "paragraphs")
    lines, classes, members = _candidates(found)
    scratch.drop(found)
    sets = scratch.keep(pieces.look_up(texts, _wanted(classes, members), None, WIDTH, 0).select("node", "grams").dropDuplicates(["node"]), "paragraph-sets")
    return _named(lines, classes, _linked(members, sets, similarity, chunk))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of :func:`clusters`, and those of :func:`passages.repeated` with a null line: a passage keeps to no line.

    Both come from one scan of the texts and one look-up.
    """
    bands, rows = tune()
    texts = pieces.texts(docs, id_col, text_col)
    found = scratch.keep(pieces.scan(texts, WORDS, WIDTH, bands, rows, passages.SPAN, passages.GRAM), "paragraphs")
    lines, classes, members = _candidates(found)
    runs = passages.marked(found)
    scratch.drop(found)
    wanted = scratch.keep(_wanted(classes, members), "paragraph-wanted")
    looked = scratch.keep(pieces.look_up(texts, wanted, runs, WIDTH, passages.SPAN), "paragraph-looked-up")
    scratch.drop(wanted, runs)
    spans = passages.compared(looked.where("anchor IS NOT NULL"))
    sets = scratch.keep(looked.where("node IS NOT NULL").select("node", "grams").dropDuplicates(["node"]), "paragraph-sets")
    scratch.drop(looked)
    linked = _linked(members, sets, SIMILARITY, CHUNK)
    none = F.lit(None).cast("int")
    spans = spans.select("doc", none.alias("line"), "start", "end", "cluster_doc", none.alias("cluster_line"), "kept")
    return _named(lines, classes, linked).unionByName(spans)


def without_copies(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without what :func:`clusters` or :func:`copies` does not keep: lines are taken out, passages cut from theirs."""

    def cut(text: pa.Array, marks: pa.Array) -> pa.Array:
        out = []
        for one, marked in zip(text, marks, strict=True):
            marked = marked.as_py() or ()
            drop = {m["line"] for m in marked if m["line"] is not None}
            spans = [m for m in marked if m["line"] is None]
            if not marked or not one.is_valid:
                out.append(one.as_py())
                continue
            whole, at, lines = one.as_py(), 0, []
            gone = np.zeros(len(whole) + 1 if spans else 0, bool)
            for kept in (False, True):
                for m in spans:
                    if m["kept"] == kept:
                        gone[m["start"] : m["end"]] = not kept
            for i, line in enumerate(whole.split("\n")):
                if i not in drop:
                    lines.append("".join(c for c, g in zip(line, gone[at : at + len(line)], strict=True) if not g) if gone[at : at + len(line)].any() else line)
                at += len(line) + 1
            out.append("\n".join(lines))
        return pa.array(out, pa.string())

    gone = found.where(~F.col("kept") | F.col("line").isNull()).groupBy(F.col("doc").alias("__doc")).agg(F.collect_set(F.struct("line", "start", "end", "kept")).alias("__marks"))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone["__doc"]), "left")
    cut_text = F.arrow_udf(cut, "string")(docs[text_col].cast("string"), gone["__marks"])
    return joined.select(*(cut_text.alias(c) if c == text_col else docs[c] for c in docs.columns))
