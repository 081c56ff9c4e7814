"""Embedding near-dedup with a forest of random-projection trees.

Equal vectors of a label are collapsed first. The forest is fitted on the driver from a bounded sample:
each node splits at the median of a random projection, and vectors near the split go to both sides. Every vector is then
routed through every tree and meets the others of its leaf in one task, where all cosines are computed, in blocks. A leaf of
more than ``LARGE`` rows, for which the sample was too coarse, is cut into chunks whose pairs are compared in the same way.

Tasks return link counts and a spanning star of their links, not the pairs. Two vectors may share leaves of several trees;
their link is counted in the first of them alone, which both can tell because every row carries its list of leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import scratch
from quarrystone.llm.components import components

COSINE = 0.93
#: Rows in the driver's sample, trees, and the share of a node's rows on each side of a split that go to both.
SAMPLE, TREES, SPILL = 8_192, 6, 0.1
#: Rows of a node's sample whose links are looked at, and the share of links that a tree must leave together.
SEEN, KEPT = 256, 0.45
#: Rows expected in a leaf, rows beyond which a leaf is cut into chunks, rows of a chunk.
LEAF, LARGE, CHUNK = 2_048, 8_192, 4_096
STRIDE = 1 << 20


def keyed(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label string, dim, key, vec binary); key and vec are null where the row can link with nothing."""
    double = "double" in vectors.schema[vector_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, keys, raw = [], [], []
            for row, label, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                x = x.values if x.is_valid and row is not None and label is not None else None
                v = None if x is None or x.null_count or not len(x) else x.to_numpy(zero_copy_only=False).astype(np.float64 if double else np.float32) + 0.0
                if v is None or not np.isfinite(v).all() or not v.any():
                    v = None
                dims.append(0 if v is None else len(v))
                raw.append(None if v is None else v.tobytes())
                keys.append(None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], ["id", "label", "dim", "key", "vec"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vec")).mapInArrow(run, "id long, label string, dim int, key binary, vec binary")


def _unit(rows: list[bytes], dim: int) -> np.ndarray:
    kind = np.float32 if len(rows[0]) == 4 * dim else np.float64
    x = np.frombuffer(b"".join(rows), kind).reshape(-1, dim).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _split(x: np.ndarray, seed: int, spill: float) -> tuple[float, float, float, np.ndarray]:
    """Threshold, and how far to each side of it rows go to both children."""
    p = x @ np.random.default_rng(seed).standard_normal(x.shape[1])
    low, middle, high = np.quantile(p, [0.5 - spill, 0.5, 0.5 + spill])
    return float(middle), float(low), float(high), p


def _survives(x: np.ndarray, p: np.ndarray, low: float, high: float, cosine: float) -> float:
    """The share of the links of a few rows that a split leaves within a child; 1 where too few show."""
    some = np.linspace(0, len(x) - 1, min(len(x), SEEN)).astype(int)
    a, b = np.nonzero(np.triu(x[some] @ x[some].T >= cosine, 1))
    p = p[some]
    together = (p[a] <= high) & (p[b] <= high) | (p[a] >= low) & (p[b] >= low)
    return float(together.mean()) if len(a) >= 32 else 1.0


def grow(x: np.ndarray, rows: float, leaf: int, seed: int, spill: float = SPILL, cosine: float = COSINE) -> list[tuple]:
    """A tree over sample ``x`` that stands for ``rows`` rows: nodes (seed, low, high, left, right) or (leaf number,).

    A node stays whole, whatever its size, where splitting it would leave fewer than ``KEPT`` of the links since the root
    together: in a group of near copies every split is random.
    """
    nodes: list[tuple] = []
    leaves = 0

    def add(idx: np.ndarray, share: float, together: float) -> int:
        nonlocal leaves
        at = len(nodes)
        nodes.append(())
        if share <= leaf or len(idx) < 16:
            nodes[at] = (leaves,)
            leaves += 1
            return at
        own = (seed * 1_000_003 + at) % (1 << 31)
        middle, low, high, p = _split(x[idx], own, spill)
        left, right = idx[p <= high], idx[p >= low]
        together *= _survives(x[idx], p, low, high, cosine)
        if len(left) == len(idx) or len(right) == len(idx) or together < KEPT:
            nodes[at] = (leaves,)
            leaves += 1
            return at
        nodes[at] = (own, low, high, add(left, share * len(left) / len(idx), together), add(right, share * len(right) / len(idx), together))
        return at

    add(np.arange(len(x)), rows, 1.0)
    return nodes


def route(x: np.ndarray, nodes: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf number, positions) for each leaf that gets rows."""
    work = [(0, np.arange(len(x)))]
    while work:
        at, idx = work.pop()
        node = nodes[at]
        if len(node) == 1:
            yield node[0], idx
            continue
        seed, low, high, left, right = node
        p = x[idx] @ np.random.default_rng(seed).standard_normal(x.shape[1])
        work += [(side, part) for side, part in ((left, idx[p <= high]), (right, idx[p >= low])) if len(part)]


def routed(classes: DataFrame, sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, cosine: float = COSINE) -> DataFrame:
    """(label, dim, code, codes, rep, mult, vec): a row for each leaf of each tree that a vector is in."""
    total = classes.count()
    taken = classes.orderBy(F.xxhash64("key"), "label", "dim", "key").limit(sample).select("label", "dim", "vec").collect()  # bounded by ``sample``
    groups: dict[tuple[str, int], list[bytes]] = {}
    for r in taken:
        groups.setdefault((r.label, r.dim), []).append(bytes(r.vec))
    forest = {}
    for (label, dim), rows in groups.items():
        x, share = _unit(rows, dim), len(rows) * total / max(1, len(taken))
        grown = [grow(x, share, leaf, int.from_bytes(hashlib.blake2b(f"{label}|{dim}|{t}".encode(), digest_size=4).digest(), "big"), spill, cosine) for t in range(trees)]
        forest[label, dim] = grown[:1] if all(len(g) == 1 for g in grown) else grown
    whole = [[(0,)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            out = []
            for (label, dim), part in pdf.groupby(["label", "dim"], sort=False):
                x = _unit(list(part["vec"]), dim)
                codes: list[list[int]] = [[] for _ in range(len(part))]
                for t, nodes in enumerate(forest.get((label, int(dim)), whole)):
                    for number, idx in route(x, nodes):
                        for i in idx.tolist():
                            codes[i].append(t * STRIDE + number)
                part = part.assign(codes=[sorted(c) for c in codes])
                part["code"] = part["codes"]
                out.append(part.explode("code"))
            if out:
                made = pd.concat(out)
                yield pa.RecordBatch.from_arrays([pa.array(made[c], k) for c, k in (("label", pa.string()), ("dim", pa.int32()), ("code", pa.int32()), ("codes", pa.list_(pa.int32())), ("rep", pa.int64()), ("mult", pa.int64()), ("vec", pa.binary()))], ["label", "dim", "code", "codes", "rep", "mult", "vec"])

    return classes.select("label", "dim", "rep", "mult", "vec").mapInArrow(run, "label string, dim int, code int, codes array<int>, rep long, mult long, vec binary")


def _leaf(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """(rep, links, root) of the rows that have a link here; links counts those that no earlier leaf counts."""
    pdf = pdf.sort_values("rep", kind="stable")
    rep, mult, chunk = (pdf[c].to_numpy(np.int64) for c in ("rep", "mult", "chunk"))
    x, n, code, first = _unit(list(pdf["vec"]), int(pdf["dim"].iloc[0])), len(pdf), int(pdf["code"].iloc[0]), int(pdf["a"].iloc[0])
    links = np.zeros((n, n), bool)
    across = pdf["a"].iloc[0] != pdf["b"].iloc[0]
    for at in range(0, n, 1024):
        near = x[at : at + 1024] @ x.T >= cosine
        links[at : at + 1024] = near & (chunk[at : at + 1024, None] != chunk) if across else near & (first == chunk)
    np.fill_diagonal(links, False)
    linked = np.flatnonzero(links.any(axis=1))
    if not linked.size:
        return pd.DataFrame({"rep": rep[:0], "links": rep[:0], "root": rep[:0]})
    links, rep, mult, n = links[np.ix_(linked, linked)], rep[linked], mult[linked], len(linked)  # the others have no part in what follows
    lists = [[c for c in codes if c < code] for codes in pdf["codes"].iloc[linked]]
    place = {c: i for i, c in enumerate(sorted({c for codes in lists for c in codes}))}
    held = np.zeros((n, len(place)), np.float32)
    for i, codes in enumerate(lists):
        held[i, [place[c] for c in codes]] = 1
    count = np.zeros(n, np.int64)
    for at in range(0, n, 1024):
        own = links[at : at + 1024]
        if place:
            own = own & (held[at : at + 1024] @ held.T == 0)
        count[at : at + 1024] = np.where(own, mult, 0).sum(axis=1)
    root, seen = np.arange(n), np.zeros(n, bool)
    for i in range(n):
        if seen[i]:
            continue
        front = np.array([i])
        seen[i] = True
        while front.size:  # rows are sorted, so the first of a component is its smallest
            root[front] = i
            front = np.flatnonzero(links[front].any(axis=0) & ~seen)
            seen[front] = True
    return pd.DataFrame({"rep": rep, "links": count, "root": rep[root]})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF, large: int = LARGE, chunk: int = CHUNK) -> DataFrame:
    """(id_col, n_links, component, kept), a row per row of ``vectors``; other columns are not read.

    Rows link when their labels are equal and not null, their vectors have one length, and the cosine in double precision is
    ``cosine`` or more. A row whose id, label or vector is null, or whose vector is zero, empty or holds null or non-finite
    components, links with nothing and is its own component. ``n_links`` counts the other rows linked directly; rows that
    repeat count as rows. ``component`` is the smallest id reachable. An empty table gives an empty result.
    """
    rows = scratch.keep(keyed(vectors, id_col, vector_col, label_col), "vectors")
    classes = scratch.keep(rows.where("key IS NOT NULL").groupBy("label", "dim", "key").agg(F.min("id").alias("rep"), F.count("*").alias("mult"), F.first("vec").alias("vec")), "vector-classes")
    dealt = routed(classes, sample, trees, leaf, cosine=cosine)
    where = ["label", "dim", "code"]
    sizes = scratch.keep(dealt.groupBy(*where).count().where(F.col("count") > large).select(*where, F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "large-leaves")
    cut = dealt.join(sizes, where, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns({"a": F.least("chunk", "other"), "b": F.greatest("chunk", "other")})
    made = cut.groupBy(*where, "a", "b").applyInPandas(lambda pdf: _leaf(pdf, cosine), "rep long, links long, root long")
    found = scratch.keep(made, "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found, "rep", "root").withColumnRenamed("node", "rep")
    labels = scratch.keep(
        classes.select("label", "dim", "key", "rep", "mult").join(counts, "rep", "left").join(roots, "rep", "left")
        .select("label", "dim", "key", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")), "vector-labels")
    out = rows.select("id", "label", "dim", "key").join(labels, ["label", "dim", "key"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
