"""SimHash near-dedup: exact tiled comparison of 64-bit fingerprints with exclusive-or and bit counts.

Fingerprints are made once a document in Arrow batches; equal ones are collapsed before anything is compared. Distinct
fingerprints are dealt into blocks by their population count: two words within r bits have counts within r, so only pairs
of neighbouring blocks meet. Inside a pair of blocks, rows are sorted by the counts of their four 16-bit quarters, cut into
tiles, and a pair of tiles is skipped when the quarters' counts alone are further apart than the radius. What remains is
compared exactly; each task returns a spanning star of its links, never the pairs.

Comparing all fingerprints is quadratic by nature. A block holds at most ``BLOCK`` rows, so memory and time of a task are
bounded; the number of tasks is what grows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import scratch
from quarrystone.llm.components import components

SEED, WIDTH, RADIUS = 42, 4, 4
BLOCK, TILE, CHUNK = 262_144, 512, 16_384


def fingerprint(text: str | None, width: int = WIDTH, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's word shingles as an unsigned integer; 0 for a text without words.

    A-Z are lower-cased, words are runs of anything but ASCII white space, repeats of a shingle count, and a bit is one if
    it is set in over half the shingles' XXH64. Fewer words than ``width`` make one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    width = min(width, len(words))
    spans = list(zip((ends - size)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True))
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(spans), CHUNK):
        part = spans[at : at + CHUNK]
        hashes = np.fromiter([digest(joined[a:b], seed) for a, b in part], np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(id_col, fp long): the fingerprint's bits as a signed integer, one row per row of ``docs``; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py(), width, seed) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def _roots(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Unites pairs of positions in ``root``, in which every entry points at the smallest member so far."""
    while left.size:
        a, b = root[left], root[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _quarters(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _tiles(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.arange(0, len(counts), TILE)
    return starts, np.minimum.reduceat(counts, starts, axis=0), np.maximum.reduceat(counts, starts, axis=0)


def links(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within ``radius`` bits, tile by tile; ``left`` and ``right`` are sorted by their quarters."""
    starts, low, high = _tiles(_quarters(left))
    other, other_low, other_high = (starts, low, high) if same else _tiles(_quarters(right))
    for i, at in enumerate(starts):
        gap = np.maximum(0, np.maximum(low[i] - other_high, other_low - high[i])).sum(axis=1)
        for j in np.flatnonzero(gap <= radius):
            if same and j < i:
                continue
            near = np.bitwise_count(left[at : at + TILE, None] ^ right[None, other[j] : other[j] + TILE]) <= radius
            a, b = np.nonzero(near)
            a, b = a + at, b + other[j]
            if same:
                a, b = a[a < b], b[a < b]
            if a.size:
                yield a, b


def _compare(pdf: pd.DataFrame, radius: int) -> pd.DataFrame:
    """A spanning star of the links in one pair of blocks: (u, v) with v the smallest representative it reaches here."""
    pdf = pdf.sort_values("rep", kind="stable")
    rep, fp, side = (pdf[c].to_numpy() for c in ("rep", "fp", "side"))
    fp, root, same = np.ascontiguousarray(fp).view(np.uint64), np.arange(len(fp)), not side.any()
    order = []
    for which in (0,) if same else (0, 1):
        own = np.flatnonzero(side == which)
        order.append(own[np.lexsort(_quarters(fp[own]).T[::-1])] if own.size else own)
    if all(x.size for x in order):
        for a, b in links(fp[order[0]], fp[order[-1]], radius, same):
            _roots(root, order[0][a], order[-1][b])
    linked = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"u": rep[linked], "v": rep[root[linked]]})


def edges(classes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(u, v) links that span the components of ``classes`` (rep long, fp long with distinct fp) under ``radius`` bits."""
    counted = classes.withColumn("ones", F.bit_count("fp"))
    ones = [0] * 65
    for row in counted.groupBy("ones").count().collect():  # 65 rows at most
        ones[row["ones"]] = row["count"]
    total = sum(ones)
    target = max(1024, min(block, int(total / max(1.0, 0.3 * total ** (1 / 3)))))
    first, parts, filled, number = [0] * 65, [1] * 65, 0, 0
    for k, n in enumerate(ones):  # neighbouring counts share a block until it is full; one count may need several
        if filled and filled + n > target:
            number, filled = number + 1, 0
        first[k] = number
        if n > target:
            parts[k] = -(-n // target)
            number, filled = number + parts[k], 0
        else:
            filled += n
    def at(values: list[int], k) -> F.Column:  # noqa: ANN001
        return F.element_at(F.array(*map(F.lit, values)), k + 1)

    low = [first[max(0, k - radius)] for k in range(65)]
    high = [first[min(64, k + radius)] + parts[min(64, k + radius)] - 1 for k in range(65)]
    blocks = number + 1
    own = at(first, F.col("ones")) + F.pmod(F.xxhash64("fp"), at(parts, F.col("ones")).cast("long")).cast("int")
    dealt = (
        counted.withColumn("own", own)
        .select("rep", "fp", "own", F.explode(F.sequence(at(low, F.col("ones")), at(high, F.col("ones")))).alias("other"))
        .select("rep", "fp", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") > F.col("other")).cast("int").alias("side"))
        .withColumn("pair", F.col("a").cast("long") * blocks + F.col("b"))
    )
    return dealt.select("pair", "rep", "fp", "side").groupBy("pair").applyInPandas(lambda pdf: _compare(pdf, radius), "u long, v long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, width: int = WIDTH, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(id_col, fp long, component long): documents whose fingerprints reach each other in steps of ``radius`` bits.

    ``component`` is the smallest id reachable, the document itself included. A null or empty text has fingerprint zero and
    links like any other; repeated rows stay and share a component; a null id gets its fingerprint and the component of
    the documents it reaches, null if none of them has an id. An empty table gives an empty result; other columns are not
    read.
    """
    made = scratch.keep(fingerprints(docs, id_col, text_col, width, seed).withColumn(id_col, F.col(id_col).cast("long")), "simhash")
    classes = scratch.keep(made.groupBy("fp").agg(F.coalesce(F.min(id_col), F.lit(2**63 - 1)).alias("rep")), "simhash-classes")
    found = components(edges(classes, radius, block))
    nothing = F.lit(2**63 - 1)  # stands for the one fingerprint held only by rows without an id
    labels = scratch.keep(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.nullif(F.coalesce("component", "rep"), nothing).alias("component")), "simhash-labels")
    return made.join(labels, "fp").select(id_col, "fp", "component")


def hexadecimal(fp: str = "fp") -> F.Column:
    """Sixteen lower-case hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def first_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """Pipeline form: of each group of near copies the row with the smallest id stays, with all its columns.

    Rows without an id always stay; rows that repeat the smallest id stay together, as ids name documents.
    """
    groups = simhash_groups(docs, id_col, text_col, **how)
    gone = groups.where(F.col(id_col) != F.col("component")).select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
