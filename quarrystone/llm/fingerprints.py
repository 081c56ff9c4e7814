"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Every word shingle is hashed once; the hash's top bits choose one of ``BINS`` bins and the smallest hash of a bin stays. An
empty bin takes over the value of a full one, chosen by a fixed random order of its own ("Optimal Densification for Fast and
Accurate Minwise Hashing", Shrivastava, 2017). Of every value ``BITS`` low-order bits are stored; the share of equal ones
overstates the Jaccard similarity by chance hits, which :func:`likeness` takes out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS, BITS, WIDTH = 512, 8, 5
CHUNK = 1 << 18


@cache
def _orders(bins: int) -> np.ndarray:
    """For each bin a random order of all bins, the same everywhere."""
    rng = np.random.default_rng(20170)
    return np.stack([rng.permutation(bins) for _ in range(bins)]).astype(np.int16 if bins <= 1 << 15 else np.int32)


def _smallest(words: list[bytes], width: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest shingle hash of each bin, and which bins have one."""
    digest, shift = xxhash.xxh64_intdigest, np.uint64(64 - bins.bit_length() + 1)
    least, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    width = min(width, len(words))
    for at in range(0, len(words) - width + 1, CHUNK):
        part = words[at : at + CHUNK + width - 1]
        w = np.fromiter(map(digest, part), np.uint64, len(part))
        h = np.zeros(len(part) - width + 1, np.uint64)
        for j in range(width):
            h = (h ^ w[j : j + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h = np.sort(h * np.uint64(0xBF58476D1CE4E5B9))
        b = (h >> shift).astype(np.int64)
        first = np.append(True, b[1:] != b[:-1])
        b, h = b[first], h[first]
        least[b] = np.where(full[b], np.minimum(least[b], h), h)
        full[b] = True
    return least, full


def fingerprint(text: str | None, width: int = WIDTH, bins: int = BINS, bits: int = BITS) -> bytes:
    """``bins`` times ``bits`` bits, packed; empty bytes for a text without words.

    Words are runs of anything but ASCII white space with A-Z lower-cased; fewer than ``width`` words make one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return b""
    least, full = _smallest(words, width, bins)
    empty = np.flatnonzero(~full)
    orders = _orders(bins)
    for low, high in ((0, 8), (8, bins)):  # most empty bins find a full one at once
        if empty.size:
            tried = full[orders[empty, low:high]]
            hit = tried.any(axis=1)
            donor = orders[empty[hit], low + tried[hit].argmax(axis=1)]
            least[empty[hit]] = least[donor]
            empty = empty[~hit]
    low_bits = least & np.uint64((1 << bits) - 1)
    if bits == 8:
        return low_bits.astype(np.uint8).tobytes()
    return np.packbits(((low_bits[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()


def likeness(a: bytes, b: bytes, bits: int = BITS) -> float:
    """Estimated Jaccard similarity of two fingerprints of one shape, from 0 to 1.

    Two empty fingerprints are alike (1), an empty one is unlike any other (0).
    """
    if not a or not b:
        return float(a == b)
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if bits != 8:
        x, y = (np.packbits(np.unpackbits(v, bitorder="little").reshape(-1, bits), axis=1, bitorder="little").reshape(-1, -(-bits // 8)) for v in (x, y))
        same = float((x == y).all(axis=1).mean())
    else:
        same = float((x == y).mean())
    chance = 2.0**-bits
    return max(0.0, (same - chance) / (1 - chance))


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", **shape: int) -> DataFrame:
    """``docs`` with the binary column ``name`` (replaced if it exists); a null text counts as empty."""

    @F.arrow_udf("binary")
    def run(text: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x.as_py(), **shape) for x in text], pa.binary())

    return docs.withColumn(name, run(F.col(text_col).cast("string")))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the start of the next, or by all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its next one by descending id, after the last the first: rows dealt out by ranges of ids.

    Returns (part int, extra int, id, text), partitioned by ``part`` and sorted so that the row after a row with ``extra``
    0 is its next. The first row of each range is also given to the range before it, with ``extra`` 1. Rows without an id
    come last; rows with one id are ordered by text. Only one id a range reaches the driver, and texts are shuffled once.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    cuts = np.array(sorted(set(found or [])), np.int64)

    def ranges(ids: pa.Array) -> np.ndarray:  # the highest ids are range 0, those without one come last
        place = len(cuts) - np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), side="left")
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(cuts) + 1, place).astype(np.int32)

    @F.arrow_udf("int")
    def part(ids: pa.Array) -> pa.Array:
        return pa.array(ranges(ids), pa.int32())

    tops = {r.part: r.top for r in rows.select(part("id").alias("part"), "id").groupBy("part").agg(F.max("id").alias("top")).collect()}  # a row a range
    used = sorted(tops)
    before = {p: used[i - 1] for i, p in enumerate(used)}

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array) -> pa.Array:
        return pa.array([[p, before[p]] if tops[p] == i else [p] for p, i in zip(ranges(ids).tolist(), ids.to_pylist(), strict=True)], pa.list_(pa.int32()))

    dealt = rows.select("id", "text", F.posexplode(places("id")).alias("extra", "part"))
    return dealt.select("part", "extra", "id", "text").repartitionById(len(cuts) + 2, F.col("part")).sortWithinPartitions("part", "extra", F.col("id").desc_nulls_last(), "text")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row per row of ``docs``.

    The edited text is :func:`edited` of a text and the next by descending id (see :func:`neighbours`); fingerprints are
    binary. A null text counts as empty; an empty table gives an empty result; other columns are not read. A single row is
    its own next.
    """
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (part, id, text, fingerprint) of a row that still lacks its next
        for batch in batches:
            out = []
            for part, extra, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if extra and (last is None or last[0] != part):
                    continue
                text = text.as_py()
                own = fingerprint(text)
                if last is not None and last[0] == part:
                    new = edited(last[2], text)
                    print_ = fingerprint(new)
                    out.append((last[1], len(last[2]), hashlib.sha256(new.encode()).hexdigest(), last[3], print_, likeness(last[3], print_), likeness(last[3], own)))
                last = None if extra else (part, row, text, own)
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return neighbours(docs, id_col, text_col).mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double").withColumnRenamed("id", id_col)
