"""Verbatim passages of ``SPAN`` words or more that occur again, wherever lines break.

Every window of ``SPAN`` words is assigned to the least of its ``SPAN - GRAM + 1`` word ``GRAM``-grams, its anchor. That depends
on the words alone, so equal windows have equal anchors, and windows whose anchor occurs once need not be looked at again.
Those of the others are compared by 64-bit hashes beside the anchor's:

1. with the windows of the anchor's first occurrence, which settles what is copied from there however often;
2. what that leaves, among each other, by an aggregation over (anchor, offset, hash).

Consecutive windows that occur first in one document make one span. Joins on hot anchors are between written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import pieces, scratch

SPAN, GRAM = 50, 26


def borders(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in code points."""
    found = pieces.Layout(raw)
    return found.start, found.end


def _place() -> F.Column:
    return F.struct(F.col("doc").isNull().alias("none"), "doc", "t", "at")


def marked(found: DataFrame) -> DataFrame:
    """The runs of a scan whose anchors occur at several places, the first place of each anchor with ``lead`` set."""
    some = found.where("anchor IS NOT NULL").select("anchor", "doc", "t", "at", "n", "first")
    shared = scratch.keep(some.groupBy("anchor").agg(F.count("*").alias("count")).where("count > 1").select("anchor"), "passage-shared")
    held = scratch.keep(some.join(shared, "anchor"), "passage-held")
    leaders = scratch.keep(held.groupBy("anchor").agg(F.min(_place()).alias("leader")), "passage-first")
    out = scratch.keep(held.join(leaders, "anchor").select("anchor", "doc", "t", "at", "n", "first", (_place() == F.col("leader")).alias("lead")), "passage-wanted")
    scratch.drop(shared, held, leaders)
    return out


_SPAN = pa.struct([("low", pa.int32()), ("high", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_LEFT = pa.struct([("j", pa.int32()), ("h", pa.int64()), ("at", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_SPAN_SQL, _LEFT_SQL = "array<struct<low:int,high:int,start:int,end:int>>", "array<struct<j:int,h:bigint,at:int,start:int,end:int>>"


def _lists(row: np.ndarray, count: int, kind: pa.StructType, *columns: np.ndarray) -> pa.ListArray:
    """A list of structs for each of ``count`` rows, from the structs' rows and columns."""
    made = pa.StructArray.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, kind, strict=True)], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))]).astype(np.int32)), made)


def _spans(at: np.ndarray, row: np.ndarray, i: np.ndarray, chosen: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """The stretches of consecutive windows that are chosen, for each row."""
    held = np.flatnonzero(chosen)
    of, window = row[held], at[row[held]] + i[held]
    low = np.concatenate([[True], (of[1:] != of[:-1]) | (window[1:] != window[:-1] + 1)])[: len(held)]
    high = np.concatenate([low[1:], [True]])[: len(held)]
    return _lists(of[low], len(at), _SPAN, window[low], window[high], starts[held[low]], ends[held[high]])


def _settle(at: pa.Array, first: pa.Array, hashes: pa.Array, starts: pa.Array, ends: pa.Array, lead_first: pa.Array, lead_hashes: pa.Array) -> pa.Array:
    """Of each run: bits, by place before the anchor's end, of the windows that equal the leader's, the stretches they make, and
    the other windows."""
    p, f, g = (x.to_numpy().astype(np.int64) for x in (at, first, lead_first))
    (h, h_at), (k, k_at) = pieces.flat(hashes, np.int64), pieces.flat(lead_hashes, np.int64)
    (a, _), (b, _) = pieces.flat(starts, np.int32), pieces.flat(ends, np.int32)
    n = np.diff(h_at)
    row, i = np.repeat(np.arange(len(n)), n), pieces.runs(np.zeros(len(n), np.int64), n)
    place = f[row] + i
    there = k_at[row] + place - g[row]
    inside = (place >= g[row]) & (there < k_at[row + 1])
    same = np.zeros(len(row), bool)
    same[inside] = h[inside] == k[there[inside]]
    out = np.flatnonzero(~same)
    mask = np.bincount(row[same], np.ldexp(1.0, place[same]), len(n)).astype(np.int64)
    left = _lists(row[out], len(n), _LEFT, place[out], h[out], p[row[out]] + i[out], a[out], b[out])
    return pa.StructArray.from_arrays([pa.array(mask), _spans(p, row, i, same, a, b), left], ["mask", "spans", "left"])


def _masked(at: pa.Array, first: pa.Array, mask: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    """The stretches of windows that the mask holds."""
    p, f, m = (x.to_numpy().astype(np.int64) for x in (at, first, mask))
    (a, edge), (b, _) = pieces.flat(starts, np.int32), pieces.flat(ends, np.int32)
    n = np.diff(edge)
    row, i = np.repeat(np.arange(len(n)), n), pieces.runs(np.zeros(len(n), np.int64), n)
    return _spans(p, row, i, (m[row] >> (f[row] + i)) & 1 == 1, a, b)


def _merged(found: DataFrame) -> DataFrame:
    """(doc, start, end, cluster_doc, kept): adjoining stretches (low, high, start, end) that occur first in one document, as one."""
    kind = found.schema["doc"].dataType.simpleString()
    names = ["doc", "start", "end", "cluster_doc", "kept"]
    key = ["doc", "t", "owner", "owner_t", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # key, last window, start, end
        for batch in batches:
            out = []
            for *of, low, high, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[0] == of and low <= held[1] + 1:  # rows may repeat
                    held[1], held[3] = max(held[1], high), max(held[3], end)
                    continue
                if held is not None:
                    out.append(held)
                held = [of, high, start, end]
            yield made(out, batch)
        if held is not None:
            yield made([held], batch)

    def made(rows: list[list], like: pa.RecordBatch) -> pa.RecordBatch:
        kinds = (like.column(0).type, pa.int64(), pa.int64(), like.column(0).type, pa.bool_())
        columns = zip(*((k[0], start, end, k[2], k[4]) for k, _, start, end in rows), strict=True) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, kinds, strict=True)], names)

    dealt = found.select(*key, "low", "high", "start", "end").repartition("doc", "t")
    return dealt.sortWithinPartitions(*key, "low").mapInArrow(run, f"doc {kind}, start long, end long, cluster_doc {kind}, kept boolean")


def compared(members: DataFrame) -> DataFrame:
    """(doc, start, end, cluster_doc, kept) from the looked-up runs of :func:`marked`."""
    first = members.where("lead").dropDuplicates(["anchor"])
    leaders = scratch.keep(first.select("anchor", F.col("doc").alias("owner"), F.col("t").alias("owner_t"), F.col("first").alias("lead_first"), F.col("hashes").alias("lead_hashes")), "passage-leaders")
    both = members.where("NOT lead").select("anchor", "doc", "t", "at", "first", "hashes", "starts", "ends").join(leaders, "anchor")
    settle = F.arrow_udf(_settle, f"struct<mask:bigint,spans:{_SPAN_SQL},left:{_LEFT_SQL}>")
    both = both.withColumn("x", settle("at", "first", "hashes", "starts", "ends", "lead_first", "lead_hashes"))
    settled = scratch.keep(both.select("anchor", "doc", "t", "owner", "owner_t", "x.mask", "x.spans", "x.left"), "passage-compared")
    scratch.drop(leaders)
    # a leader's windows that some other occurrence equals
    masks = settled.groupBy("anchor").agg(F.bit_or("mask").alias("mask")).where("mask != 0")
    heads = members.where("lead").select("anchor", "doc", "t", "at", "first", "starts", "ends").dropDuplicates(["anchor"]).join(masks, "anchor")
    heads = heads.select("doc", "t", F.col("doc").alias("owner"), F.col("t").alias("owner_t"), F.lit(True).alias("kept"), F.explode(F.arrow_udf(_masked, _SPAN_SQL)("at", "first", "mask", "starts", "ends")).alias("x"))
    rest = settled.where(F.size("left") > 0)
    several = scratch.keep(rest.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "passage-several")
    rest = scratch.keep(rest.select("anchor", "doc", "t", "left").join(several, "anchor").select("anchor", "doc", "t", F.explode("left").alias("x")).select("anchor", "doc", "t", "x.*"), "passage-rest")
    again = rest.groupBy("anchor", "j", "h").agg(F.min(_place()).alias("low"), F.max(_place()).alias("high")).where("low != high")
    again = scratch.keep(again.select("anchor", "j", "h", F.col("low").alias("place")), "passage-again")
    others = rest.join(again, ["anchor", "j", "h"])
    others = others.select("doc", "t", F.col("place.doc").alias("owner"), F.col("place.t").alias("owner_t"), (_place() == F.col("place")).alias("kept"), F.col("at").alias("low"), F.col("at").alias("high"), "start", "end")
    columns = ["doc", "t", "owner", "owner_t", "kept", "x.*"]
    every = settled.withColumn("kept", F.lit(False)).withColumn("x", F.explode("spans")).select(columns).unionByName(heads.select(columns)).unionByName(others)
    out = scratch.keep(_merged(every), "passages")
    scratch.drop(settled, several, rest, again)
    return out


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc, start, end, cluster_doc, kept): the stretches of words, ``span`` or more, that occur at another place as well.

    Words are compared with A-Z lower-cased; white space, line breaks too, only parts them. A stretch is as long as all its
    windows of ``span`` words occur first in ``cluster_doc``, by id and place; those first occurrences are themselves listed
    and kept. Start and end are code points, end exclusive. Rows with equal id and text are one document; a null id ranks
    after all others, and texts are told apart there. A null text is empty; an empty table gives an empty result.
    """
    texts = pieces.texts(docs, id_col, text_col)
    found = scratch.keep(pieces.scan(texts, None, 1, 0, 0, span, gram), "passage-anchors")
    wanted = marked(found)
    members = scratch.keep(pieces.look_up(texts, None, wanted, 1, span), "passage-members")
    out = compared(members)
    scratch.drop(found, wanted, members)
    return out
