"""Line dedup over levelled sorted runs of line digests.

Documents are taken in batches of ascending id. A batch's line digests are reduced to one owner each (the smallest document
that holds the line), anti-joined with the runs that earlier batches left, and what is new becomes a run of level 0. When a
level holds ``FANOUT`` runs they are merged into one of the next level, so a batch meets only a logarithmic number of runs.

A run is a bucketed table sorted by digest: a merge join reads it without an exchange or a sort, so adding a batch shuffles
the batch alone. A line that a third of all documents hold is counted map-side while owners are found, and the one join of
all digests with their owners is between written tables, where adaptive execution splits a hot digest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import scratch

MIN_CHARS, BATCHES, FANOUT = 10, 4, 2


def digests(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """For each line its key's 128-bit digest, or None where the key has fewer than ``min_chars`` code points.

    The key is the line stripped of ASCII white space at both ends, A-Z lower-cased.
    """
    found: list[bytes | None] = []
    for line in (text or "").encode().split(b"\n"):
        key = line.strip().lower()
        enough = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        found.append(xxhash.xxh3_128_digest(key) if enough else None)
    return found


class LineRuns:
    """The levelled runs: tables of (digest, owner), each digest in one run only."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout, self.levels = spark, fanout, [[]]
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> str:
        name = f"quarrystone_run_{uuid.uuid4().hex}"
        rows.repartition(self.buckets, "digest").write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(name)
        return name

    def absorb(self, batch: DataFrame) -> None:
        """Adds the owners of a batch's digests that no run holds; batches must come in ascending order of ids."""
        fresh = batch.groupBy("digest").agg(F.min("id").alias("owner"))
        for name in (name for level in self.levels for name in level):
            fresh = fresh.join(self.spark.table(name).select("digest").hint("merge"), "digest", "left_anti")
        self.levels[0].append(self._write(fresh))
        for level, names in enumerate(self.levels):
            if len(names) >= self.fanout:
                merged = self._write(reduce(DataFrame.unionByName, map(self.spark.table, names)))
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(merged)
                self._forget(level)

    def _forget(self, level: int) -> None:
        for name in self.levels[level]:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels[level] = []

    def owners(self) -> DataFrame:
        """(digest, owner) of every digest seen."""
        return reduce(DataFrame.unionByName, [self.spark.table(name) for level in self.levels for name in level])

    def close(self) -> None:
        for level in range(len(self.levels)):
            self._forget(level)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(id, gone array of digests): the lines that each document loses; documents that lose none are absent."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, found = [], []
            for row, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                own = {x for x in digests(text.as_py(), min_chars) if x}
                ids += [row] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, part.column(0).type), pa.array(found, pa.binary())], ["id", "digest"])

    keys = scratch.keep(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, digest binary"), "line-keys")
    cuts = keys.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 1000)).first()[0] if batches > 1 else []
    cuts = sorted(set(cuts or []))
    runs = LineRuns(spark, fanout)
    try:
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            inside = F.lit(True) if low is None else (F.col("id") > low) if high is not None else (F.col("id") > low) | F.col("id").isNull()
            runs.absorb(keys.where(inside if high is None else inside & (F.col("id") <= high)))
        owners = scratch.keep(runs.owners(), "line-owners")  # a plain table: buckets would keep a hot digest from being split
        held = keys.join(owners, "digest")
        gone = held.where(F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))).groupBy("id").agg(F.collect_set("digest").alias("gone"))
        kept = scratch.keep(gone, "line-drops")
    finally:
        runs.close()
    scratch.drop(keys, owners)
    return kept


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with every line that an earlier document holds removed, and columns ``n_lines`` and ``n_dropped``.

    A line is known by its key (see :func:`digests`). Keys of ``min_chars`` code points or more that at least two documents
    hold keep their lines in the smallest id alone, repeats there included; all other lines stay, in order, joined by a
    newline. A null text counts as one empty line and becomes ''. Rows that repeat an id are one document. A null id ranks
    after all others. All other columns stay; where one is called ``n_lines`` or ``n_dropped`` it is replaced. An empty
    table gives an empty result.
    """

    @F.arrow_udf("text string, n_lines long, n_dropped long")
    def rebuild(text: pa.Array, gone: pa.Array) -> pa.Array:
        kept, lines, lost = [], [], []
        for one, drops in zip(text, gone, strict=True):
            whole = one.as_py() or ""
            parts = whole.split("\n")
            if drops.is_valid:
                out = set(drops.as_py())
                stay = [x for x, d in zip(parts, digests(whole, min_chars), strict=True) if d not in out]
            else:
                stay = parts
            kept.append(whole if stay is parts else "\n".join(stay))
            lines.append(len(parts))
            lost.append(len(parts) - len(stay))
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(lost, pa.int64())], ["text", "n_lines", "n_dropped"])

    drops = dropped_lines(docs, id_col, text_col, min_chars, batches, fanout)
    joined = docs.join(drops, docs[id_col].eqNullSafe(drops["id"]), "left")
    made = joined.select(*(docs[c] for c in docs.columns if c not in {text_col, "n_lines", "n_dropped"}), rebuild(docs[text_col].cast("string"), drops["gone"]).alias("__made"))
    order = [c for c in docs.columns if c not in {"n_lines", "n_dropped"}]
    return made.select(*(F.col("__made.text").alias(c) if c == text_col else F.col(c) for c in order), "__made.n_lines", "__made.n_dropped")


def deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """Pipeline form: the columns of ``docs`` with the shortened text, and ``n_chars``, where present, counted again."""
    made = dedup_lines(docs, id_col, text_col, **how)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return made.select(docs.columns)
