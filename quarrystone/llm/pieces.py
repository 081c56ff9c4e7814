"""What :mod:`paragraphs` and :mod:`passages` read from texts: one scan for both, and one look-up of what the scan makes wanted.

The scan goes through every text once, in arrays, and returns a row for each line of enough words (its key and MinHash bands) and
a row for each run of windows that share an anchor. The look-up joins the texts with lists of the wanted lines and runs, which
are lists of one document, and returns the shingles of the lines and the hashes of the windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shingles mixed with all permutations at a time, bytes of text after which rows are handed on, and keys a task remembers.
SLICE, TOGETHER, KNOWN = 1 << 14, 1 << 21, 200_000
_BASE = 0x9E3779B97F4A7C15
_WHITE = np.zeros(256, bool)
_WHITE[list(b" \t\n\r\x0b\x0c")] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of runs laid end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingles(w: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` word hashes, in order."""
    h = np.zeros(max(0, len(w) - width + 1), np.uint64)
    for j in range(width):
        h = (h ^ w[j : j + len(h)]) * np.uint64(_BASE)
        h ^= h >> np.uint64(29)
    return h


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(64)
    return rng.integers(0, 2**32, (1, count), dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, (1, count), dtype=np.uint32)


def band_keys(hashes: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit bucket keys, a row for each set; the sets' hashes are given end to end."""
    times, plus = _permutations(bands * rows)
    small = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full((len(sizes), bands * rows), np.iinfo(np.uint32).max, np.uint32)
    owner, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
    for at in range(0, len(small), SLICE):
        mixed = small[at : at + SLICE, None] * times + plus
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(13)
        some = owner[at : at + SLICE]
        first, last = some[0], some[-1]
        cuts = np.maximum(ends[first : last + 1] - sizes[first : last + 1] - at, 0)
        least[first : last + 1] = np.minimum(least[first : last + 1], np.minimum.reduceat(mixed, cuts, axis=0))
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95), (len(sizes), bands))
    for row in range(rows):
        key = (key ^ least[:, row::rows][:, :bands].astype(np.uint64)) * np.uint64(_BASE)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _powers(count: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < count:
        size = max(count, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
    return _POWERS


def prefixes(w: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any stretch of words follows."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * _powers(len(w))[0][: len(w)], dtype=np.uint64)])


def windows(sums: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash for each stretch of ``width`` words."""
    count = len(sums) - width
    x = (sums[width:] - sums[:-width]) * _powers(count)[1][:count]
    for shift, times in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(times)
    return x ^ (x >> np.uint64(32))


def anchors(sums: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows, place of the first window before the anchor's end) of each anchor's run."""
    g, wide = windows(sums, gram), span - gram + 1
    best = np.lib.stride_tricks.sliding_window_view(g, wide).argmin(axis=1) + np.arange(len(g) - wide + 1)
    first = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1])
    return g[best[first]].view(np.int64), first, np.diff(np.append(first, len(best))), wide - 1 - (best[first] - first)


class Layout:
    """Where the words of a text stand: start and end in code points, and line."""

    def __init__(self, raw: bytes) -> None:
        data = np.frombuffer(raw, np.uint8)
        white = np.concatenate([[True], _WHITE[data], [True]])
        first, last = np.flatnonzero(white[:-1] & ~white[1:]), np.flatnonzero(~white[:-1] & white[1:])
        breaks = np.flatnonzero(data == 10)
        self.line = np.searchsorted(breaks, first)
        if raw.isascii():
            self.start, self.end, self.breaks, self.size = first, last, breaks, len(raw)
        else:
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            self.start, self.end, self.breaks, self.size = chars[first], chars[last], chars[breaks], int(chars[-1])

    def lines(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, number of words) of each line of at least ``least`` words."""
        if not len(self.line):
            return self.line, self.line
        first = np.concatenate([[0], np.flatnonzero(np.diff(self.line)) + 1])
        size = np.diff(np.append(first, len(self.line)))
        return first[size >= least], size[size >= least]

    def ends(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of lines, without the line break."""
        borders = np.concatenate([[-1], self.breaks, [self.size]])
        return borders[numbers] + 1, borders[numbers + 1]


def key_of(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, t, text): the text's hash tells apart rows whose ids are null or the same."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("t"), text.alias("text")).where("text IS NOT NULL")


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, in pieces of about ``TOGETHER`` bytes of text."""
    size = np.diff(np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset :][: batch.num_rows + 1]).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // TOGETHER)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(low, high - low)


def scan(found: DataFrame, least: int | None, width: int, bands: int, rows: int, span: int | None, gram: int) -> DataFrame:
    """Of ``texts``: (doc, t, line, start, end, key, buckets) for each line of ``least`` words or more, buckets being null where the
    task has returned them before; (doc, t, anchor, at, n, first) for each run of windows of ``span`` words. None leaves a kind out."""
    kind = found.schema["doc"].dataType.simpleString()
    line_names, run_names = ("line", "start", "end", "key", "buckets"), ("anchor", "at", "n", "first")
    names = ["doc", "t", *line_names, *run_names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for batch in batches:
            for part in _groups(batch, 2):
                line_of, keys, spots, fresh, hashes, sizes = [], [], [], [], [], []
                run_of, found_runs = [], []
                for i, text in enumerate(part.column(2)):
                    raw = text.as_py().encode()
                    words = raw.lower().split()
                    if len(words) < min(least or len(words) + 1, span or len(words) + 1):
                        continue
                    w = word_hashes(words)
                    if least:
                        layout = Layout(raw)
                        first, size = layout.lines(least)
                        if len(first):
                            numbers = layout.line[first]
                            spots.append((numbers, *layout.ends(numbers)))
                            line_of.append(np.full(len(first), i))
                            grams = shingles(w, width)
                            for a, n in zip(first.tolist(), size.tolist(), strict=True):
                                keys.append(key_of(words[a : a + n]))
                                fresh.append(keys[-1] not in known)
                                if fresh[-1]:
                                    known.add(keys[-1])
                                    hashes.append(grams[a : a + n - width + 1])
                                    sizes.append(n - width + 1)
                    if span and len(words) >= span:
                        found_runs.append(anchors(prefixes(w), span, gram))
                        run_of.append(np.full(len(found_runs[-1][0]), i))
                if keys:
                    of, fresh = pa.array(np.concatenate(line_of)), np.array(fresh)
                    made = band_keys(np.concatenate(hashes), np.array(sizes), bands, rows) if hashes else np.zeros((0, bands), np.int64)
                    ends = np.concatenate([[0], np.cumsum(fresh * bands)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()), mask=pa.array(~fresh))
                    line, start, end = (pa.array(np.concatenate(x).astype(np.int32)) for x in zip(*spots, strict=True))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(of), part.column(1).take(of), line, start, end, pa.array(keys, pa.binary()), lists, pa.nulls(len(of), pa.int64()), *(pa.nulls(len(of), pa.int32()) for _ in run_names[1:])], names)
                if found_runs:
                    of = pa.array(np.concatenate(run_of))
                    anchor, at, n, first = (np.concatenate(x) for x in zip(*found_runs, strict=True))
                    nothing = [*(pa.nulls(len(of), pa.int32()) for _ in range(3)), pa.nulls(len(of), pa.binary()), pa.nulls(len(of), pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(of), part.column(1).take(of), *nothing, pa.array(anchor), *(pa.array(x.astype(np.int32)) for x in (at, n, first))], names)
                if len(known) > KNOWN:
                    known.clear()

    return found.mapInArrow(run, f"doc {kind}, t long, line int, start int, end int, key binary, buckets array<long>, anchor long, at int, n int, first int")


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values of so many bytes each, laid end to end in ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.py_buffer(data.tobytes())])


def flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The contents of binary values end to end, and the place of each in it."""
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[edges[0] : edges[-1]] if len(column) and edges[-1] > edges[0] else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind), (edges - edges[0]) // np.dtype(kind).itemsize


def look_up(found: DataFrame, lines: DataFrame | None, marked: DataFrame | None, width: int, span: int) -> DataFrame:
    """Of ``texts``: (node, grams) of the wanted ``lines`` (doc, t, line, key, node), the grams sorted and distinct, and (anchor, doc,
    t, at, first, lead, hashes, starts, ends) of the wanted runs ``marked`` (doc, t, anchor, at, n, first, lead).

    Rows that repeat a document repeat its lines and runs. A line whose key is not the wanted one is left out.
    """
    kind = found.schema["doc"].dataType.simpleString()
    line_kind, run_kind = "array<struct<line:int,key:binary,node:bigint>>", "array<struct<anchor:bigint,at:int,n:int,first:int,lead:boolean>>"
    parts = []
    if lines is not None:
        parts.append(lines.groupBy("doc", "t").agg(F.collect_list(F.struct("line", "key", "node")).alias("lines")).withColumn("runs", F.lit(None).cast(run_kind)))
    if marked is not None:
        parts.append(marked.groupBy("doc", "t").agg(F.collect_list(F.struct("anchor", "at", "n", "first", "lead")).alias("runs")).withColumn("lines", F.lit(None).cast(line_kind)))
    lists = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).groupBy("doc", "t").agg(F.first("lines", True).alias("lines"), F.first("runs", True).alias("runs"))
    lists = lists.select(F.col("doc").alias("own"), F.col("t").alias("own_t"), "lines", "runs")
    both = found.join(lists, F.col("doc").eqNullSafe(F.col("own")) & (F.col("t") == F.col("own_t"))).select("doc", "t", "text", "lines", "runs")
    names = ["node", "grams", "anchor", "doc", "t", "at", "first", "lead", "hashes", "starts", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups(batch, 2):
                nodes, grams, of, windowed = [], [], [], []
                for i, (text, wanted, some) in enumerate(zip(part.column(2), part.column(3), part.column(4), strict=True)):
                    raw = text.as_py().encode()
                    words = raw.lower().split()
                    w, layout = word_hashes(words), Layout(raw)
                    if wanted.is_valid:
                        place = {x["line"]: x for x in wanted.as_py()}
                        first, size = layout.lines(1)
                        every = shingles(w, width)
                        for number, a, n in zip(layout.line[first].tolist(), first.tolist(), size.tolist(), strict=True):
                            if number in place and key_of(words[a : a + n]) == place[number]["key"]:
                                nodes.append(place[number]["node"])
                                grams.append(np.unique(every[a : a + n - width + 1]))
                    if some.is_valid:
                        own = some.values
                        at, n = (own.field(k).to_numpy().astype(np.int64) for k in ("at", "n"))
                        where = runs(at, n)
                        windowed.append((own.field("anchor"), own.field("at"), own.field("first"), own.field("lead"), n, windows(prefixes(w), span)[where], layout.start[where].astype(np.int32), layout.end[where + span - 1].astype(np.int32)))
                        of.append(np.full(len(at), i))
                if nodes:
                    size = len(nodes)
                    nothing = [pa.nulls(size, pa.int64()), pa.nulls(size, part.column(0).type), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.bool_()), *(pa.nulls(size, pa.binary()) for _ in range(3))]
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([g.tobytes() for g in grams], pa.binary()), *nothing], names)
                if of:
                    took = pa.array(np.concatenate(of))
                    anchor, at, first, lead = (pa.concat_arrays([x[k] for x in windowed]) for k in range(4))
                    n, hashes, starts, ends = (np.concatenate([x[k] for x in windowed]) for k in range(4, 8))
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(took), pa.int64()), pa.nulls(len(took), pa.binary()), anchor, part.column(0).take(took), part.column(1).take(took), at, first, lead, _binaries(hashes, 8 * n), _binaries(starts, 4 * n), _binaries(ends, 4 * n)], names)

    return both.mapInArrow(run, f"node long, grams binary, anchor long, doc {kind}, t long, at int, first int, lead boolean, hashes binary, starts binary, ends binary")
