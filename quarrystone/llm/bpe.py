"""Byte-level BPE by replaying merges over a corpus of words.

The distinct words of a stretch of documents are laid out as one array of tokens with links to both neighbours. An inverted
index lists, for each pair of neighbouring tokens, the positions where it stands; merges are applied in rank order over all
words at once, and only the two neighbours of a merged pair are looked up again. A word's tokens are remembered, so a word is
replayed once while it stays in a worker's bounded memory. Documents never leave their partition: nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of text that make a stretch, words of a longer text taken at once, and words remembered after a stretch.
TOGETHER, SLICE, REMEMBERED = 1 << 21, 200_000, 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of runs laid end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Replay:
    """Encodes and decodes words by one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.width = ranks, max(ranks.values()) + 1
        self.find = regex.compile(pattern)
        tokens = sorted(ranks, key=ranks.__getitem__)
        size = np.zeros(self.width, np.int64)
        size[[ranks[t] for t in tokens]] = [len(t) for t in tokens]
        self.size, self.start, self.raw = size, np.cumsum(size) - size, np.frombuffer(b"".join(tokens), np.uint8)
        #: Pairs of tokens that join, as first times ``width`` plus second, in order, and the token that each makes.
        joined = {a * self.width + b: r for t, r in ranks.items() for i in range(1, len(t)) if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None}
        self.pairs = np.fromiter(sorted(joined), np.int64, len(joined))
        self.made = np.fromiter(map(joined.__getitem__, self.pairs.tolist()), np.int64, len(joined))
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        #: Tokens that may join a neighbour at a rank before their own: after such a merge its word must go back in the order.
        first, second = self.pairs // self.width, self.pairs % self.width
        self.early = set(first[self.made < first].tolist()) | set(second[self.made < second].tolist())
        self.forget()

    def _places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of pairs of tokens in ``pairs``, -1 where they do not join."""
        if not len(self.pairs):
            return np.full(len(a), -1)
        keys = a * self.width + b
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, at, -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of some non-empty words end to end, their number by word); a word that is a token itself stays whole.

        Words do not touch each other, so all that hold a pair can merge it when its rank comes up. Within a word the
        leftmost of overlapping pairs goes first.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size)
        token = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, len(token) + 1, dtype=np.int32), np.arange(-1, len(token) - 1, dtype=np.int32)
        after[ends - 1], before[ends - size] = -1, -1
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        pair = np.full(len(token), -1, np.int32)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[tuple[int, int]] = []
        rank_of, fresh = np.append(self.made, -1), np.zeros(len(token), bool)

        def enter(where: np.ndarray) -> None:
            """Lists positions under the pairs that stand there."""
            kind = pair[where]
            where, kind = where[kind >= 0], kind[kind >= 0]
            if not len(where):
                return
            order = np.argsort(kind, kind="stable")
            where, kind = where[order], kind[order]
            cuts = np.flatnonzero(kind[1:] != kind[:-1]) + 1
            edges = [0, *cuts.tolist(), len(kind)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                p = int(kind[low])
                if p not in index:
                    index[p] = []
                    heapq.heappush(queue, (int(self.made[p]), p))
                index[p].append(where[low:high])

        inner = np.flatnonzero(after >= 0)
        pair[inner] = self._places(token[inner], token[inner + 1])
        enter(inner.astype(np.int32))
        while queue:
            rank = queue[0][0]
            lists: list[np.ndarray] = []
            while queue and queue[0][0] == rank:  # several pairs may make one token: they are of one rank
                lists += index.pop(heapq.heappop(queue)[1])
            agenda = np.concatenate(lists)
            agenda = agenda[rank_of[pair[agenda]] == rank]  # the others have changed since
            if not len(agenda):
                continue
            agenda.sort()
            if len(lists) > 1:
                agenda = agenda[np.append(True, agenda[1:] != agenda[:-1])]
            if rank in self.early:
                go = np.append(True, word[agenda[1:]] != word[agenda[:-1]])
            else:  # every second one where pairs overlap in a row
                overlaps = np.append(False, after[agenda[:-1]] == agenda[1:])
                place = np.arange(len(agenda))
                go = (place - np.maximum.accumulate(np.where(overlaps, 0, place))) % 2 == 0
            i = agenda[go]
            j = after[i]
            k, h = after[j], before[i]
            token[i], token[j], after[i] = rank, -1, k
            pair[i], pair[j] = -1, -1
            right, left = k >= 0, h >= 0
            before[k[right]] = i[right]
            touched = np.concatenate([i[right], before[i][left]])
            touched.sort()
            touched = touched[np.append(True, touched[1:] != touched[:-1])[: len(touched)]]
            pair[touched] = self._places(token[touched], token[after[touched]])
            enter(touched)
            if rank in self.early:
                fresh[touched] = True
                rest = agenda[~go]
                enter(rest[~fresh[rest]])
                fresh[touched] = False
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        token[whole[word] >= 0] = -1
        alone = np.flatnonzero(whole >= 0)
        token[ends[alone] - size[alone]] = whole[alone]
        live = token >= 0
        return token[live].astype(np.int32), np.bincount(word[live], minlength=len(words))

    def forget(self) -> None:
        """Empties the memory of words: their numbers, and where the ids of each lie."""
        self.known: defaultdict[str, int] = defaultdict(count().__next__)
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, pieces), np.int32, len(pieces))

    def _taken(self, held: list[np.ndarray]) -> Iterator[np.ndarray]:
        """The ids of some texts given as numbers of words, once the words that are new among them have been replayed."""
        new = [w.encode() for w in islice(self.known, len(self.starts), None)]
        if new:
            ids, sizes = self.replay(new)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        for numbers in held:
            yield self.ids[_runs(self.starts[numbers], self.sizes[numbers])]
        if len(self.known) > REMEMBERED:
            self.forget()

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; the words of neighbouring texts, up to ``TOGETHER`` characters, are replayed together."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > TOGETHER:
                yield from self._taken(held)
                held, size = [], 0
            if len(text) > TOGETHER:
                words, parts = (m.group() for m in self.find.finditer(text)), []
                while pieces := list(islice(words, SLICE)):
                    parts += self._taken([self._numbers(pieces)])
                yield np.concatenate(parts)
            else:
                held.append(self._numbers(self.find.findall(text)))
                size += len(text)
        yield from self._taken(held)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        out = []
        for at in range(0, len(ids), SLICE):
            part = ids[at : at + SLICE]
            out.append(self.raw[_runs(self.start[part], self.size[part])].tobytes())
        return b"".join(out)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in pieces of about ``TOGETHER`` bytes of a column."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(size) // TOGETHER
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        if high > low:
            yield batch.slice(low, high - low)


_BUILT: dict[str, Replay] = {}


def _built(key: str, ranks, pattern: str) -> Replay:  # noqa: ANN001
    """The vocabulary's tables, made once a worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Replay(ranks.value, pattern)
    return _BUILT[key]


class Tokenizer:
    """A vocabulary file's encoder and decoder for columns; the file is read on the driver and its ranks are broadcast."""

    def __init__(self, spark: SparkSession, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        self._sent, self._key, self._pattern = spark.sparkContext.broadcast(ranks), hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest(), pattern

    def _mapped(self, docs: DataFrame, source: Column, names: dict[str, T.DataType], make) -> DataFrame:  # noqa: ANN001
        """``docs`` with the columns ``names`` that ``make`` gives for slices of ``source``; columns so called are replaced."""
        key, sent, pattern = self._key, self._sent, self._pattern
        own = {n.lower(): n for n in names}
        kept = [c for c in docs.columns if c.lower() not in own]
        places = [f"c{i}" for i in range(len(kept))]
        read = docs.select(*(F.col(f"`{c}`").alias(p) for c, p in zip(kept, places, strict=True)), source.alias("source"))
        schema = T.StructType([*read.schema.fields[:-1], *(T.StructField(f"n{i}", kind) for i, kind in enumerate(names.values()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            built = _built(key, sent, pattern)
            for batch in batches:
                for part in _slices(batch, len(places)):
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(places)], *make(built, part.column(len(places)))], schema.names)
            built.forget()  # the worker may go on to other stages

        order = [own.get(c.lower(), c) for c in docs.columns]
        made = read.mapInArrow(run, schema).toDF(*kept, *names)
        return made.select(*(F.col(f"`{c}`") for c in [*order, *(n for n in names if n not in order)]))

    def encode(self, docs: DataFrame, text_col: str = "text", name: str = "ids", decoded: str | None = None) -> DataFrame:
        """``docs`` with the token ids of each whole text in the array column ``name`` (replaced if it exists).

        Each match of the pattern is encoded by itself and special tokens are plain text. With ``decoded`` given, a column of
        that name holds the bytes that the decoder makes of these ids. A null or empty text has no ids; rows may repeat; an
        empty table stays empty.
        """

        def make(own: Replay, text: pa.Array) -> Iterator[pa.Array]:
            found = list(own.encode(["" if x is None else x for x in text.to_pylist()]))
            yield _lists(found)
            if decoded:
                yield pa.array([own.decode(x) for x in found], pa.binary())

        kinds = {name: T.ArrayType(T.IntegerType())} | ({decoded: T.BinaryType()} if decoded else {})
        return self._mapped(docs, F.col(text_col).cast("string"), kinds, make)

    def decode(self, docs: DataFrame, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
        """``docs`` with the bytes that the ids stand for in ``name`` (replaced if it exists); null ids give none."""
        key, sent, pattern = self._key, self._sent, self._pattern

        @F.arrow_udf("binary")
        def decode(ids: pa.Array) -> pa.Array:
            own = _built(key, sent, pattern)
            return pa.array([own.decode(x.values.to_numpy()) if x.is_valid and len(x.values) else b"" for x in ids], pa.binary())

        return docs.withColumn(name, decode(F.col(ids_col)))


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*found, np.zeros(0, np.int32)]), pa.int32()))
