"""Character TF-IDF a document at a time: no row for each term of each document is shuffled.

Terms are those of :func:`tfidf.char_terms`. The words are cut by Spark; a word's n-grams are made once for many documents.
Documents whose ids repeat are put together first, as a term's count is by id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.operators import tfidf
from quarrystone.session import written

#: Words remembered by a task, documents that are worked on together, and tasks over a training sample.
WORDS, DOCUMENTS, TASKS = 200_000, 128, 12


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), " "), lambda w: w != "")


def by_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, words): one row per id; texts are shuffled only if an id repeats."""
    words = words_of(F.col(text_col)).alias("words")
    if docs.groupBy(id_col).count().where("count > 1").isEmpty():
        return docs.where(F.col(text_col).isNotNull()).select(id_col, words)
    return docs.where(F.col(text_col).isNotNull()).groupBy(id_col).agg(F.flatten(F.collect_list(words)).alias("words"))


def _grams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for n in (3, 4, 5) for i in range(len(padded) - n + 1)]


def _tallied(batch: pa.RecordBatch, known: dict[str, np.ndarray], ids_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:  # noqa: ANN001
    """(document, term, count) of a batch, in order; ``ids_of`` numbers a word's n-grams."""
    words = batch.column("words")
    lengths = np.diff(words.offsets.to_numpy())
    coded = words.flatten().dictionary_encode()
    if len(known) > WORDS:
        known.clear()
    each = []
    for w in coded.dictionary.to_pylist():
        if (got := known.get(w)) is None:
            got = known[w] = ids_of(w)
        each.append(got)
    if not each:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    pairs, times = np.unique(np.repeat(np.arange(len(lengths)), lengths) * len(each) + coded.indices.to_numpy(), return_counts=True)
    document, word = pairs // len(each), pairs % len(each)
    sizes = np.array([len(x) for x in each])
    starts, flat = np.cumsum(sizes) - sizes, np.concatenate(each)
    n = sizes[word]
    at = np.repeat(starts[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    key, count = np.repeat(document, n) << 40 | flat[at], np.repeat(times, n)
    if not len(key):
        return key, key, count
    if count.max() < 1 << 12 and flat.max() < 1 << 40 - 12:  # the count in the key's low bits: one plain sort
        packed = np.sort((key & -1 << 40) | (key & (1 << 28) - 1) << 12 | count)
        count, term = packed & (1 << 12) - 1, packed >> 12
        first = np.flatnonzero(np.diff(term, prepend=-1))
        return term[first] >> 28, term[first] & (1 << 28) - 1, np.add.reduceat(count, first)
    distinct, place = np.unique(key, return_inverse=True)
    return distinct >> 40, distinct & (1 << 40) - 1, np.bincount(place, count).astype(np.int64)


def _small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, len(batch), DOCUMENTS):
            yield batch.slice(i, DOCUMENTS)


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers: dict[str, int] = {}
    known: dict[str, np.ndarray] = {}
    df = total = np.zeros(0, np.int64)
    for batch in _small(batches):
        _, term, count = _tallied(batch, known, lambda w: np.array([numbers.setdefault(g, len(numbers)) for g in _grams(w)], np.int64))
        n = len(numbers)
        df = np.bincount(term, minlength=n) + np.pad(df, (0, n - len(df)))
        total = np.bincount(term, count, n).astype(np.int64) + np.pad(total, (0, n - len(total)))
    if numbers:
        yield pa.RecordBatch.from_arrays([pa.array(list(numbers)), pa.array(df), pa.array(total)], names=["term", "df", "total"])


def vocabulary(docs: DataFrame, sample: int = tfidf.SAMPLE, features: int = tfidf.CHAR_FEATURES, id_col: str = "report_id", text_col: str = "text") -> DataFrame:
    """As :func:`tfidf.vocabulary` over the training sample: tasks send sums by term."""
    taken = written(tfidf.training_sample(docs, sample, id_col))
    sums = by_id(taken, id_col, text_col).repartition(TASKS).mapInArrow(_sums, "term string, df long, total long")
    return tfidf.selected(sums.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")), taken.count(), features)


def weights(docs: DataFrame, vocab: DataFrame, id_col: str = "report_id", text_col: str = "text", digits: int | None = None) -> DataFrame:
    """As :func:`tfidf.weights`, rounded to ``digits`` if given. The vocabulary's size is bounded, so tasks get it whole."""
    rows = vocab.select("term", "idf").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast((rows["term"].to_pylist(), rows["idf"].to_numpy()))
    kind = docs.schema[id_col].dataType.simpleString()

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        number = {t: i for i, t in enumerate(terms)}
        texts, known = pa.array(terms, pa.string()), {}
        for batch in _small(batches):
            document, term, count = _tallied(batch, known, lambda w: np.array([number[g] for g in _grams(w) if g in number], np.int64))
            if not len(term):
                continue
            raw = (np.log(count) + 1.0) * idf[term]
            weight = raw / np.sqrt(np.bincount(document, raw * raw))[document]
            if digits is not None:
                weight = np.floor(weight * 10.0**digits + 0.5) / 10.0**digits
            yield pa.RecordBatch.from_arrays([batch.column(id_col).take(pa.array(document)), texts.take(pa.array(term)), pa.array(weight)], names=[id_col, "term", "weight"])

    return by_id(docs, id_col, text_col).mapInArrow(made, f"{id_col} {kind}, term string, weight double")
