"""Toxicity: logistic regression over character n-grams scaled by naive Bayes log-count ratios.

Byte n-grams of the lower-cased text are hashed to ``BUCKETS`` features and counted once a document. Over a bounded sample of
labelled rows the features' document counts by class give log-count ratios; the ``FEATURES`` that tell the classes apart best
(by the likelihood-ratio statistic) are kept; a ridge-penalised logistic regression is fitted to the ratios of those a
document holds, as in "Baselines and Bigrams" (Wang and Manning, 2012), and set so that its threshold suits unseen rows. Scoring is one pass without a shuffle: the only thing
sent to the executors is a table of ``BUCKETS`` weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import scratch

BITS, SIZES = 21, (4, 5, 6, 7)
BUCKETS = 1 << BITS
#: Bounds of the fit: labelled rows taken (smallest hashes of the id first) and features kept.
FIT_ROWS, FEATURES = 12_000, 2_048
THRESHOLD, SMOOTHING, RIDGE, STEPS, FOLDS, RARE, CHUNK = 0.7, 1.0, 1.0, 300, 3, 4, 1 << 20
SPACES = bytes(32 if i < 32 else i for i in range(256))


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Feature numbers of a text's n-grams, with repeats, in pieces of bounded size."""
    raw = (" " + (text or "").lower() + " ").encode().translate(SPACES)
    longest = SIZES[-1]
    for at in range(0, len(raw), CHUNK):
        b = np.frombuffer(raw[at : at + CHUNK + longest - 1], np.uint8).astype(np.uint32)
        h = b
        for n in range(2, longest + 1):
            if len(b) < n:
                break
            h = h[:-1] * np.uint32(0x01000193) + b[n - 1 :]
            if n in SIZES:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
                yield mixed >> np.uint32(32 - BITS)


def distinct(text: str | None) -> np.ndarray:
    """A text's features, each once."""
    return np.unique(np.concatenate([np.zeros(0, np.uint32), *grams(text)]))


@dataclass(frozen=True)
class Model:
    """Weights by feature (zero for those not kept) and the intercept."""

    weights: np.ndarray
    intercept: float

    def margin(self, text: str | None) -> float:
        hit = [g[self.weights[g] != 0] for g in grams(text)]
        held = np.unique(np.concatenate(hit)) if hit else np.zeros(0, np.uint32)
        return self.intercept + float(self.weights[held].sum(dtype=np.float64))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(text), -35, 35))))


def logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, width: int, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the summed log loss plus ``ridge / 2`` times the squared weights.

    ``rows, cols, values`` are the non-zero entries, sorted by row. Accelerated gradient steps with restarts.
    """
    n = len(y)

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(rows, values * w[cols], n)

    def back(g: np.ndarray) -> np.ndarray:
        return np.bincount(cols, values * g[rows], width)

    v = np.random.default_rng(0).normal(size=width)
    for _ in range(12):
        v = back(times(v / max(np.linalg.norm(v), 1e-12)))
    rate = 1 / (0.25 * 1.1 * (np.linalg.norm(v) + n) + ridge)
    w, b = np.zeros(width), 0.0
    pw, pb, t, last = w, b, 1.0, np.inf
    for _ in range(steps):
        m = times(pw) + pb
        p = 1 / (1 + np.exp(-np.clip(m, -35, 35)))
        loss = np.logaddexp(0, m).sum() - (y * m).sum() + ridge / 2 * (pw @ pw)
        nw, nb = pw - rate * (back(p - y) + ridge * pw), pb - rate * (p - y).sum()
        if loss > last:
            t = 1.0
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        pw, pb = nw + (t - 1) / s * (nw - w), nb + (t - 1) / s * (nb - b)
        w, b, t, last = nw, nb, s, loss
    return w, b


def _ratios(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Log ratios of the features' smoothed shares among positive and other rows."""
    n1, n0 = np.bincount(cols, y[rows], width), np.bincount(cols, 1 - y[rows], width)
    return np.log((n1 + SMOOTHING) / (y.sum() + 2 * SMOOTHING)) - np.log((n0 + SMOOTHING) / ((1 - y).sum() + 2 * SMOOTHING))


def learn(held: list[np.ndarray], y: np.ndarray, width: int, threshold: float = THRESHOLD) -> tuple[np.ndarray, float]:
    """Weights of ``width`` features and the intercept, from the features that each row holds.

    The intercept is then moved so that ``threshold`` falls where the F1 measure of margins of rows that a model has not
    seen, taken over ``FOLDS`` folds, is largest.
    """

    def fitted(some: np.ndarray) -> tuple[np.ndarray, float]:
        at, cols = np.repeat(np.arange(len(some)), [len(held[i]) for i in some]), np.concatenate([held[i] for i in some])
        ratio = _ratios(at, cols, y[some], width)
        w, b = logistic(at, cols, ratio[cols], y[some], width)
        return w * ratio, b

    w, b = fitted(np.arange(len(y)))
    fold = np.arange(len(y)) % FOLDS
    if min(y.sum(), (1 - y).sum()) < 5 * FOLDS or any(len(set(y[fold != k])) < 2 for k in range(FOLDS)):
        return w, b
    unseen = np.zeros(len(y))
    for k in range(FOLDS):
        fw, fb = fitted(np.flatnonzero(fold != k))
        for i in np.flatnonzero(fold == k):
            unseen[i] = fb + fw[held[i]].sum()
    order = np.argsort(-unseen, kind="stable")
    hits, ranked = np.cumsum(y[order]), unseen[order]
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][ranked[:-1] == ranked[1:]] = 0  # no cut between equal margins
    best = int(f1.argmax())
    cut = ranked[best] if best + 1 == len(y) else (ranked[best] + ranked[best + 1]) / 2
    return w, b + float(np.log(threshold / (1 - threshold)) - cut)


def training_rows(labels: DataFrame, label_col: str, id_col: str = "doc_id", rows: int = FIT_ROWS) -> DataFrame:
    """(id, y): at most ``rows`` labelled ids that may be learnt from, those with the smallest hashes.

    Left out are ids whose crc32 as text leaves 1 when divided by 3, and rows without an id or a label. An id with several
    labels counts as positive if one of them is.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    one = usable.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("y"))
    return one.orderBy(F.xxhash64("id"), "id").limit(rows)


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS, features: int = FEATURES) -> Model:
    """A model learnt from the texts of at most ``rows`` labelled documents.

    Without rows of both classes the model is a constant, the smoothed share of positive ones.
    """
    ids = F.broadcast(training_rows(labels, label_col, id_col, rows))  # bounded by ``rows``
    sample = scratch.keep(docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).join(ids, F.col("__id") == ids["id"]).select("id", "y", "text"), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros((2, BUCKETS), np.int32), np.zeros(2, np.int64)
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts[y][distinct(text.as_py())] += 1
                size[y] += 1
        held = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(counts[0][held], size[0])), pa.array(np.append(counts[1][held], size[1]))], ["feature", "n0", "n1"])

    counted = scratch.keep(sample.select("y", "text").mapInArrow(count, "feature long, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "gram-counts")
    size = counted.where("feature = -1").first()
    size0, size1 = (size.n0, size.n1) if size else (0, 0)
    if not size0 or not size1:
        p = (size1 + 1) / (size0 + size1 + 2)
        scratch.drop(sample, counted)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(p / (1 - p))))
    a, b = F.col("n1") / size1, F.col("n0") / size0

    def part(observed: F.Column, expected: F.Column) -> F.Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    both = (F.col("n0") + F.col("n1")) / (size0 + size1)
    gain = part(a, both) * size1 + part(1 - a, 1 - both) * size1 + part(b, both) * size0 + part(1 - b, 1 - both) * size0
    best = counted.where(f"feature >= 0 and n0 + n1 >= {RARE}").orderBy(gain.desc(), "feature").limit(features).select("feature").collect()  # bounded by ``features``
    chosen = np.array([r.feature for r in best], np.int64)
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1):
                hit = np.concatenate([place[g] for g in grams(text.as_py())] or [np.zeros(0, np.int32)])
                found.append(np.unique(hit[hit >= 0]).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["id", "y", "held"])

    held = sample.select("id", "text", "y").mapInArrow(reduce, f"id {sample.schema['id'].dataType.simpleString()}, y int, held binary").collect()
    held.sort(key=lambda r: (r.id, r.held))  # bounded by ``rows`` times ``features``; sorted so that equal inputs give equal models
    cols = [np.frombuffer(r.held, np.int32) for r in held]
    weights = np.zeros(BUCKETS, np.float32)
    weights[chosen], intercept = learn(cols, np.array([r.y for r in held], float), len(chosen))
    scratch.drop(sample, counted)
    return Model(weights, float(intercept))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1 (an existing one is replaced); a null text scores as an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))  # BUCKETS floats

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        own = Model(*sent.value)
        return pa.array([own.score(x.as_py()) for x in text], pa.float64())

    return docs.withColumn("score", run(F.col(text_col).cast("string")))


def keep_civil(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pipeline form: the rows that score below ``threshold``, with all their columns; an empty table stays empty."""
    own = "__own_score"
    scored = score(docs.withColumnRenamed("score", own), fit(docs, labels, label_col, id_col, text_col), id_col, text_col)
    kept = scored.where(F.col("score") < threshold).drop("score")
    return kept.withColumnRenamed(own, "score").select(docs.columns)
