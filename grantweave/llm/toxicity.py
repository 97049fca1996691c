"""Toxicity scores from a linear model over character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams of its lower-cased words, present or not. Each is scaled by how
much more often toxic texts have it than others (the log ratio of smoothed counts), and a logistic
regression is fitted on the scaled features. Features whose ratio could be chance are left out.

Training reads a bounded sample of labelled rows (``MAX_ROWS``), dealt over tasks of ``ROWS_PER_TASK``. Counts are
summed over tasks; each task fits its own weights and the weights are averaged. Everything that reaches
the driver or is broadcast is a vector of fixed length. Every text is then scored whole, where it lies.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.llm.blocks import mixed
from grantweave.llm.tables import stored

#: lengths of n-grams; a space stands before and after each word
ORDERS = (3, 4, 5, 6)
BITS = 20
#: most labelled rows that training reads, those with the smallest hash of their id
MAX_ROWS = 12_000
ROWS_PER_TASK = 3_000
#: smoothing of counts, strength of the penalty, steps of the fit
ALPHA = 1.0
PENALTY = 1e-3
STEPS = 120
#: features need this many training texts, and a ratio this many standard errors from zero
MIN_TEXTS = 3
MIN_ERRORS = 3.0

_primes = np.random.default_rng(3).integers(1, 1 << 62, max(ORDERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_last = np.uint64(0x9E3779B97F4A7C15)


def grams(text: str | None) -> list[np.ndarray]:
    """The hashed n-grams of a text, with repeats, for each length."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    # White space and its runs are one space, so that n-grams see word edges.
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    codes = np.full(int(keep.sum()) + 2, 32, np.uint64)
    codes[1:-1] = np.where(blank, 32, chars)[keep]
    codes = mixed(codes + np.uint64(1))
    value = np.zeros(len(codes), np.uint64)
    found = []
    for n in range(1, min(max(ORDERS), len(codes)) + 1):
        value = value[: len(codes) - n + 1] + codes[n - 1 :] * _primes[n - 1]
        if n in ORDERS:
            found.append(((value * _last) >> np.uint64(64 - BITS)).astype(np.int32))
    return found


def features(text: str | None, wanted: np.ndarray | None = None) -> np.ndarray:
    """The distinct hashed n-grams of a text, of those ``wanted`` where given, sorted."""
    found = grams(text)
    if wanted is not None:
        found = [g[wanted[g]] for g in found]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def scaled(slots: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Values of a text's features: their ratios, divided by the root of the length of that vector.

    Half-way between no and full normalisation: a few strong n-grams still count in a long text.
    """
    values = ratios[slots]
    return values / max(float(values @ values), 1e-12) ** 0.25


def fit(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """A weight for each chosen feature and, last, the bias, by accelerated gradient steps.

    Both classes weigh the same. Steps are full passes from zero, so equal input gives equal weights.
    """
    size = len(ratios)
    w = np.zeros(size + 1)
    if labels.min() == labels.max():
        return w
    columns = np.concatenate([np.append(r, size) for r in rows])
    values = np.concatenate([np.append(scaled(r, ratios), 1.0) for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    bend = 0.25 * float(share @ np.bincount(owner, values**2, len(rows))) + PENALTY
    ahead = w
    for step in range(STEPS):
        error = share * (1 / (1 + np.exp(-np.bincount(owner, values * ahead[columns], len(rows)))) - labels)
        slope = np.bincount(columns, values * error[owner], size + 1)
        slope[:-1] += PENALTY * ahead[:-1]
        new = ahead - slope / bend
        ahead, w = new + step / (step + 3) * (new - w), new
    return w


VECTOR = T.StructType([T.StructField("vector", T.BinaryType())])


def _tasks(sample: DataFrame, fn) -> list[np.ndarray]:
    """One vector of fixed length from each task that has rows; ``fn`` takes their texts and labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((t.as_py(), y.as_py()) for batch in batches for t, y in zip(batch.column(0), batch.column(1)))
        first = next(rows, None)
        if first is not None:
            vector = fn(itertools.chain([first], rows)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([vector.tobytes()], pa.binary())], ["vector"])

    return [np.frombuffer(r.vector, np.float32) for r in sample.mapInArrow(run, VECTOR).toLocalIterator()]


class Model:
    """The chosen features, their ratios, and their weights."""

    def __init__(self, chosen: np.ndarray, ratios: np.ndarray, weights: np.ndarray):
        self.chosen, self.ratios, self.weights = chosen, ratios, weights
        self.wanted = np.zeros(1 << BITS, bool)
        self.wanted[chosen] = True

    def slots(self, text: str | None) -> np.ndarray:
        return np.searchsorted(self.chosen, features(text, self.wanted))

    def score(self, text: str | None) -> float:
        slots = self.slots(text)
        return float(1 / (1 + np.exp(-(scaled(slots, self.ratios) @ self.weights[slots] + self.weights[-1]))))


def trained(
    texts: DataFrame,
    labels: DataFrame,
    key_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    max_rows: int = MAX_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> Model:
    """The model of the texts that have a label; ``max_rows`` bounds the sample.

    The sample is drawn from keys and labels alone, and is small enough to be broadcast, so no text but its own
    is moved. Rows without a label or key are left out; of rows that repeat a key, the largest label and text count.
    """
    keys = (
        labels.filter(F.col(label_column).isNotNull() & F.col(key_column).isNotNull())
        .join(texts.select(key_column), key_column, "left_semi")
        .groupBy(key_column)
        .agg(F.max(label_column).cast("int").alias("_label"))
        .orderBy(F.xxhash64(key_column), key_column)
        .limit(max_rows)
    )
    keys = stored(keys, "labels")
    parts = max(1, -(-keys.count() // rows_per_task))
    sample = stored(
        texts.select(key_column, F.col(text_column).cast("string").alias("_text"))
        .join(F.broadcast(keys), key_column)
        .groupBy(key_column)
        .agg(F.max("_text").alias("_text"), F.max("_label").alias("_label"))
        .withColumn("_part", F.pmod(F.xxhash64(F.lit(1), key_column), F.lit(parts))),
        "sample",
    )
    sample = sample.repartition(parts, "_part").sortWithinPartitions(key_column).select("_text", "_label")

    def count(rows) -> np.ndarray:
        found = np.zeros((2, 1 << BITS), np.int32)
        for text, label in rows:
            found[int(label == 1)][features(text)] += 1
        return found.reshape(-1)

    counts = sum((v.astype(np.float64) for v in _tasks(sample, count)), np.zeros(2 << BITS)).reshape(2, -1)
    share = (counts + ALPHA) / (counts + ALPHA).sum(axis=1, keepdims=True)
    ratios = np.log(share[1] / share[0])
    # A ratio counts if it is some standard errors away from none.
    clear = np.abs(ratios) >= MIN_ERRORS * np.sqrt((1 / (counts + 1)).sum(axis=0))
    chosen = np.flatnonzero(clear & (counts.sum(axis=0) >= MIN_TEXTS))
    blank = Model(chosen, ratios[chosen], np.zeros(len(chosen) + 1))

    def train(rows) -> np.ndarray:
        found, labels = [], []
        for text, label in rows:
            found.append(blank.slots(text))
            labels.append(int(label == 1))
        return fit(found, np.array(labels), blank.ratios) if found else np.zeros(len(chosen) + 1)

    fitted = [v for v in _tasks(sample, train) if v.any()]
    weights = np.mean(fitted, axis=0) if fitted else blank.weights
    return Model(chosen, blank.ratios, weights.astype(np.float64))


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``score`` and ``predicted`` of every row; whole texts, null as empty. Repeated rows are scored
    each for itself, an empty table gives no rows, and other columns are not read."""
    schema = T.StructType(
        [docs.schema[id_column], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                schema.names,
            )

    return docs.select(id_column, F.col(text_column).cast("string")).mapInArrow(run, schema)
