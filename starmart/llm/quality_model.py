"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents labelled good, the other sample is unlabelled text of any quality, and the class
prior is the share of good labels among labelled training rows. A small network minimises the non-negative unbiased
risk: the positives' loss weighted by the prior, plus the unlabelled rows' loss as negatives less the positives' share
of it; when that difference goes below zero, the step is taken back instead of followed.

The fit reads at most ``SAMPLE`` labelled and ``UNLABELLED`` unlabelled rows, those with the lowest hashes of their ids;
features and scores cover every document. Features are shares and counts of a whole text by itself, so they need no corpus statistics.

Defined results: a null text is empty, and an empty text has a score; documents without an id are never training rows
and never held out; documents labelled twice are not trusted unless all labels are good; without positives or without
unlabelled rows every score is the prior, and without labels that is one half; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from starmart.llm.common import SPACED, carried, flat, lists, packed, slices, words
from starmart.sources.files import store

SAMPLE = 20_000
UNLABELLED = 20_000
SEED = 9
# Byte classes whose share of the text is a feature: capitals, digits, and single marks.
CLASSES = [
    np.isin(np.arange(256), list(chars))
    for chars in (range(0x41, 0x5B), range(0x30, 0x3A), b"!", b"|", b"#*$%&<>", b".,;:", b"?", b"\n", b"()[]{}=\"'/@_-")
]
N_FEATURES = len(CLASSES) + 9


def is_held_out(doc_id: Column) -> Column:
    """Rows kept for the evaluation: a quarter of all ids."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of numbers per text."""
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), N_FEATURES), np.float32)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    for k, members in enumerate(CLASSES):
        out[full, k] = np.add.reduceat(members[raw].astype(np.int64), bounds[:-1][full]) / sizes[full]
    out[:, : len(CLASSES)] = np.sqrt(out[:, : len(CLASSES)])
    hashes, starts, first = words(raw, bounds, SPACED)
    n = np.diff(first)
    k = len(CLASSES)
    out[:, k] = np.log1p(sizes) / 10
    out[:, k + 1] = np.log1p(n) / 10
    out[:, k + 2] = np.minimum(sizes / np.maximum(n, 1), 50) / 50
    lines = np.concatenate([[0], np.cumsum(raw == 0x0A)])
    for i in np.flatnonzero(n):
        own = hashes[first[i] : first[i + 1]]
        pairs = own[:-1] * np.uint64(3) + own[1:]
        line = lines[starts[first[i] : first[i + 1]]]
        heads = np.flatnonzero(np.diff(line, prepend=-1))
        totals = np.add.reduceat(own, heads)
        counts = np.unique(own, return_counts=True)[1]
        out[i, k + 3] = len(counts) / len(own)
        out[i, k + 4] = len(np.unique(pairs)) / max(len(pairs), 1)
        out[i, k + 5] = np.count_nonzero(own[1:] == own[:-1]) / len(own)
        out[i, k + 6] = len(np.unique(totals)) / len(totals)
        out[i, k + 7] = counts.max() / len(own)
        out[i, k + 8] = np.log1p(len(own) / len(totals)) / 5
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        rows = features(*flat(texts))
        values = lists(pa.array(rows.reshape(-1)), np.full(len(rows), N_FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), values], names=["doc", "features"])


@dataclass
class Model:
    """A network of one hidden layer; ``prior`` is the answer while it has no weights."""

    prior: float
    weights: tuple[np.ndarray, ...] = ()

    def logits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w1, b1, w2, b2 = self.weights
        hidden = np.tanh(x @ w1 + b1)
        return hidden, hidden @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.prior)
        return _sigmoid(self.logits(x.astype(np.float64))[1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, steps: int = 600) -> Model:
    """Full-batch Adam on the non-negative risk with the logistic loss."""
    if not len(positive) or not len(unlabelled):
        return Model(prior)
    x = np.concatenate([positive, unlabelled]).astype(np.float64)
    n = len(positive)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    rng = np.random.default_rng(SEED)
    params = [rng.normal(0, 0.3, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1)]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    for step in range(1, steps + 1):
        h = np.tanh(x @ params[0] + params[1])
        good = _sigmoid(h @ params[2] + params[3])
        negative = np.log1p(np.exp(np.clip(h @ params[2] + params[3], -30, 30)))
        rest = negative[n:].mean() - prior * negative[:n].mean()
        slope = np.zeros(len(x))
        if rest >= 0:
            slope[:n] = prior * (good[:n] - 1) / n - prior * good[:n] / n
            slope[n:] = good[n:] / (len(x) - n)
        else:  # the difference can't be negative in truth: go back up
            slope[:n] = prior * good[:n] / n
            slope[n:] = -good[n:] / (len(x) - n)
        back = slope[:, None] * params[2] * (1 - h * h)
        grads = [x.T @ back, back.sum(0), h.T @ slope, np.array([slope.sum()])]
        for i, g in enumerate(grads):
            g = g + 1e-4 * params[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            step_size = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            params[i] = params[i] - step_size * first[i] / (np.sqrt(second[i]) + 1e-8)
    w1 = params[0] / scale[:, None]
    return Model(prior, (w1, params[1] - mean @ w1, params[2], params[3]))


def _collected(rows: DataFrame, sample: int) -> np.ndarray:
    """The features of at most ``sample`` rows, those with the lowest hash of their id.

    A first cut by hash leaves about the sample and a tenth, so that no task sends many more to the driver.
    """
    share = min(1.0, 1.1 * sample / max(rows.count(), 1))
    draw = F.xxhash64("doc_id", F.lit(SEED))
    picked = rows.filter(F.pmod(draw, F.lit(1 << 30)) <= int(share * (1 << 30))).orderBy(draw, "doc_id").limit(sample)
    return np.array([r[0] for r in picked.select("features").collect()], np.float32).reshape(-1, N_FEATURES)


def train(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE, unlabelled: int = UNLABELLED) -> Model:
    """Fits on measured rows that are not held out."""
    own = rows.select(F.col("doc.doc_id").alias("doc_id"), "features")
    own = own.filter(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    label = labels.filter(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n, good = label.agg(F.count("quality"), F.sum("quality")).first()
    prior = min(max((good or 0) / n, 0.01), 0.99) if n else 0.5
    trusted = label.filter("quality = 1").select("doc_id")
    return fit(_collected(own.join(trusted, "doc_id"), sample), _collected(own, unlabelled), prior)


def _scores(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("features").flatten().to_numpy().reshape(-1, N_FEATURES)
            columns = [batch.column("doc"), pa.array(model.score(values), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "score"])

    return run


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    carry: Sequence[str] | None = None,
    unlabelled: int = UNLABELLED,
) -> DataFrame:
    """``doc`` (the columns of the row, or those to ``carry``) and its ``score``."""
    out = packed(docs)
    schema = StructType([out.schema["doc"], StructField("features", ArrayType(FloatType()))])
    rows = carried(out.mapInArrow(_measure, schema), carry)
    rows = store(rows, "quality_features")
    model = train(rows, labels, sample, unlabelled)
    schema = StructType([rows.schema["doc"], *StructType.fromDDL("score double").fields])
    return rows.mapInArrow(_scores(model), schema)


def digest(scored: DataFrame, threshold: float = 0.7) -> DataFrame:
    doc_id = F.col("doc.doc_id")
    return scored.select(
        doc_id.alias("doc_id"),
        is_held_out(doc_id).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
