"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its words, hashed into buckets with the square root of their count and scaled to
length 1, then structure statistics (length, shares of upper-case, digits, signs and white space, repeated words,
lines) and the recorded length as metadata. The model is

    b + sum w_i x_i + sum over i<j of <v_i, v_j> x_i x_j

and the pairwise part is half the sum over factors of (sum v_i x_i)^2 - sum (v_i x_i)^2, so that scoring is linear in
the number of features. It is fitted with numpy by Adam on a bounded sample of labelled rows.

Null or empty texts have only structure features and get a score like any other. Null n_chars, or a table
without that column: the measured length. Without labels, or with one class only, every score is the smoothed share of label 1. Repeated
rows stay, an empty table gives an empty result, a null id stays null and counts as the empty text for the folds.
Columns other than doc_id, text and n_chars are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, labelled_sample, sigmoid, sparing, text_parts, word_hashes

BUCKETS = 1 << 13
_KIND = np.zeros((256, 6), np.float32)  # upper case, digits, signs, white space, line ends, beyond ASCII
_KIND[65:91, 0] = 1
_KIND[48:58, 1] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()"], 2] = 1
_KIND[[9, 10, 11, 12, 13, 32], 3] = 1
_KIND[10, 4] = 1
_KIND[128:, 5] = 1
STATS = 12
SLICE = 1 << 18  # bytes of text worked on at a time


def sums_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the slices between ``bounds``; empty slices give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a slice of texts: bounds of each row's features, their indexes, their values."""
    rows = len(offsets) - 1
    hashes, first, starts, ends = word_hashes(data, offsets)
    words = np.diff(first)
    row = np.repeat(np.arange(rows), words)
    key, count = np.unique(row * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    owner = key // BUCKETS
    bounds = np.searchsorted(owner, np.arange(rows + 1))
    length = np.sqrt(np.maximum(words, 1))  # the squares of the roots of the counts add up to the words
    value = np.sqrt(count) / length[owner]
    top = np.zeros(rows)
    np.maximum.at(top, owner, count)
    edges = offsets.astype(np.int64)
    size = np.maximum(np.diff(edges), 1)
    kinds = np.stack([sums_by_row(_KIND[data, k], edges) for k in range(6)], axis=1)
    letters = sums_by_row((ends - starts).astype(np.float64), first)
    n = np.maximum(words, 1)
    recorded = np.where(np.isnan(n_chars), size, n_chars)
    stats = np.stack([
        np.log1p(words) / 8, kinds[:, 0] / size * 3, kinds[:, 1] / size * 10, np.minimum(kinds[:, 2] / n, 3), kinds[:, 3] / size * 4, kinds[:, 4] / n * 10,
        kinds[:, 5] / size * 5, letters / n / 8, np.diff(bounds) / n, top / n * 4, np.log1p(np.maximum(recorded, 0)) / 10, (words < 8).astype(float)], axis=1)
    stats = np.clip(stats, 0, 4)
    at = np.insert(key % BUCKETS, np.repeat(bounds[1:], STATS), np.tile(BUCKETS + np.arange(STATS), rows))
    values = np.insert(value, np.repeat(bounds[1:], STATS), stats.ravel())
    return bounds + STATS * np.arange(rows + 1), at, values


@dataclass
class Machine:
    bias: float
    linear: np.ndarray | None = None
    factors: np.ndarray | None = None

    def margin(self, bounds: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        if self.linear is None:
            return np.full(len(bounds) - 1, self.bias)
        vx = self.factors[at] * values[:, None]
        # every row has its structure features, so no slice is empty
        total, squares = np.add.reduceat(vx, bounds[:-1]), np.add.reduceat(np.square(vx), bounds[:-1])
        return self.bias + np.add.reduceat(self.linear[at] * values, bounds[:-1]) + 0.5 * (total**2 - squares).sum(axis=1)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], rank: int = 8, rounds: int = 12, batch: int = 128, rate: float = 0.02, decay: float = 1e-4) -> Machine:
    """Adam on the logistic loss; rows are (indexes, values, label)."""
    labels = np.array([y > 0 for _, _, y in rows], float)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    found = Machine(float(np.log(share / (1 - share))))
    if not len(labels) or labels.min() == labels.max():
        return found
    rng = np.random.default_rng(11)
    size = BUCKETS + STATS
    theta = np.concatenate([np.zeros((size, 1)), rng.normal(0, 0.05, (size, rank))], axis=1)
    first, second, bias_moments = np.zeros_like(theta), np.zeros_like(theta), np.zeros(2)
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(rows))
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            lengths = np.array([len(rows[i][0]) for i in chosen])
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            at, x = np.concatenate([rows[i][0] for i in chosen]), np.concatenate([rows[i][1] for i in chosen]).astype(float)
            owner = np.repeat(np.arange(len(chosen)), lengths)
            v = theta[at, 1:]
            total = np.add.reduceat(v * x[:, None], bounds[:-1])
            squares = np.add.reduceat(np.square(v * x[:, None]), bounds[:-1])
            margin = found.bias + np.add.reduceat(theta[at, 0] * x, bounds[:-1]) + 0.5 * (total**2 - squares).sum(axis=1)
            error = (sigmoid(margin) - labels[chosen]) / len(chosen)
            by_feature = error[owner] * x
            gradient = np.zeros_like(theta)
            gradient[:, 0] = np.bincount(at, by_feature, size)
            inner = by_feature[:, None] * (total[owner] - v * x[:, None])
            for f in range(rank):
                gradient[:, f + 1] = np.bincount(at, inner[:, f], size)
            gradient += decay * theta
            step += 1
            first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
            theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            g = error.sum()
            bias_moments = np.array([0.9, 0.999]) * bias_moments + np.array([0.1, 0.001]) * np.array([g, g * g])
            found.bias -= rate * (bias_moments[0] / (1 - 0.9**step)) / (np.sqrt(bias_moments[1] / (1 - 0.999**step)) + 1e-8)
    found.linear, found.factors = theta[:, 0].copy(), theta[:, 1:].copy()
    return found


def _inputs(docs: DataFrame, *more: str) -> DataFrame:
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", chars.alias("n_chars"), *more)


def _parts(batches):
    for part, data, offsets in text_parts(batches, "text", SLICE):
        yield part, features(data, offsets, part.column("n_chars").to_numpy(zero_copy_only=False).astype(float))


def learn(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, bound: int = 8_000) -> Machine:
    """Fit on at most ``bound`` labelled documents; features are made by the tasks."""

    def run(batches):
        for part, (bounds, at, values) in _parts(batches):
            cut = range(len(bounds) - 1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([at[bounds[i] : bounds[i + 1]].astype(np.int32) for i in cut], pa.list_(pa.int32())),
                 pa.array([values[bounds[i] : bounds[i + 1]].astype(np.float32) for i in cut], pa.list_(pa.float32())), part.column("_label")],
                names=["doc_id", "at", "x", "label"])

    sample = labelled_sample(_inputs(docs), labels, "quality", folds, held, bound).select("doc_id", "text", "n_chars", "_label")
    rows = sample.mapInArrow(sparing(run), "doc_id long, at array<int>, x array<float>, label int").toArrow()  # <= bound documents
    ids = rows["doc_id"].to_numpy()
    order = np.argsort(ids, kind="stable")  # the order of tasks must not matter
    at, x, y = rows["at"].combine_chunks(), rows["x"].combine_chunks(), rows["label"].to_numpy()
    return fit([(at[int(i)].values.to_numpy(), x[int(i)].values.to_numpy(), int(y[i])) for i in order])


def score_rows(machine: Machine):
    def run(batches):
        for part, inputs in _parts(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sigmoid(machine.margin(*inputs)))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    return _inputs(docs).mapInArrow(sparing(score_rows(machine)), "doc_id long, score double")


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Learn outside the held-out fold, score all documents."""
    scored = score(docs, learn(docs, labels, folds, held))
    return scored.select("doc_id", (fold_of("doc_id", folds) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 3, held: int = 1) -> DataFrame:
    """The documents scored ``threshold`` at least, with all their columns, in one pass after the fit."""
    machine = learn(docs, labels, folds, held)
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    text = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            column = batch.column(chars).cast(pa.float64()) if chars is not None else pa.nulls(batch.num_rows, pa.float64())
            inputs = pa.RecordBatch.from_arrays([batch.column(text), column], names=["text", "n_chars"])
            margins = [machine.margin(*found) for _, found in _parts([inputs])]
            yield batch.filter(pa.array(sigmoid(np.concatenate(margins)) >= threshold)) if margins else batch

    return docs.mapInArrow(sparing(run), docs.schema)
