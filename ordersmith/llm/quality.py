"""Quality classifier: random Fourier features, ridge normal equations, isotonic calibration.

A text becomes 20 statistics (lengths, shares of kinds of bytes, repetition).
Standardised, they are mapped to cosines of random projections, whose inner
products approximate a Gaussian kernel. Every task sums the normal equations of
its rows, the sums are added up, and the ridge weights solve them. Scores of a
further part of the labelled rows, counted by score, are made monotone by
pooling adjacent violators; that curve turns ridge scores into probabilities.

Scale: fitting reads a bounded sample (``max_train`` labelled rows); sums are a
square of the number of features. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import SLICE_BYTES, binary_views, doc_slices, fold, list_array, stage, text_bytes
from ordersmith.llm.labelled import labelled_sample
from ordersmith.llm.words import shingles, word_spans

MAX_TRAIN = 20_000
COSINES = 256
RIDGE = 1e-3
THRESHOLD = 0.3
FOLDS = 5
#: Score bins that calibration counts, over [-0.5, 1.5].
BINS = 2000

# kinds of bytes whose shares are statistics
_KIND = np.full(256, 9)
for _k, _chars in enumerate((b" \t", b"\n\r", bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)),
                             b".,;:?'\"()-", b"!", b"|", bytes(range(128, 256)))):
    _KIND[list(_chars)] = _k
_KINDS = 10
STATISTICS = _KINDS + 10


def _distinct(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Distinct values in each of the joined runs."""
    out, at = np.zeros(len(counts)), 0
    for i, n in enumerate(counts.tolist()):
        if n:
            part = np.sort(values[at: at + n])
            out[i] = 1 + np.count_nonzero(part[1:] != part[:-1])
        at += n
    return out


def statistics(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` numbers for every document (an empty one: zeros)."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    kinds = np.zeros((n, _KINDS))
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for c in range(a, b, SLICE_BYTES):
            kinds[i] += np.bincount(_KIND[values[c: min(c + SLICE_BYTES, b)]], minlength=_KINDS)
    words, _, length, off = word_spans(values, offsets)
    n_words = np.diff(off)
    has = np.maximum(n_words, 1)
    doc = np.repeat(np.arange(n), n_words)
    mean = np.bincount(doc, length, n) / has
    var = np.bincount(doc, length.astype(float) ** 2, n) / has - mean ** 2
    again = np.zeros(n)
    if len(words) > 1:
        same = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
        again = np.bincount(doc[1:], same, n)
    grams, n_grams = shingles(words, off)
    apart = _distinct(words, n_words)
    return np.column_stack([
        kinds / np.maximum(size, 1)[:, None], np.log1p(size), np.log1p(n_words), mean, np.sqrt(np.maximum(var, 0)),
        apart / has, np.log1p(apart) / np.log1p(has), again / has,
        _distinct(grams, n_grams) / np.maximum(n_grams, 1),
        np.log1p(kinds[:, 1]) - np.log1p(n_words), np.log1p(kinds[:, 5]) - np.log1p(n_words)])


def _batch_statistics(arr: pa.Array) -> np.ndarray:
    values, offsets = binary_views(arr)
    rows = [statistics(values, offsets[i: j + 1]) for i, j in doc_slices(offsets, 1 << 20)]
    return np.concatenate(rows) if rows else np.zeros((0, STATISTICS))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    project: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    curve_x: np.ndarray
    curve_y: np.ndarray

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        out = np.cos(z @ self.project + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack([out, np.ones(len(out))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.curve_x, self.curve_y)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing least-squares curve through (x, y), x ascending: its blocks' mean x and value."""
    blocks: list[list[float]] = []                   # weight, sum of x, sum of y
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist()):
        blocks.append([w, w * a, w * b])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 1] / b[:, 0], b[:, 2] / b[:, 0]


def _normal_sums(model: Model):
    """Per task: row i of Z'Z and element i of Z'y, as rows (i, sums)."""
    def sums(batches):
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            z = model.cosines(np.array(b.column("stats").to_pylist(), float))
            y = b.column("label").to_numpy(zero_copy_only=False).astype(float)
            part = np.column_stack([z.T @ z, z.T @ y])
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total)), pa.int32()),
                                   list_array(total.ravel(), np.full(len(total), total.shape[1]), pa.float64())],
                                  names=["i", "sums"])
    return sums


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_train: int = MAX_TRAIN, n_cosines: int = COSINES, ridge: float = RIDGE,
        seed: int = 7) -> Model | None:
    """Learn from labelled rows whose fold isn't 0 (fold 4 only calibrates); None if there are none.

    A labelled id that several rows of documents have counts once a label.
    """
    sample = labelled_sample(docs, labels, label_col, fold("doc_id", FOLDS) != 0, max_train, id_col, text_col)
    to_stats = F.arrow_udf(lambda t: list_array(
        (s := _batch_statistics(t)).ravel(), np.full(len(s), STATISTICS), pa.float64()), "array<double>")
    # repeated documents of one id count once
    train = stage(sample.select("doc_id", "label", to_stats("text").alias("stats")).groupBy("doc_id", "label")
                  .agg(F.min("stats").alias("stats")), "quality-train")
    part = train.filter(fold("doc_id", FOLDS) != FOLDS - 1)
    moments = (part.select(F.posexplode("stats").alias("i", "v")).groupBy("i")
               .agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("i").collect())   # a row a statistic
    if not moments:
        return None
    rng = np.random.default_rng(seed)
    scale = np.array([r["s"] if r["s"] > 1e-9 else 1.0 for r in moments])
    model = Model(np.array([r["m"] for r in moments]), scale,
                  rng.normal(size=(STATISTICS, n_cosines)) / np.sqrt(STATISTICS), rng.uniform(0, 2 * np.pi, n_cosines),
                  np.zeros(n_cosines + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    sums = part.select("label", "stats").mapInArrow(_normal_sums(model), "i int, sums array<double>")
    added = (sums.select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
             .toArrow())                                                       # a square of n_cosines numbers
    eq = np.zeros((n_cosines + 1, n_cosines + 2))
    eq[added.column("i").to_numpy(), added.column("j").to_numpy()] = added.column("v").to_numpy()
    n = eq[-1, -2]
    model.weights = np.linalg.solve(eq[:, :-1] + ridge * n * np.diag([1.0] * n_cosines + [1e-9]), eq[:, -1])

    raw = F.arrow_udf(lambda s: pa.array(model.raw(np.array(s.to_pylist(), float).reshape(-1, STATISTICS))), "double")
    held = train.filter(fold("doc_id", FOLDS) == FOLDS - 1).select("label", raw("stats").alias("raw"))
    bins = (held.groupBy(F.least(F.greatest(F.floor((F.col("raw") + 0.5) * (BINS / 2)), F.lit(0)), F.lit(BINS - 1))
                         .alias("bin"))
            .agg(F.avg("raw").alias("x"), F.avg("label").alias("y"), F.count(F.lit(1)).alias("n"))
            .orderBy("bin").collect())                                         # at most BINS rows
    if bins:
        model.curve_x, model.curve_y = isotonic(*(np.array([r[c] for r in bins], float) for c in "xyn"))
    return model


def quality_score(model: Model | None, text_col: str = "text") -> Column:
    """The probability of label 1 (0.5 where nothing could be learned); null texts count as empty."""
    if model is None:
        return F.lit(0.5)
    return F.arrow_udf(lambda t: pa.array(model.score(_batch_statistics(t))), "double")(text_bytes(text_col))


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                  text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted.

    Null and empty texts get the score of empty statistics; repeated rows the
    same score; a null id is not held out. Other columns are ignored. Without
    usable labels every score is 0.5; an empty table gives no rows.
    """
    model = fit(docs, labels, label_col, id_col, text_col, **options)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col, FOLDS) == 0, F.lit(False)).alias("held_out"),
        quality_score(model, text_col).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
              text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` predicted to be good, with the columns of ``docs``, whatever their names.

    Null and empty texts are judged by empty statistics, equal texts alike, so
    repeated rows stay or go together; ids may be null. Without usable labels
    all rows stay, of an empty table none. Very long texts are read whole.
    """
    model = fit(docs, labels, label_col, id_col, text_col, **options)
    return docs.filter(quality_score(model, text_col) >= threshold)
