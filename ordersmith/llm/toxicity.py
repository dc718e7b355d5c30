"""Toxicity classifier with counterfactual regularisation.

A text is the set of its words and of their first three to six bytes. Features
whose frequency differs between the labels by five standard errors or more are
the vocabulary of a logistic regression. Every labelled text that names a group
of people gets counterfactuals in which the identity term is swapped for the
other terms of its kind and for a neutral one; the squared change of the text's
own score (its log odds) is part of the loss, so that naming a group neither raises nor lowers it.

Scale: fitting reads a bounded sample (``max_train`` labelled rows) and a
bounded vocabulary; features are counted in the tasks before they are shuffled.
Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import (binary_views, doc_slices, fold, list_array, mix64, probe_bitmap, stage, text_bytes)
from ordersmith.llm.labelled import labelled_sample
from ordersmith.llm.words import word_spans

MAX_TRAIN = 20_000
MAX_VOCABULARY = 4096
LEAST_Z = 5.0
LEAST_TEXTS = 8
THRESHOLD = 0.5
FOLDS = 5
PREFIXES = (3, 4, 5, 6)
#: Weight of the mean squared change under a swap, and of the squared weights.
COUNTERFACTUAL = 10.0
RIDGE = 1e-5

#: Identity terms by kind; the first of a kind is the neutral word for it.
IDENTITY_TERMS: dict[str, tuple[str, ...]] = {
    "gender": ("people", "women", "men", "woman", "man", "girls", "boys", "female", "male", "transgender"),
    "faith": ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "christian", "muslim",
              "jewish"),
    "origin": ("residents", "immigrants", "refugees", "foreigners", "africans", "asians", "europeans", "americans",
               "mexicans", "arabs", "germans", "french", "spanish"),
    "colour": ("persons", "black", "white", "brown", "latino", "hispanic"),
    "orientation": ("couples", "gay", "lesbian", "bisexual", "straight", "homosexual", "queer"),
    "ability": ("adults", "disabled", "blind", "deaf", "autistic", "elderly"),
}

_U = np.uint64
_LOWER = np.arange(256)
_LOWER[65:91] += 32


def _features(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hash) of every word and word beginning."""
    words, start, length, off = word_spans(values, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(off))
    docs, hashes = [doc], [words]
    packed = np.zeros(len(words), np.uint64)
    for p in range(1, max(PREFIXES) + 1):
        live = length >= p
        packed[live] |= _LOWER[values[start[live] + (p - 1)]].astype(np.uint64) << _U(8 * (p - 1))
        if p in PREFIXES:
            docs.append(doc[live])
            hashes.append(mix64(packed[live] + _U(p << 56)))
    return np.concatenate(docs), np.concatenate(hashes)


def _feature_sets(arr: pa.Array):
    """(documents of the slice, their numbers, their distinct features), slice by slice."""
    values, offsets = binary_views(arr)
    for i, j in doc_slices(offsets, 1 << 20):
        doc, h = _features(values, offsets[i: j + 1])
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        yield j - i, doc[new], h[new]


def word_hash(word: str) -> int:
    """The feature of one word."""
    raw = word.encode()
    return int(word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0][0])


def _counted(batches):
    """Rows (h, label, n): in how many texts of the batch a feature occurs, by label."""
    for b in batches:
        label = b.column("label").to_numpy(zero_copy_only=False)
        at, found = 0, ([], [])
        for n, doc, h in _feature_sets(b.column("text")):
            mine = label[at: at + n][doc]
            for k in (0, 1):
                found[k].append(h[mine == k])
            at += n
        for k in (0, 1):
            if found[k]:
                h, n = np.unique(np.concatenate(found[k]), return_counts=True)
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(np.full(len(h), k, np.int32)),
                                       pa.array(n.astype(np.int64))], names=["h", "label", "n"])


@dataclass
class Model:
    keys: np.ndarray        # feature hashes, ascending
    weights: np.ndarray
    bias: float

    def bitmap(self) -> np.ndarray:
        bits = np.zeros(1 << 10, np.uint64)
        pos = self.keys & _U(len(bits) * 64 - 1)
        np.bitwise_or.at(bits, (pos >> _U(6)).astype(np.int64), _U(1) << (pos & _U(63)))
        return bits


def _known(keys: np.ndarray, bitmap: np.ndarray, arr: pa.Array):
    """(texts of the slice, text numbers, vocabulary numbers, in how many places), each pair once, slice by slice."""
    values, offsets = binary_views(arr)
    for i, j in doc_slices(offsets, 1 << 20):
        doc, h = _features(values, offsets[i: j + 1])
        maybe = probe_bitmap(bitmap, h)
        doc, h = doc[maybe], h[maybe]
        at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
        hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
        pair, times = np.unique(doc[hit].astype(np.int64) * max(len(keys), 1) + at[hit], return_counts=True)
        yield j - i, pair // max(len(keys), 1), pair % max(len(keys), 1), times


def _scores(m: Model):
    bitmap = m.bitmap()

    def scores(arr: pa.Array) -> pa.Array:
        out = [np.bincount(d, m.weights[v], n) for n, d, v, _ in _known(m.keys, bitmap, arr)]
        z = (np.concatenate(out) if out else np.zeros(0)) + m.bias
        return pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))
    return scores


def counterfactuals(rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, keys: np.ndarray,
                    terms: dict[str, tuple[str, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """The swaps of every identity term in every text: (number of texts, features lost) and features gained.

    Text ``rows`` has feature ``cols`` in ``counts`` places. All places of the
    term are swapped: it takes along those of its features that no other word of
    the text has, and the other term adds those that the text then hasn't. Texts
    in which the same changes are one row; -1 stands for no feature.
    """
    place = {int(k): i for i, k in enumerate(keys)}

    def own(term: str) -> list[int]:
        raw = np.frombuffer(term.encode(), np.uint8)
        _, h = _features(raw, np.array([0, len(raw)]))
        return [place[int(x)] for x in h if int(x) in place]
    feats = [{t: own(t) for t in kind} for kind in terms.values()]
    word = {t: place.get(word_hash(t), -1) for kind in terms.values() for t in kind}
    near = np.isin(cols, [f for kind in feats for fs in kind.values() for f in fs])
    texts: dict[int, list[tuple[int, int]]] = {}
    for r, f, n in zip(rows[near].tolist(), cols[near].tolist(), counts[near].tolist()):
        texts.setdefault(r, []).append((f, n))
    swaps: Counter = Counter()
    for text, n in Counter(tuple(sorted(fs)) for fs in texts.values()).items():
        has = dict(text)
        for kind in feats:
            for t in (t for t in kind if word[t] in has):
                lost = {f for f in kind[t] if has[f] == has[word[t]]}
                for other in kind.keys() - {t}:
                    gained = {f for f in kind[other] if f not in has or f in lost}
                    swaps[tuple(sorted(lost - gained)), tuple(sorted(gained - lost))] += n
    width = 1 + len(PREFIXES)
    pad = lambda xs: (*xs, *[-1] * (width - len(xs)))
    found = sorted(swaps.items())
    a = np.array([[n, *pad(lost)] for (lost, _), n in found], np.int64).reshape(-1, width + 1)
    b = np.array([pad(gained) for (_, gained), _ in found], np.int64).reshape(-1, width)
    return a, b


def train(label: np.ndarray, rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, keys: np.ndarray,
          terms: dict[str, tuple[str, ...]], counterfactual: float = COUNTERFACTUAL, ridge: float = RIDGE,
          steps: int = 500, rate: float = 0.1) -> Model:
    """Logistic regression on feature sets (text ``rows`` has feature ``cols``, in ``counts`` places) with the swap
    penalty, by Adam."""
    n, k = len(label), len(keys)
    w, p = np.zeros(k + 1), float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
    bias = np.log(p / (1 - p))
    swaps, to = counterfactuals(rows, cols, counts, keys, terms)
    total = max(int(swaps[:, 0].sum()), 1) if len(swaps) else 1
    first, second = np.zeros(k + 2), np.zeros(k + 2)
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[cols], n) + bias
        err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) / n
        grad = np.bincount(cols, err[rows], k + 1).astype(float)
        if len(swaps):
            # w[-1] stays 0: a term outside the vocabulary has no weight
            change = w[swaps[:, 1:]].sum(axis=1) - w[to].sum(axis=1)
            pull = 2 * counterfactual * swaps[:, 0] / total * change
            np.add.at(grad, swaps[:, 1:], np.repeat(pull[:, None], swaps.shape[1] - 1, axis=1))
            np.add.at(grad, to, -np.repeat(pull[:, None], to.shape[1], axis=1))
        grad += 2 * ridge * w
        grad[-1] = 0
        g = np.append(grad, err.sum())
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    return Model(keys, w[:-1], bias)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        max_train: int = MAX_TRAIN, terms: dict[str, tuple[str, ...]] = IDENTITY_TERMS,
        counterfactual: float = COUNTERFACTUAL) -> Model | None:
    """Learn from labelled rows whose fold isn't 0; None if there are none.

    Rows of one id and label count once; of several texts the smallest is taken."""
    sample = labelled_sample(docs, labels, label_col, fold("doc_id", FOLDS) != 0, max_train, id_col, text_col)
    sample = stage(sample.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "toxic-train")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 + n1:
        return None
    if not (n0 and n1):
        return Model(np.zeros(0, np.uint64), np.zeros(0), 4.0 if n1 else -4.0)
    counts = (sample.select("label", "text").mapInArrow(_counted, "h long, label int, n long").groupBy("h")
              .agg(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("a"),
                   F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("b")))
    rate = (F.col("a") + F.col("b")) / (n0 + n1)
    z = F.abs(F.col("b") / n1 - F.col("a") / n0) / F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12))
                                                          * (1 / n0 + 1 / n1))
    chosen = (counts.filter(F.col("a") + F.col("b") >= LEAST_TEXTS).withColumn("z", z).filter(F.col("z") >= LEAST_Z)
              .orderBy(F.desc("z"), "h").limit(MAX_VOCABULARY).select("h").toArrow())
    # identity terms are features too, if any text has them
    keys = np.unique(np.concatenate([chosen.column("h").to_numpy().astype(np.int64).view(np.uint64),
                                     np.array([word_hash(t) for ts in terms.values() for t in ts], np.uint64)]))
    bitmap = Model(keys, keys, 0.0).bitmap()

    def found(t: pa.Array) -> pa.Array:
        known = list(_known(keys, bitmap, t))
        none = np.zeros(0, np.int64)
        sizes = np.concatenate([np.bincount(d, minlength=n) for n, d, _, _ in known] or [none])
        return pa.StructArray.from_arrays(
            [list_array(np.concatenate([x[k] for x in known] or [none]).astype(np.int32), sizes, pa.int32())
             for k in (2, 3)], names=["f", "n"])
    rows = (sample.select("label", F.arrow_udf(found, "f array<int>, n array<int>")("text").alias("known"),
                          F.xxhash64("doc_id").alias("o"))
            .orderBy("o", "label").select("label", "known.f", "known.n").toArrow())          # at most 2 * max_train rows
    sets = rows.column("f").combine_chunks()
    width = np.diff(np.asarray(sets.offsets))
    return train(rows.column("label").to_numpy().astype(float), np.repeat(np.arange(len(width)), width),
                 sets.flatten().to_numpy().astype(np.int64),
                 rows.column("n").combine_chunks().flatten().to_numpy().astype(np.int64), keys, terms, counterfactual)


def toxicity_score(model: Model | None, text_col: str = "text") -> Column:
    """The probability of label 1 (0 where nothing could be learned); null texts count as empty."""
    if model is None:
        return F.lit(0.0)
    return F.arrow_udf(_scores(model), "double")(text_bytes(text_col))


def score_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted.

    Null and empty texts have no features and get the score of the bias alone;
    repeated rows get the same score; a null id is not held out. Other columns
    are ignored. Without usable labels every score is 0; an empty table gives
    no rows.
    """
    model = fit(docs, labels, label_col, id_col, text_col, **options)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col, FOLDS) == 0, F.lit(False)).alias("held_out"),
        toxicity_score(model, text_col).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
