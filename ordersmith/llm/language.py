"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of 128 bytes. In each direction a gated recurrent
layer (reset after the product, gates and candidate clipped to their range)
runs over the bytes; both states together give every position a distribution
over the languages, and a document's probabilities are the mean over all its
positions. Training is backpropagation through time in numpy with Adam, on
windows of a bounded sample (``per_language`` documents a language,
``windows_per_text`` windows of each). The network has an output for every
language that is labelled, however many there are.

Scale: scoring is one pass without a shuffle; windows of a batch of texts are
read side by side, so a step is a few products of small arrays, and a very long
text takes no more memory than many short ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import binary_views, fold, list_array, text_bytes

WINDOW = 128
HIDDEN = 12
PAD = 256
FOLDS, HELD_OUT = 4, 2
PER_LANGUAGE = 300
WINDOWS_PER_TEXT = 4
#: Windows that the sample of all languages has, about; with many languages each gets fewer documents.
MAX_WINDOWS = 400_000
STEPS = 150
#: Windows read side by side.
SIDE_BY_SIDE = 2048


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray       # (2, 3H, 257): input part of update gate, reset gate and candidate, by direction and byte
    inner: np.ndarray       # (2, 3H, H)
    out: np.ndarray         # (L, 2H)
    bias: np.ndarray        # (L, 1)


def _new_model(languages: list[str], hidden: int, rng: np.random.Generator) -> Model:
    f = np.float32
    table = rng.normal(0, 0.4, (2, 3 * hidden, 257)).astype(f)
    table[:, : 2 * hidden] += 0.5                       # gates are clipped to [0, 1]
    inner = rng.normal(0, 0.5 / np.sqrt(hidden), (2, 3 * hidden, hidden)).astype(f)
    return Model(languages, table, inner, rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(f),
                 np.zeros((len(languages), 1), f))


def _closed_at_pad(table: np.ndarray) -> np.ndarray:
    """The table with the update gate shut at padding, so that the state passes it unchanged."""
    t = table.copy()
    t[:, : t.shape[1] // 3, PAD] = -1e6
    return t


def _run(table: np.ndarray, inner: np.ndarray, ids: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (T, H, B) of one direction over ``ids`` (T, B)."""
    h3, n = inner.shape[0], ids.shape[1]
    hid = h3 // 3
    states = np.empty((len(ids), hid, n), np.float32)
    h = np.zeros((hid, n), np.float32)
    x, s = np.empty((h3, n), np.float32), np.empty((h3, n), np.float32)
    for t, byte in enumerate(ids):
        np.take(table, byte, axis=1, out=x, mode="clip")
        np.dot(inner, h, out=s)
        gates = x[: 2 * hid] + s[: 2 * hid]
        gates_in = gates.copy() if trace is not None else None
        np.clip(gates, 0, 1, out=gates)
        cand = gates[hid:] * s[2 * hid:]
        cand += x[2 * hid:]
        cand_in = cand.copy() if trace is not None else None
        np.clip(cand, -1, 1, out=cand)
        step = cand - h
        step *= gates[:hid]
        if trace is not None:
            trace.append((byte, h.copy(), gates, gates_in, cand, cand_in, s[2 * hid:].copy()))
        np.add(h, step, out=states[t])
        h = states[t]
    return states


def _position_probabilities(m: Model, fwd: np.ndarray, bwd: np.ndarray) -> np.ndarray:
    hid = fwd.shape[0]
    z = m.out[:, :hid] @ fwd
    z += m.out[:, hid:] @ bwd
    z += m.bias
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


def position_probabilities(m: Model, ids: np.ndarray) -> np.ndarray:
    """(T, L, B): the distribution over languages at every position of the windows ``ids`` (T, B)."""
    table = _closed_at_pad(m.table)
    fwd = _run(table[0], m.inner[0], ids)
    bwd = _run(table[1], m.inner[1], ids[::-1])[::-1]
    return np.stack([_position_probabilities(m, fwd[t], bwd[t]) for t in range(len(ids))])


def windows_of(values: np.ndarray, offsets: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the windows that cover every text, text by text."""
    size = np.diff(offsets)
    n = -(-size // length)
    first = np.repeat(offsets[:-1], n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = first + k * length
    return start, np.minimum(length, np.repeat(offsets[1:], n) - start)


def _gather(values: np.ndarray, start: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    at = start[None, :] + np.arange(length)[:, None]
    ids = values[np.minimum(at, len(values) - 1)].astype(np.int64)
    ids[np.arange(length)[:, None] >= size[None, :]] = PAD
    return ids


def document_probabilities(m: Model, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, L): the mean over all positions of a text (equal shares for an empty one)."""
    n_docs, n_lang = len(offsets) - 1, len(m.languages)
    total = np.zeros((n_docs, n_lang))
    start, size = windows_of(values, offsets)
    doc = np.searchsorted(offsets, start, side="right") - 1
    table = _closed_at_pad(m.table)
    for a in range(0, len(start), SIDE_BY_SIDE):
        s, n = start[a: a + SIDE_BY_SIDE], size[a: a + SIDE_BY_SIDE]
        ids = _gather(values, s, n, WINDOW)
        fwd = _run(table[0], m.inner[0], ids)
        bwd = _run(table[1], m.inner[1], ids[::-1])
        part = np.zeros((n_lang, len(s)), np.float32)
        for t in range(WINDOW):
            p = _position_probabilities(m, fwd[t], bwd[WINDOW - 1 - t])
            p *= n > t
            part += p
        for k in range(n_lang):
            total[:, k] += np.bincount(doc[a: a + SIDE_BY_SIDE], part[k], n_docs)
    size = np.diff(offsets)[:, None]
    return np.where(size > 0, total / np.maximum(size, 1), 1 / max(n_lang, 1))


def _back(inner: np.ndarray, trace: list, d_states: np.ndarray, g_table: np.ndarray, g_inner: np.ndarray) -> None:
    """Add the gradients of one direction, given those of its states (T, H, B)."""
    hid = inner.shape[1]
    dh = np.zeros_like(d_states[0])
    for t in range(len(trace) - 1, -1, -1):
        byte, h, gates, gates_in, cand, cand_in, s_cand = trace[t]
        dh = dh + d_states[t]
        z, r = gates[:hid], gates[hid:]
        d_cand = dh * z * (np.abs(cand_in) < 1)
        d_gates = np.concatenate([dh * (cand - h), d_cand * s_cand]) * ((gates_in > 0) & (gates_in < 1))
        d_x = np.concatenate([d_gates, d_cand])
        d_s = np.concatenate([d_gates, d_cand * r])
        np.add.at(g_table.T, byte, d_x.T)
        g_inner += d_s @ h.T
        dh = dh * (1 - z) + inner.T @ d_s


def train(m: Model, ids: np.ndarray, label: np.ndarray, steps: int, rng: np.random.Generator, batch: int = 256,
          rate: float = 0.01) -> None:
    """Fit ``m`` to windows ``ids`` (T, N) whose positions all have the language ``label`` (N)."""
    hid = m.inner.shape[2]
    params = [m.table, m.inner, m.out, m.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    by_language = [np.flatnonzero(label == k) for k in range(len(m.languages))]
    by_language = [x for x in by_language if len(x)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(x, max(1, batch // len(by_language))) for x in by_language])
        x, y = ids[:, pick], label[pick]
        live = (x != PAD).astype(np.float32)
        weight = live / live.sum()
        grads = [np.zeros_like(p) for p in params]
        table = _closed_at_pad(m.table)
        traces: list[list] = [[], []]
        fwd = _run(table[0], m.inner[0], x, traces[0])
        bwd = _run(table[1], m.inner[1], x[::-1], traces[1])
        d_fwd, d_bwd = np.zeros_like(fwd), np.zeros_like(bwd)
        last = len(x) - 1
        for t in range(len(x)):
            dz = _position_probabilities(m, fwd[t], bwd[last - t])
            dz[y, np.arange(len(y))] -= 1
            dz *= weight[t]
            grads[2] += dz @ np.concatenate([fwd[t], bwd[last - t]]).T
            grads[3] += dz.sum(axis=1, keepdims=True)
            d = m.out.T @ dz
            d_fwd[t], d_bwd[last - t] = d[:hid], d[hid:]
        for k, d_states in enumerate((d_fwd, d_bwd)):
            _back(m.inner[k], traces[k], d_states, grads[0][k], grads[1][k])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        for p, g, a, b in zip(params, grads, first, second):
            g *= min(1.0, 1.0 / (norm + 1e-9))
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)


def _some_windows(windows_per_text: int):
    """Up to so many windows of each text, evenly spread over it."""
    def some(arr: pa.Array) -> pa.Array:
        out = []
        for t in arr:
            x = t.as_py()
            n = -(-len(x) // WINDOW)
            k = min(n, windows_per_text)
            out.append([x[w * WINDOW: (w + 1) * WINDOW] for w in (n * i // k for i in range(k))])
        return pa.array(out, pa.list_(pa.binary()))
    return some


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE, windows_per_text: int = WINDOWS_PER_TEXT, max_windows: int = MAX_WINDOWS,
        hidden: int = HIDDEN, steps: int = STEPS, seed: int = 11) -> Model | None:
    """Learn from documents with a language whose fold isn't the held-out one; None if there are none.

    About ``per_language`` documents of each language are taken, by the hash of
    their id (fewer where all languages together would exceed ``max_windows``),
    and up to ``windows_per_text`` windows of each, evenly spread over it.
    """
    learn = docs.filter((fold(id_col, FOLDS) != HELD_OUT) & F.col(lang_col).isNotNull()
                        & F.col(text_col).rlike(r"\p{L}"))
    learn = learn.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), text_bytes(text_col).alias("text"))
    counts = learn.groupBy("lang").count().collect()                               # one row a language
    if not counts:
        return None
    per_language = min(per_language, max(1, max_windows // (windows_per_text * len(counts))))
    shares = docs.sparkSession.createDataFrame([(r["lang"], per_language / r["count"]) for r in counts], "lang string, share double")
    unit = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    rows = (learn.join(F.broadcast(shares), "lang").filter(unit < F.col("share"))
            .select(F.xxhash64("doc_id").alias("h"), "lang",
                    F.explode(F.arrow_udf(_some_windows(windows_per_text), "array<binary>")("text")).alias("w"))
            .orderBy("h", "lang", "w").limit(2 * per_language * windows_per_text * len(counts)).collect())
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    ids = np.full((WINDOW, len(rows)), PAD, np.int64)
    for i, r in enumerate(rows):
        ids[: len(r["w"]), i] = np.frombuffer(r["w"], np.uint8)
    label = np.array([languages.index(r["lang"]) for r in rows])
    rng = np.random.default_rng(seed)
    model = _new_model(languages, hidden, rng)
    if len(languages) > 1:
        train(model, ids, label, steps, rng)
    return model


def _probabilities(m: Model):
    def probabilities(arr: pa.Array) -> pa.Array:
        values, offsets = binary_views(arr)
        p = document_probabilities(m, values, offsets)
        return list_array(p.ravel(), np.full(len(p), p.shape[1]), pa.float64())
    return probabilities


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            **options) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score, probs (language to probability).

    Null texts and texts without a letter are ``und`` with a score of 0; so is
    every text if there is nothing to learn from. Repeated rows get the same
    answer; a null id is not held out. Other columns are ignored; an empty
    table gives no rows.
    """
    model = fit(docs, id_col, text_col, lang_col, **options)
    known: Column = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    base = [F.col(id_col).alias("doc_id"),
            F.coalesce(fold(id_col, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")]
    if model is None:
        return docs.select(*base, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.create_map().cast("map<string,double>").alias("probs"))
    probs = F.arrow_udf(_probabilities(model), "array<double>")(text_bytes(text_col))
    names = F.array(*[F.lit(x) for x in model.languages])
    rows = docs.select(*base, known.alias("known"), probs.alias("p"))
    best = F.array_max("p")
    return rows.select(
        "doc_id", "held_out",
        F.when(F.col("known"), F.element_at(names, F.array_position("p", best).cast("int"))).otherwise("und")
        .alias("lang_pred"),
        F.when(F.col("known"), best).otherwise(0.0).alias("score"), F.map_from_arrays(names, "p").alias("probs"))
