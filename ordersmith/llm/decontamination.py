"""Benchmark decontamination by winnowing.

Of every 10 consecutive words the smallest of the six hashed 5-word grams is
kept as a fingerprint, in documents and in benchmark items alike, so any
shared run of 10 words shares a fingerprint. Fingerprints are joined; every
hit is extended word by word to the whole runs that document and item have in
common there, and runs of at least 10 words count. An item of fewer words is
one window: its fingerprint is the gram of all its words, and documents keep
every gram of that length.

Scale: documents drop fingerprints that a bitmap of fixed size rules out before
anything is shuffled, and only the texts that still have some are kept beside
them. Hits, spans and items of one document are bounded by its own length and
the benchmark's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import (binary_views, doc_slices, hashed_bitmap, list_array, mix64, probe_bitmap, stage,
                                   text_bytes, with_uid)
from ordersmith.llm.words import kgrams, word_spans

WINDOW = 10
GRAM = 5
_U = np.uint64


def fingerprints(words: np.ndarray, word_off: np.ndarray, short: tuple[int, ...] = (),
                 window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash), sorted by position: winnowed grams, and every gram of the ``short`` lengths."""
    ends = np.repeat(word_off[1:], np.diff(word_off))          # by word: where its document ends
    at, hashes = [], []
    g = kgrams(words, gram)
    n = len(words) - window + 1
    if n > 0:
        low, pos = g[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, window - gram + 1):
            less = g[j: j + n] < low
            low[less] = g[j: j + n][less]
            pos[less] = j
        inside = np.arange(n) + window <= ends[:n]
        p = np.unique(np.arange(n)[inside] + pos[inside])
        at.append(p)
        hashes.append(mix64(g[p] + _U(window)))
    for k in short:
        g = kgrams(words, k)
        p = np.flatnonzero(np.arange(len(g)) + k <= ends[: len(g)])
        at.append(p)
        hashes.append(mix64(g[p] + _U(k)))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, hashes = np.concatenate(at), np.concatenate(hashes)
    order = np.argsort(at, kind="stable")
    return at[order], hashes[order]


def _item_rows(window: int, gram: int):
    def rows(batches):
        for b in batches:
            values, offsets = binary_views(b.column("text"))
            words, _, _, off = word_spans(values, offsets)
            n = np.diff(off)
            at, hashes, counts = [], [], []
            for i in range(len(n)):
                w, k = words[off[i]: off[i + 1]], int(n[i])
                p, h = fingerprints(w, np.array([0, k]), (k,) if 0 < k < window else (), window, gram)
                at.append(p)
                hashes.append(h.view(np.int64))
                counts.append(len(p))
            yield pa.record_batch([
                b.column("item"), b.column("item_id"), list_array(words.view(np.int64), n, pa.int64()),
                list_array(np.concatenate(hashes), np.array(counts), pa.int64()),
                list_array(np.concatenate(at), np.array(counts), pa.int32())],
                names=["item", "item_id", "words", "hashes", "places"])
    return rows


def _doc_rows(bitmap: np.ndarray, short: tuple[int, ...], window: int, gram: int):
    def rows(batches):
        for b in batches:
            values, offsets = binary_views(b.column("text"))
            n_words, at, hashes, counts = [], [], [], []
            for i, j in doc_slices(offsets, 1 << 20):
                words, _, _, off = word_spans(values, offsets[i: j + 1])
                p, h = fingerprints(words, off, short, window, gram)
                hit = probe_bitmap(bitmap, h)
                p, h = p[hit], h[hit]
                doc = np.searchsorted(off, p, side="right") - 1
                n_words.append(np.diff(off))
                counts.append(np.bincount(doc, minlength=j - i))
                at.append(p - off[doc])
                hashes.append(h.view(np.int64))
            if not n_words:
                continue
            counts = np.concatenate(counts)
            text = b.column("text")
            text = pa.array([t.as_py() if c else None for t, c in zip(text, counts)], pa.binary())
            yield pa.record_batch([
                b.column("uid"), b.column("doc_id"), pa.array(np.concatenate(n_words), pa.int64()),
                list_array(np.concatenate(hashes), counts, pa.int64()),
                list_array(np.concatenate(at), counts, pa.int32()), text],
                names=["uid", "doc_id", "n_words", "hashes", "places", "text"])
    return rows


def runs_on_diagonal(doc: np.ndarray, item: np.ndarray, shift: int, least: int) -> list[tuple[int, int]]:
    """Document spans [start, end) of at least ``least`` words equal to the item's words ``shift`` places before."""
    a, b = max(0, shift), min(len(doc), shift + len(item))
    same = np.zeros(b - a + 2, np.int8)
    same[1:-1] = doc[a:b] == item[a - shift: b - shift]
    turn = np.diff(same)
    return [(a + s, a + e) for s, e in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist())
            if e - s >= least]


def _extend(window: int):
    def extend(batches):
        for b in batches:
            values, offsets = binary_views(b.column("text"))
            rows, uids, read = [], b.column("uid"), None
            for i in range(b.num_rows):
                if read is None or uids[i] != uids[read]:            # rows of one document come together
                    doc, read = word_spans(values, offsets[i: i + 2])[0], i
                item = np.array(b.column("words")[i].as_py(), np.int64).view(np.uint64)
                spans = set()
                for shift in b.column("shifts")[i].as_py():
                    spans.update(runs_on_diagonal(doc, item, shift, min(window, len(item))))
                if spans:
                    rows.append((i, sorted(spans)))
            take = pa.array([i for i, _ in rows], pa.int64())
            n = np.array([len(s) for _, s in rows], np.int64)
            flat = np.array([x for _, s in rows for x in s], np.int32).reshape(-1, 2)
            yield pa.record_batch([b.column("uid").take(take), b.column("item_id").take(take),
                                   list_array(flat[:, 0], n, pa.int32()), list_array(flat[:, 1], n, pa.int32())],
                                  names=["uid", "item_id", "starts", "ends"])
    return extend


def _merged(starts: pa.Array, ends: pa.Array) -> pa.Array:
    out = []
    for s, e in zip(starts.to_pylist(), ends.to_pylist()):
        spans: list[dict] = []
        for a, b in sorted((a, b) for xs, ys in zip(s, e) for a, b in zip(xs, ys)):
            if spans and a <= spans[-1]["end"]:
                spans[-1]["end"] = max(spans[-1]["end"], b)
            else:
                spans.append({"start": a, "end": b})
        out.append(spans)
    return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                  uid: str | None = None) -> DataFrame:
    """One row a document: uid, doc_id, n_words, spans (word positions [start, end) that benchmark windows cover,
    joined and in order), items (ids with a window in it, as sorted text).

    Null or empty texts have no words; neither has an item without words, which
    covers nothing. An item without an id covers words but isn't listed, and an
    id on several rows is listed once. Repeated documents are rows of their
    own. Other columns are ignored; empty tables give no rows or no spans.
    """
    if uid is None:
        docs, uid = with_uid(docs, "leak-rows")
    source = docs.select(F.col(uid).alias("uid"), F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    kinds = {c: t for c, t in source.dtypes}
    items = benchmark.select(F.monotonically_increasing_id().alias("item"),
                             F.col(item_col).cast("string").alias("item_id"), text_bytes(item_text_col).alias("text"))
    items = stage(items.mapInArrow(_item_rows(window, gram), "item long, item_id string, words array<long>, "
                                   "hashes array<long>, places array<int>"), "leak-items")
    short = tuple(r[0] for r in items.filter(F.size("words").between(1, window - 1)).select(F.size("words"))
                  .distinct().orderBy(F.size("words")).collect())          # at most window - 1 lengths
    marks = items.select("item", F.explode(F.arrays_zip("hashes", "places")).alias("m")).select(
        "item", F.col("m.hashes").alias("h"), F.col("m.places").alias("item_at"))
    bitmap = hashed_bitmap(marks.select("h"))

    read = stage(source.mapInArrow(
        _doc_rows(bitmap, short, window, gram),
        f"uid {kinds['uid']}, doc_id {kinds['doc_id']}, n_words long, hashes array<long>, places array<int>, "
        "text binary"), "leak-docs")
    found = read.filter(F.size("hashes") > 0).select("uid", F.explode(F.arrays_zip("hashes", "places")).alias("m"))
    shifts = (found.select("uid", F.col("m.hashes").alias("h"), F.col("m.places").alias("at")).join(marks, "h")
              .groupBy("uid", "item").agg(F.collect_set(F.col("at") - F.col("item_at")).alias("shifts")))
    spans = (shifts.join(items.select("item", "item_id", "words"), "item")
             .join(read.select("uid", "text").filter("text is not null"), "uid")
             .select("uid", "item_id", "words", "shifts", "text").sortWithinPartitions("uid")
             .mapInArrow(_extend(window), f"uid {kinds['uid']}, item_id string, starts array<int>, ends array<int>"))
    per_doc = spans.groupBy("uid").agg(
        F.collect_list("starts").alias("s"), F.collect_list("ends").alias("e"),
        F.array_sort(F.collect_set("item_id")).alias("items"))
    per_doc = per_doc.select(
        "uid", F.arrow_udf(_merged, "array<struct<start:int,end:int>>")("s", "e").alias("spans"), "items")
    return read.select("uid", "doc_id", "n_words").join(per_doc, "uid", "left").select(
        "uid", "doc_id", "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no window of the benchmark occurs in, with the columns of ``docs``, whatever their names.

    Null and empty texts have no words and stay; repeated rows stay or go
    together; ids may be null. Without benchmark items all rows stay, of an
    empty table none. Very long texts are read whole.
    """
    rows, uid = with_uid(docs, "leak-kept")
    hit = contamination(rows, benchmark, id_col, text_col, uid=uid).filter(F.size("spans") > 0)
    return rows.join(hit.select(F.col("uid").alias(uid)), uid, "left_anti").select(*docs.columns)
