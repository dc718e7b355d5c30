"""Near-duplicate groups by DartMinHash over weighted word shingles.

A text is the multiset of its five-word shingles; two texts are near
duplicates if their weighted Jaccard similarity is 0.8 or more. The c-th
occurrence of a shingle is a unit region of its own, on which darts arrive at
hashed ranks (a Poisson process of rate one). A text throws the darts of all
its regions up to a rank that yields about k ln k + 2k of them, each falls on
one of k coordinates, and every coordinate keeps its earliest dart. Two texts
agree on a coordinate with a probability of their similarity. Bands of the
signature propose pairs; a pair is a link only after its similarity has been
computed from both whole texts.

Scale: texts with equal shingles are one class and only one of them is signed
into buckets. In a bucket all members are first compared with one of them, its
hub: the member whose buckets are largest, which for a family of edited copies
is the text they come from. That costs one comparison a member. Members of
buckets that then still hold several groups may be linked to each other past
the hub: small buckets are compared pair by pair, and the members of large ones
hub by hub in blocks of bounded size, where one matrix product counts the
common regions of two blocks. Only links leave a block, so no link between
groups is lost and no list of pairs is made; the blocks' arithmetic does grow
with the square of a family's different texts. With 24 bands of 4 coordinates,
a pair of similarity 0.8 shares no band with a probability of 3 in a million;
of 0.85, of 4 in a hundred million.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import (binary_views, doc_slices, hashed_bitmap, list_array, mix64, probe_bitmap,
                                   stage, text_bytes, with_uid)
from ordersmith.llm.words import shingles, word_spans

WORDS = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 4
#: Buckets of up to this many members are compared pair by pair.
SMALL_BUCKET = 24
#: Texts and regions in a block, on average.
BLOCK_TEXTS = 256
BLOCK_CELLS = 250_000
MATRIX_COLUMNS = 8192
_U = np.uint64


def regions(values: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted unit regions (shingle, occurrence) of every document, and their counts."""
    words, _, _, word_off = word_spans(values, offsets)
    s, counts = shingles(words, word_off, k)
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        s[a:b].sort()
    if not len(s):
        return s, counts
    first = np.ones(len(s), bool)
    first[1:] = s[1:] != s[:-1]
    first[(ends - counts)[counts > 0]] = True
    at = np.flatnonzero(first)
    occurrence = np.arange(len(s)) - np.repeat(at, np.diff(np.append(at, len(s))))
    return mix64(s + occurrence.astype(np.uint64) * _U(0x9FB21C651E98DF25)), counts


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _salt(j: int) -> np.uint64:
    return _U(j * 0xE7037ED1A0B428DB & 0xFFFFFFFFFFFFFFFF)


def dart_signatures(cells: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart on each of k coordinates for every document (zeros for one without regions)."""
    n = len(counts)
    best = np.full(n * k, np.inf)
    sig = np.zeros(n * k, np.uint64)
    todo = np.flatnonzero(counts)
    doc = np.repeat(np.arange(n), counts)
    darts = k * np.log(k) + 2 * k
    high = np.zeros(n)                                    # darts up to this rank are thrown
    high[todo] = darts / counts[todo]
    while len(todo):
        cell, owner = cells, doc
        if len(todo) < n:
            mine = np.zeros(n, bool)
            mine[todo] = True
            pick = mine[doc]
            cell, owner = cells[pick], doc[pick]
        rank, j = np.zeros(len(cell)), 0
        while len(cell):
            u = _uniform(mix64(cell + _salt(2 * j + 1)))
            rank = rank - np.log(u)
            near = rank <= high[owner]
            cell, owner, rank = cell[near], owner[near], rank[near]
            dart = mix64(cell ^ _salt(2 * j + 2))
            slot = owner * k + (dart % _U(k)).astype(np.int64)
            np.minimum.at(best, slot, rank)
            won = best[slot] == rank
            sig[slot[won]] = dart[won]
            j += 1
        # a coordinate without a dart: throw further
        empty = np.isinf(best.reshape(n, k)).any(axis=1) & (counts > 0)
        todo = np.flatnonzero(empty)
        high[todo] *= 2
    return sig.reshape(n, k)


def _sign(bands: int, rows: int, k_words: int):
    def sign(batches):
        for b in batches:
            values, offsets = binary_views(b.column("text"))
            c1, c2, keys, size = [], [], [], []
            for i, j in doc_slices(offsets, 1 << 20):
                cells, counts = regions(values, offsets[i: j + 1], k_words)
                sig = dart_signatures(cells, counts, bands * rows)
                key = np.zeros((len(counts), bands), np.uint64)
                for r in range(rows):
                    key = mix64(key ^ sig[:, r::rows])
                key = mix64(key + np.arange(bands, dtype=np.uint64))
                total = np.zeros((2, len(counts)), np.uint64)
                has = counts > 0
                if has.any():
                    at = (np.cumsum(counts) - counts)[has]
                    total[0, has] = np.add.reduceat(cells, at)
                    total[1, has] = np.add.reduceat(mix64(cells ^ _U(0x5851F42D4C957F2D)), at)
                c1.append(total[0].view(np.int64))
                c2.append(total[1].view(np.int64))
                keys.append(key.view(np.int64).ravel())
                size.append(counts)
            if not size:
                continue
            size = np.concatenate(size)
            none = size == 0
            yield pa.record_batch([
                b.column("uid"), b.column("doc_id"), pa.array(size, pa.int64()),
                pa.array(np.concatenate(c1), pa.int64(), mask=none), pa.array(np.concatenate(c2), pa.int64(), mask=none),
                list_array(np.concatenate(keys), np.full(len(size), bands), pa.int64())],
                names=["uid", "doc_id", "weight", "c1", "c2", "bands"])
    return sign


def _cells(k_words: int, need: np.ndarray):
    """uid and the sorted unit regions of its text, as the bytes of 64-bit numbers, of rows whose h may be in ``need``."""
    def cells(batches):
        for b in batches:
            h = b.column("h").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            b = b.filter(pa.array(probe_bitmap(need, h)))
            values, offsets = binary_views(b.column("text"))
            for i, j in doc_slices(offsets, 1 << 20):
                r, counts = regions(values, offsets[i: j + 1], k_words)
                ends = np.cumsum(counts)
                off = np.concatenate([[0], np.cumsum(counts) * 8]).astype(np.int32)
                for a, z in zip((ends - counts).tolist(), ends.tolist()):
                    r[a:z].sort()
                column = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(off), pa.py_buffer(r)])
                yield pa.record_batch([b.column("uid").slice(i, j - i), column], names=["uid", "cells"])
    return cells


def _linked(similarity: float):
    def linked(batches):
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column("ca"), b.column("cb"))):
                x, y = (np.frombuffer(c.as_buffer(), np.uint64) for c in (x, y))
                m = np.concatenate([x, y])
                m.sort(kind="stable")
                # regions of one text differ, so equal neighbours are a region of both
                common = int(np.count_nonzero(m[1:] == m[:-1]))
                keep[i] = len(m) > 0 and common >= similarity * (len(m) - common)
            yield pa.record_batch([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep))
    return linked


def _linked_in_blocks(similarity: float):
    """Links between members of different groups in one pair of blocks (or one block and itself)."""
    def linked(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        cells = [np.frombuffer(c.as_buffer(), np.uint64) for c in t.column("cells")]
        size = np.array([len(c) for c in cells])
        _, number, times = np.unique(np.concatenate(cells), return_inverse=True, return_counts=True)
        shared = times > 1
        column = (np.cumsum(shared) - 1)[number]
        row = np.repeat(np.arange(len(cells)), size)
        common = np.zeros((len(cells), len(cells)), np.float32)
        width = int(shared.sum())
        use = shared[number]
        row, column = row[use], column[use]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for a in range(0, width, MATRIX_COLUMNS):
            i, j = np.searchsorted(column, [a, a + MATRIX_COLUMNS])
            m = np.zeros((len(cells), min(MATRIX_COLUMNS, width - a)), np.float32)
            m[row[i:j], column[i:j] - a] = 1
            common += m @ m.T
        block, label = t.column("block").to_numpy(), t.column("label")
        _, group = np.unique([str(x) for x in label.to_pylist()], return_inverse=True)
        link = common >= similarity * (size[:, None] + size[None, :] - common)
        link &= group[:, None] != group[None, :]
        same = t.column("p")[0].as_py() == t.column("q")[0].as_py()
        if not same:
            link &= block[:, None] != block[None, :]
        x, y = np.nonzero(np.triu(link, 1))
        rep = t.column("rep").combine_chunks()
        return pa.table({"a": rep.take(pa.array(x)), "b": rep.take(pa.array(y))})
    return linked


def cells_of(uids: DataFrame, rows: DataFrame, k_words: int) -> DataFrame:
    """(uid, cells) of the texts in ``rows`` (uid, text) whose uid is in ``uids``, and perhaps a few more."""
    h = F.xxhash64("uid")
    need = hashed_bitmap(uids.select(h.alias("h")))
    # one Python step: a filter of its own would hold a second worker, with the texts, beside each task's first
    return stage(rows.select("uid", "text", h.alias("h")).mapInArrow(
        _cells(k_words, need), f"uid {dict(rows.dtypes)['uid']}, cells binary"), "near-cells")


def links(pairs: DataFrame, cells: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose texts are similar enough."""
    return (pairs.join(cells.select(F.col("uid").alias("a"), F.col("cells").alias("ca")), "a")
            .join(cells.select(F.col("uid").alias("b"), F.col("cells").alias("cb")), "b")
            .select("a", "b", "ca", "cb")
            .mapInArrow(_linked(similarity), pairs.select("a", "b").schema))


def links_in_blocks(families: DataFrame, cells: DataFrame, similarity: float) -> DataFrame:
    """Links between members (hub, rep, label, weight) of one family in different groups, without listing pairs."""
    sizes = families.groupBy("hub").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("weight") / BLOCK_CELLS)).cast("int")
        .alias("blocks"))
    placed = (families.join(sizes, "hub")
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = placed.select("hub", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                          "block", "rep", "label")
    kind = dict(families.dtypes)["rep"]
    return (dealt.join(cells.withColumnRenamed("uid", "rep"), "rep").groupBy("hub", "p", "q")
            .applyInArrow(_linked_in_blocks(similarity), f"a {kind}, b {kind}"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the least node it is connected with.

    Labels spread to neighbours and then jump to their label's label, staged
    each round, until none changes.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("label")), "near-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("m")))
        spread = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("l"))
        jump = labels.select(F.col("node").alias("l"), F.col("label").alias("ll"))
        moved = stage(spread.join(jump, "l", "left").select(
            "node", "old", F.least("l", F.coalesce("ll", "l")).alias("label")), "near-labels")
        changed = moved.filter(F.col("old") != F.col("label")).limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels


def joined_groups(labels: DataFrame, more: DataFrame) -> DataFrame:
    """``labels`` (node, label) after the links (a, b) of ``more``; only the groups that these join are gone through."""
    ends = more
    for n in "ab":
        ends = ends.join(labels.select(F.col("node").alias(n), F.col("label").alias(f"l{n}")), n, "left")
    joined = components(ends.select(*(F.coalesce(f"l{n}", n).alias(n) for n in "ab")))
    moved = joined.select(F.col("node").alias("label"), F.col("label").alias("to"))
    alone = joined.join(labels, "node", "left_anti")              # nodes without a link before
    return (labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            .unionByName(alone))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
               k_words: int = WORDS, bands: int = BANDS, rows: int = ROWS, uid: str | None = None) -> DataFrame:
    """One row a document: uid, doc_id, group_id, group_size, kept.

    Documents linked directly or through others are one group; group_id is the
    id of the row that stays: the smallest, null ids last, then the first in
    storage. A text of fewer words than ``k_words`` has one shingle, all its
    words; texts without words (null, empty, only signs) are groups of their
    own. Repeated rows are duplicates of each other. An empty table gives no
    rows; other columns are ignored.
    """
    if uid is None:
        docs, uid = with_uid(docs, "near-rows")
    source = docs.select(F.col(uid).alias("uid"), F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    kinds = source.schema
    signed = stage(source.mapInArrow(
        _sign(bands, rows, k_words),
        f"uid {kinds['uid'].dataType.simpleString()}, doc_id {kinds['doc_id'].dataType.simpleString()}, "
        "weight long, c1 long, c2 long, bands array<long>"), "near-signed")

    classes = stage(signed.filter("c1 is not null").groupBy("c1", "c2").agg(
        F.min("uid").alias("rep"), F.min("weight").alias("weight"), F.min_by("bands", "uid").alias("bands")),
        "near-classes")
    entries = classes.select("rep", "weight", F.explode("bands").alias("key"))
    shared = stage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-shared")
    members = stage(entries.join(shared, "key"), "near-members")
    scores = stage(members.groupBy("rep").agg(F.sum("n").alias("score")), "near-scores")
    hubs = stage(members.join(scores, "rep").groupBy("key").agg(
        F.max(F.struct("score", "rep")).alias("best")).select("key", F.col("best.rep").alias("hub")), "near-hubs")
    members = stage(members.join(hubs, "key"), "near-members")

    tried = stage(members.filter("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(),
                  "near-pairs")
    cells = cells_of(members.select(F.col("rep").alias("uid")), source, k_words)
    edges = stage(links(tried, cells, similarity), "near-links")
    labels = components(edges)

    # buckets whose members are not all one group yet: every link across groups
    placed = stage(members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "hub", "rep", "n", "weight", F.coalesce("label", "rep").alias("label")), "near-placed")
    several = stage(placed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y")
                    .select("key"), "near-several")
    mixed = stage(placed.join(several, "key"), "near-mixed")
    left, right = (mixed.filter(F.col("n") <= SMALL_BUCKET)
                   .select("key", F.col("rep").alias(n), F.col("label").alias(f"l{n}")) for n in "ab")
    pairs = left.join(right, "key").filter("a < b and la != lb").select("a", "b").distinct()
    families = mixed.filter(F.col("n") > SMALL_BUCKET).select("hub", "rep", "label", "weight").distinct()
    more = stage(links(pairs, cells, similarity).unionByName(links_in_blocks(families, cells, similarity)),
                 "near-links")
    if more.limit(1).count():
        labels = stage(joined_groups(labels, more), "near-labels")

    grouped = (signed.select("uid", "doc_id", "c1", "c2").join(classes.select("c1", "c2", "rep"), ["c1", "c2"], "left")
               .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
               .select("uid", "doc_id", F.coalesce("label", "rep", "uid").alias("label")))
    grouped = stage(grouped, "near-groups")
    # staged, so that the join reads both sides by plain exchanges and Spark can split a hot group
    best = stage(grouped.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "uid")).alias("best"),
        F.count(F.lit(1)).alias("group_size")), "near-best")
    return grouped.join(best, "label").select(
        "uid", "doc_id", F.col("best.doc_id").alias("group_id"), "group_size",
        (F.col("best.uid") == F.col("uid")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_dedup`` keeps, with the columns of ``docs``, whatever their names.

    Texts without words (null and empty ones too) all stay, of repeated rows
    with words one; ids may be null; an empty table stays empty. Very long
    texts are compared whole.
    """
    rows, uid = with_uid(docs, "near-kept")
    gone = near_dedup(rows, id_col, text_col, uid=uid).filter("not kept").select(F.col("uid").alias(uid))
    return rows.join(gone, uid, "left_anti").select(*docs.columns)
