"""Best-fit packing of token sequences by minimum bin slack.

Texts become token ids with one end id behind each. Only a longer document is
cut, into full pieces and one shorter piece in front. Then, bin by bin, the
longest piece left is combined with the set of other lengths that fills the bin
best: a subset sum over the lengths still there, held as the bits of one
integer, with as many copies of each as there are. The combination is removed,
as often as its lengths allow, and the next is looked for.

Scale: pieces of one length are interchangeable, so the plan needs only how
many pieces there are of each length, at most ``capacity`` numbers, and holds a
bounded number of combinations. Each task numbers its own pieces by length; the
numbers' beginnings are sums over tasks, and a piece finds its place from its
number alone. No token moves between tasks.

The ids are those of ``tokenizers`` with the same vocabulary; ``tiktoken``
computes them, at six times the speed (tests compare both). It gives up on a run
of about a million blanks or line ends; ``tokenizers`` encodes such a text itself.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordersmith.llm.common import stage

CAPACITY = 2048
END_ID = 0
#: The table of first numbers is broadcast up to this many rows, and joined by shuffle beyond.
BROADCAST_ROWS = 1_000_000


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(path), special_tokens={})


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``: what the merges of lower rank leave of its bytes."""
    parts = [token[i: i + 1] for i in range(len(token))]
    while len(parts) > 2:
        i = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], len(ranks)))
        parts[i: i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


@lru_cache(maxsize=2)
def unlimited_tokenizer(path: str):
    """The same vocabulary in ``tokenizers``, whose splitting has no limit; made only where it is needed."""
    from tokenizers import Tokenizer, models, pre_tokenizers
    ranks = _ranks(path)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    char = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(sorted({*range(256)} - {*plain}))}

    def spelt(token: bytes) -> str:
        return "".join(char[b] for b in token)
    merges = [tuple(map(spelt, _halves(t, ranks))) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    t = Tokenizer(models.BPE({spelt(t): r for t, r in ranks.items()}, merges))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    return t


def token_ids(text: str, path: str) -> np.ndarray:
    """The token ids of a text; special tokens are plain text."""
    try:
        return tokenizer(path).encode_to_numpy(text, disallowed_special=()).astype("<u4")
    except ValueError:                                   # the stack for a run of white space is used up
        return np.array(unlimited_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4")


def _pieces(path: str | None, capacity: int, end_id: int):
    def pieces(batches):
        vocabulary = path or vocabulary_path()
        pid = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            doc, piece, start, length, ids, rank = [], [], [], [], [], []
            for i, text in enumerate(b.column("text")):
                x = np.append(token_ids(text.as_py() or "", vocabulary), np.array([end_id], "<u4"))
                first = (len(x) - 1) % capacity + 1
                cuts = [0, *range(first, len(x) + 1, capacity)]
                for k, (p, q) in enumerate(zip(cuts, cuts[1:])):
                    doc.append(i)
                    piece.append(k)
                    start.append(p)
                    length.append(q - p)
                    ids.append(x[p:q].tobytes())
                    rank.append(int(seen[q - p]))
                    seen[q - p] += 1
            yield pa.record_batch([
                b.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                pa.array([pid] * len(doc), pa.int32()), pa.array(rank, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids", "task", "rank"])
    return pieces


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The copies of each length whose sum comes closest to ``room`` without exceeding it (longest tried first)."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            copies = min(copies, left)
            more = (reach | reach << copies * length) & mask
            if more != reach:
                steps.append((length, copies, reach))
                reach = more
            left -= copies
            copies *= 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + copies
            at -= copies * length
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where the pieces go, as runs of numbers by length.

    A run says: of pieces of ``length``, those numbered from ``rank`` on lie, ``copies``
    in each sequence, in the sequences from ``sequence`` on, from ``offset`` on.
    """
    left = {n: c for n, c in histogram.items() if c}
    used = dict.fromkeys(left, 0)
    runs, sequence = [], 0
    while left:
        longest = max(left)
        others = {**left, longest: left[longest] - 1}
        bin_ = fullest({n: c for n, c in others.items() if c}, capacity - longest)
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(left[n] // c for n, c in bin_.items())
        offset = 0
        for n in sorted(bin_, reverse=True):
            runs.append((n, used[n], bin_[n], sequence, offset))
            offset += n * bin_[n]
            used[n] += times * bin_[n]
            left[n] -= times * bin_[n]
            if not left[n]:
                del left[n]
        sequence += times
    runs.sort()
    cols = np.array(runs, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "copies", "sequence", "offset"), cols))


def _place(runs: dict[str, np.ndarray]):
    key = (runs["length"] << 48) + runs["rank"]

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted(key, (n.astype(np.int64) << 48) + r, side="right") - 1
        k = r - runs["rank"][at]
        copies = runs["copies"][at]
        return pa.StructArray.from_arrays(
            [pa.array(runs["sequence"][at] + k // copies, pa.int64()),
             pa.array(runs["offset"][at] + k % copies * n, pa.int64())], names=["sequence_id", "offset"])
    return place


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids (binary, little-endian unsigned 32 bits), sequence_id, offset.

    Null texts are empty: one piece of the end id. Repeated rows are packed
    each; ids may be null. Other columns are ignored; an empty table gives no rows.
    ``vocabulary`` is a path that every executor has.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    pieces = stage(source.mapInArrow(
        _pieces(vocabulary, capacity, end_id),
        f"doc_id {dict(source.dtypes)['doc_id']}, piece int, start long, length long, ids binary, task int, rank long"),
        "pack-pieces")
    counts = stage(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(histogram, capacity)                     # at most ``capacity`` lengths
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if counts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        base = F.broadcast(base)
    place = F.arrow_udf(_place(runs), "sequence_id long, offset long")
    placed = pieces.join(base, ["task", "length"]).withColumn(
        "at", place("length", F.col("base") + F.col("rank")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "at.sequence_id", "at.offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences of ``pack``: sequence_id, n_tokens and ids (each at most the capacity)."""
    return (pieces.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
            .select("sequence_id", "n_tokens",
                    F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")).alias("ids")))
