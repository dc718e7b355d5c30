"""Token counts by a linear longest-match automaton.

Words (runs without white space, each with a space in front) are cut greedily
into the longest pieces of a vocabulary, but only the number of pieces is
wanted. The vocabulary is a trie; a node's failure link leads to the node of
what remains once the pieces are taken that are certain there, and the number
of those pieces is computed beforehand. A text is read once, byte by byte, and
never looked at again, and no piece is built.

Scale: one pass without a shuffle; the words of a batch advance side by side,
and the few that are longer than all others are then walked one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import binary_views, doc_slices, text_bytes

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: So few words are walked one by one rather than side by side.
FEW_WORDS = 64
#: Bytes of text whose words are counted at a time (a longer word is taken whole).
PART_BYTES = 1 << 18


@dataclass
class Automaton:
    row: np.ndarray         # node -> row of ``goto`` (0: a node without children)
    goto: np.ndarray        # (rows, 256) -> child or -1
    fail: np.ndarray        # node -> node after the certain pieces
    popped: np.ndarray      # node -> number of those pieces
    rest: np.ndarray        # node -> pieces of all of its text, at a word's end


def build(vocabulary: list[bytes]) -> Automaton:
    """The automaton of a vocabulary; a byte that isn't in it is a piece of its own."""
    children: list[dict[int, int]] = [{}]
    final = [False]
    for piece in [*vocabulary, *(bytes([c]) for c in range(256))]:
        node = 0
        for c in piece:
            child = children[node].get(c)
            if child is None:
                child = children[node][c] = len(children)
                children.append({})
                final.append(False)
            node = child
        final[node] = node > 0
    n = len(children)
    fail, popped, rest = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    level = [(0, c, v) for c, v in children[0].items()]
    while level:
        below = []
        for parent, c, v in level:
            if final[v]:
                popped[v] = 1                         # the whole text is one piece, nothing remains
            else:
                z, k = int(fail[parent]), int(popped[parent])
                while c not in children[z]:
                    k += int(popped[z])
                    z = int(fail[z])
                fail[v], popped[v] = children[z][c], k
            rest[v] = popped[v] + rest[fail[v]]       # the remainder is shorter, so its count is known
            below += [(v, d, w) for d, w in children[v].items()]
        level = below
    inner = [v for v in range(n) if children[v]]
    row = np.zeros(n, np.int32)
    goto = np.full((len(inner) + 1, 256), -1, np.int32)
    for i, v in enumerate(inner, 1):
        row[v] = i
        goto[i, list(children[v])] = list(children[v].values())
    return Automaton(row, goto, fail, popped, rest)


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    with open(path, "rb") as f:
        return build([base64.b64decode(line.split()[0]) for line in f if line.strip()])


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _walk(a: Automaton, text: memoryview, node: int) -> tuple[int, int]:
    """The node reached from ``node`` over the bytes of ``text``, and the pieces popped on the way."""
    row, goto, fail, popped = (memoryview(x) for x in (a.row, a.goto.ravel(), a.fail, a.popped))
    count = 0
    for c in text:
        to = goto[row[node] * 256 + c]
        while to < 0:
            count += popped[node]
            node = fail[node]
            to = goto[row[node] * 256 + c]
        node = to
    return node, count


def piece_counts(a: Automaton, values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The number of pieces of each word, read with a space in front."""
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    flat = a.goto.ravel()
    node = np.full(len(start), flat[a.row[0] * 256 + 32], np.int32)
    count = np.zeros(len(start), np.int64)
    together = int(length[FEW_WORDS]) if len(length) > FEW_WORDS else 0     # from here on at most FEW_WORDS go on
    alive = np.searchsorted(-length, -np.arange(together), side="left")
    for p, n in enumerate(alive.tolist()):
        c = values[start[:n] + p].astype(np.int64)
        u = node[:n]
        to = flat[a.row[u].astype(np.int64) * 256 + c]
        stuck = np.flatnonzero(to < 0)
        while len(stuck):
            v = u[stuck]
            count[stuck] += a.popped[v]
            v = a.fail[v]
            u[stuck] = v
            t = flat[a.row[v].astype(np.int64) * 256 + c[stuck]]
            to[stuck] = t
            stuck = stuck[t < 0]
        node[:n] = to
    text = memoryview(values)
    for w in np.flatnonzero(length[:FEW_WORDS] > together).tolist():
        node[w], more = _walk(a, text[int(start[w]) + together: int(start[w] + length[w])], int(node[w]))
        count[w] += more
    out = np.empty(len(start), np.int64)
    out[order] = count + a.rest[node]
    return out


def parts_between_blanks(values: np.ndarray, a: int, b: int, limit: int) -> Iterator[tuple[int, int]]:
    """Parts [x, y) of the text values[a:b] that end after white space, of about ``limit`` bytes each."""
    while a < b:
        end = min(a + limit, b)
        while end < b:
            blank = np.flatnonzero(_SPACE[values[end - 1: min(end - 1 + limit, b)]])
            if len(blank):
                end += int(blank[0])
                break
            end = min(end + limit, b)
        yield a, end
        a = end


def words_between_blanks(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, document) of every run without white space."""
    a, b = int(offsets[0]), int(offsets[-1])
    word = ~_SPACE[values[a:b]]
    edge = np.ones(len(word) + 1, bool)               # a word may begin here, or has ended
    edge[1:-1] = ~word[:-1]
    edge[offsets[(offsets >= a) & (offsets <= b)] - a] = True
    start = np.flatnonzero(word & edge[:-1])
    last = np.zeros(len(word) + 1, bool)
    last[1:] = word
    close = np.ones(len(word) + 1, bool)
    close[:-1] = ~word
    close[offsets - a] = True
    end = np.flatnonzero(last & close)
    doc = np.searchsorted(offsets - a, start, side="right") - 1
    return start + a, end - start, doc


def _counts(path: str | None):
    def counts(arr: pa.Array) -> pa.Array:
        m = automaton(path or vocabulary_path())
        values, offsets = binary_views(arr)
        words, pieces = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in doc_slices(offsets, PART_BYTES):
            texts = [offsets[i: j + 1]]
            if j == i + 1 and offsets[j] - offsets[i] > PART_BYTES:
                texts = (np.array(p) for p in parts_between_blanks(values, int(offsets[i]), int(offsets[j]), PART_BYTES))
            n_words, n_pieces = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
            for t in texts:
                start, length, doc = words_between_blanks(values, t)
                n_words += np.bincount(doc, minlength=j - i)
                n_pieces += np.bincount(doc, piece_counts(m, values, start, length), j - i).astype(np.int64)
            words.append(n_words)
            pieces.append(n_pieces)
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(words), pa.int64()), pa.array(np.concatenate(pieces), pa.int64())],
            names=["n_words", "n_tokens"])
    return counts


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_words, n_tokens.

    Null and empty texts have none of them. Repeated rows are counted each; ids
    may be null; other columns are ignored; an empty table gives no rows. Very
    long texts are read in parts between blanks, very long words whole.
    ``vocabulary`` is the path of a file of base64 pieces that every executor has.
    """
    counted = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text_bytes(text_col)).cast("long").alias("n_bytes"),
                          F.arrow_udf(_counts(vocabulary), "n_words long, n_tokens long")(text_bytes(text_col)).alias("c"))
    return counted.select("doc_id", "n_bytes", "c.n_words", "c.n_tokens")
