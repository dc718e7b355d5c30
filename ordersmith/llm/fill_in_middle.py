"""Fill-in-the-middle reordering of texts cut between lines.

Both cuts are ranks among a text's units (lines). An indexable skip list finds
where they lie: a unit is promoted to an express lane by the hash of its rank,
one in 64 from lane to lane, and every express node carries the units and the
code points (and bytes) up to the next node of its lane. Going along a lane
while the accumulated units stay within the rank, then down, reaches the cut
with its exact place in code points. The bottom lane is the text itself: only
the units behind the lowest express node are read again.

Scale: one pass without a shuffle. A text is read in slices; the lanes of a text
of nothing but line ends take less room than the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import mix64, text_bytes

#: Markers before prefix, suffix and middle (fixed values of the contract).
MARKERS = ("<P>", "<S>", "<M>")
_PROMOTE = 6            # bits of the hash that must be zero from lane to lane
_SLICE = 1 << 20
_FORMS = ("plain", "psm", "spm")


def code_points(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: all bytes but continuations."""
    return sum(int(np.count_nonzero((data[a: a + _SLICE] & 0xC0) != 0x80)) for a in range(0, len(data), _SLICE))


class SkipList:
    """Units (runs up to and with a line end, and what follows the last one) of UTF-8 bytes."""

    def __init__(self, text: bytes, end: int = 10):
        self.text, self.end = text, bytes([end])
        data = np.frombuffer(text, np.uint8)
        rank, byte, point = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        units = points = 0
        for a in range(0, len(data), _SLICE):
            part = data[a: a + _SLICE]
            ends = np.flatnonzero(part == end)
            before = np.cumsum((part & 0xC0) != 0x80)            # code points up to and with each byte
            ranks = units + 1 + np.arange(len(ends))             # of the units that begin behind these ends
            up = np.flatnonzero((mix64(ranks) & np.uint64((1 << _PROMOTE) - 1)) == 0)
            rank.append(ranks[up])
            byte.append(a + 1 + ends[up])
            point.append(points + before[ends[up]])
            units += len(ends)
            points += int(before[-1])
        self.units = units + (len(text) > 0 and text[-1] != end)
        self.points = points
        rank, byte, point = np.concatenate(rank), np.concatenate(byte), np.concatenate(point)
        inside = rank < self.units                               # nothing begins behind a last line end
        inside[0] = True
        rank, byte, point = rank[inside], byte[inside], point[inside]
        height = mix64(rank)
        height[0] = 0                                            # the head stands in every lane
        #: Lanes from the lowest express lane up: widths in units, code points and bytes, and places in the lane below.
        self.lanes, at, bits = [], np.arange(len(rank)), _PROMOTE
        while True:
            widths = [np.diff(v[at], append=total) for v, total in
                      ((rank, self.units), (point, points), (byte, len(text)))]
            below = np.searchsorted(self._at, at) if self.lanes else None
            self.lanes.append((*widths, below))
            self._at = at
            bits += _PROMOTE
            up = at[(height[at] & np.uint64((1 << min(bits, 63)) - 1)) == 0]
            if len(up) == len(at) or len(at) == 1:
                break
            at = up

    def descend(self, rank: int) -> tuple[int, int]:
        """(code points, bytes) of the first ``rank`` units."""
        if rank >= self.units:
            return self.points, len(self.text)
        units = points = at = node = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            unit_width, point_width, byte_width, below = self.lanes[level]
            while units + unit_width[node] <= rank:
                units += int(unit_width[node])
                points += int(point_width[node])
                at += int(byte_width[node])
                node += 1
            if below is not None:
                node = int(below[node])
        start = at
        for _ in range(rank - units):                            # the bottom lane
            at = self.text.index(self.end, at) + 1
        return points + code_points(np.frombuffer(self.text, np.uint8)[start:at]), at


def _whole(markers: tuple[str, str, str]) -> tuple[bytes, bytes, bytes]:
    """The markers as bytes; no end of one may begin another, else a text's end could complete one."""
    m = tuple(x.encode() for x in markers)
    if len({*m}) < 3 or not all(m) or any(
            x.endswith(y[:i]) for x in m for y in m for i in range(1, len(y) + (x != y))):
        raise ValueError(f"markers {markers} overlap")
    return m


def rearranged(text: bytes, h: tuple[int, int, int, int], rate: int, spm: int,
               markers: tuple[bytes, bytes, bytes]) -> tuple[int, int, int | None, int | None, bytes]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    units = SkipList(text)
    n = units.units
    if not text or h[2] % 100 >= rate or any(m in text for m in markers):
        return n, 0, None, None, text
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (p1, b1), (p2, b2) = units.descend(lo), units.descend(hi)
    prefix, middle, suffix = text[:b1], text[b1:b2], text[b2:]
    p, s, m = markers
    if h[3] % 100 < spm:
        return n, 2, p1, p2 - p1, b"".join([s, suffix, p, prefix, m, middle])
    return n, 1, p1, p2 - p1, b"".join([p, prefix, s, suffix, m, middle])


def _rearrange(rate: int, spm: int, markers: tuple[bytes, bytes, bytes]):
    def run(text: pa.Array, h: pa.Array) -> pa.Array:
        rows = [rearranged(t.as_py(), tuple(x.as_py()), rate, spm, markers) for t, x in zip(text, h)]
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([_FORMS[r[1]] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
             pa.array([r[4] for r in rows], pa.binary())],
            names=["n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def draws(doc_id: Column, seed: int) -> Column:
    """Four numbers below 2**32 from the hash of seed and id (a null id counts as no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100,
                   spm: int = 50, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """One row a document: doc_id, n (lines), form, prefix_chars, middle_chars, output (the reordered text as UTF-8).

    ``rate`` percent of the documents are reordered, ``spm`` percent of these
    suffix first. A text that is null or empty, or holds a marker, stays as it
    is (form plain, no lengths). Equal rows give equal results, and rows of one
    id cut at the same draws; ids may be null; other columns are ignored; an
    empty table gives no rows. Very long texts and lines are read whole, in
    slices, and held as often as the result needs them (text and output).
    """
    udf = F.arrow_udf(_rearrange(rate, spm, _whole(markers)),
                      "n long, form string, prefix_chars long, middle_chars long, output binary")
    done = docs.select(F.col(id_col).alias("doc_id"), udf(text_bytes(text_col), draws(F.col(id_col), seed)).alias("r"))
    return done.select("doc_id", "r.*")


def restored(form: str, output: bytes, markers: tuple[bytes, bytes, bytes]) -> bytes:
    """The text from which ``rearranged`` made ``output``."""
    p, s, m = markers
    if form == "plain":
        return output
    first, second = (p, s) if form == "psm" else (s, p)
    two = output.index(second, len(first))
    three = output.index(m, two + len(second))
    a, b, middle = output[len(first):two], output[two + len(second):three], output[three + len(m):]
    return a + middle + b if form == "psm" else b + middle + a


def restore(form: Column, output: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The exact text (UTF-8) from the form and output of ``fill_in_middle`` alone."""
    m = _whole(markers)

    @F.arrow_udf("binary")
    def run(form: pa.Array, output: pa.Array) -> pa.Array:
        return pa.array([restored(f.as_py(), o.as_py(), m) for f, o in zip(form, output)], pa.binary())
    return run(form, output)
