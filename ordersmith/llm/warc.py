"""WARC archives of crawled pages, and their merged capture index.

``write_archives`` writes a record a page: a response with the payload, or a
revisit that refers to the response with an equal payload. ``read_archives``
parses the files again, record by record by their lengths. The capture index
is an external merge: every archive's entries are a run, sorted by URL key and
time where the archive is read; ranges of keys are dealt to tasks, and a loser
tree merges each range's runs, so that all histories come out in order.

Scale: payloads are shuffled only if some equal ones exist and their digests
are too many to broadcast. Records are written by size, the fewer to a file the
longer they are, so that a file keeps below ``FILE_BYTES`` unless one record
alone exceeds it. The index moves without payloads, a URL with very many
captures is split by time, and a merge holds its range as Arrow batches, of
which each run turns a few rows at a time into Python objects.
"""

from __future__ import annotations

import base64
import hashlib
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordersmith.llm.common import stage, staged_path, with_uid

RECORDS_PER_FILE = 4096
#: Payload bytes of a file (a record of more has a file of its own), and so of what a task reads whole.
FILE_BYTES = 1 << 28
MIN_BYTES = 0
#: WARC-Date of pages without a time of their own.
DATE = "2000-01-01T00:00:00Z"
_END = "\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column: five hexadecimal digits are four of base 32."""
    digits = F.array(*[F.lpad(F.conv(F.substring(F.sha1(payload), i * 5 + 1, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(F.array_join(digits, ""), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(digest: Column, uid: Column) -> Column:
    h = F.md5(F.concat_ws(" ", digest, uid.cast("string")).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line ends within it are written %0D and %0A."""
    safe = value.cast("string")
    for c in "\r\n":
        safe = F.replace(safe, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _size_classes(records_per_file: int, file_bytes: int) -> list[tuple[int, int]]:
    """(longest payload, records a file) by rising size; the last class takes every longer payload too."""
    out, records = [], records_per_file
    while records > 1:
        out.append((file_bytes // records, records))
        records //= 4
    return [*out, (file_bytes, 1)]


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   date_col: str | None = None, min_bytes: int = MIN_BYTES,
                   records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES) -> None:
    """Write a record a page into archives under ``path``, a folder for each class of payload sizes that occurs.

    Null payloads are empty. Of records with equal payloads of at least
    ``min_bytes`` bytes that with the smallest id (null ids last, then the
    first in storage) is the response, the others revisit it; smaller ones are
    all responses. Null urls and ids have no header.
    """
    rows, uid = with_uid(pages, "warc-rows")
    rows = rows.select(
        F.col(uid).alias("uid"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"),
        (F.coalesce(F.date_format(F.col(date_col).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(DATE))
         if date_col else F.lit(DATE)).alias("date"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long"))
    classes = _size_classes(records_per_file, file_bytes)
    size = F.lit(len(classes) - 1)
    for i, (longest, _) in reversed(list(enumerate(classes[:-1]))):
        size = F.when(F.col("bytes") <= longest, i).otherwise(size)
    rows = rows.withColumn("size", size).withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
    first = F.min(F.struct(F.col("page_id").isNull().alias("z"), "page_id", "uid"))
    seen = Observation()                                   # which classes occur: the same if a task runs twice
    several = stage(rows.observe(seen, F.bit_or(F.expr("shiftleft(1, size)")).alias("sizes"))
                    .filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), first.alias("first")).filter("n > 1")
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.uid").alias("first_uid")),
        "warc-equal")
    joined = rows.join(several, "digest", "left")
    revisit = F.col("first_uid").isNotNull() & (F.col("first_uid") != F.col("uid")) & (F.col("bytes") >= min_bytes)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    kind = F.when(revisit, "revisit").otherwise("response")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", kind),
        _header("WARC-Record-ID", _record_id(F.col("digest"), F.col("uid"))),
        _header("WARC-Target-URI", F.col("url")), _header("WARC-Date", F.col("date")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(
            _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _header("WARC-Refers-To", _record_id(F.col("digest"), F.col("first_uid"))),
            _header("X-Refers-To-Page", F.col("first_id")))).otherwise(""),
        _header("X-Page-ID", F.col("page_id")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"))
    written = joined.withColumn("block", block).select("size", F.concat(head, "block").alias("value"))
    occur = seen.get["sizes"] or 1                          # an empty table is one empty archive
    for i, (_, most) in enumerate(classes):
        if occur >> i & 1:
            (written.filter(F.col("size") == i).select("value").write.option("lineSep", _END)
             .option("maxRecordsPerFile", most).text(f"{path}/size-{i}"))


def records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive, taken by their lengths."""
    at = 0
    while at < len(content):
        head_end = content.index(b"\r\n\r\n", at)
        lines = content[at: head_end].decode("utf-8").split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start = head_end + 4
        end = start + int(headers["Content-Length"])
        yield at, end + 4 - at, headers, content[start: end]
        at = end + 4


def url_key(url: str) -> str:
    """The url with its host's labels reversed, for sorting: ``com,example,www)/path``."""
    _, found, rest = url.partition("://")
    if not found:
        return url
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host = rest[:cut].translate(_LOWER)
    return ",".join(reversed(host.split("."))) + ")" + rest[cut:]


_LOWER = {c: c + 32 for c in range(65, 91)}
INDEX = ("url_key string, timestamp string, page long, run string, offset long, length long, url string, "
         "record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean")
_NAMES = [x.strip().split()[0] for x in INDEX.split(",")]
_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_SCHEMA = pa.schema([(x.split()[0], _KINDS[x.split()[1]]) for x in INDEX.split(", ")])


def _order(row: tuple) -> tuple:
    """Sorting key of an index entry: URL key, time, then where it is."""
    return row[0], row[1], row[3], row[4]


def _entries(run: str, content: bytes) -> list[tuple]:
    out = []
    for offset, length, h, block in records(content):
        payload = block[block.index(b"\r\n\r\n") + 4:]
        http = dict(x.split(": ", 1) for x in block[: block.index(b"\r\n\r\n")].decode().split("\r\n")[1:])
        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = h["WARC-Type"]
        url = h.get("WARC-Target-URI")
        intact = kind == "revisit" or base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
        size = len(payload) if kind == "response" else int(http["Content-Length"])
        time = "".join(c for c in h["WARC-Date"] if c.isdigit())
        number = lambda name: int(h[name]) if name in h else None
        out.append((url_key(url or ""), time, number("X-Page-ID"), run, offset, length, url, kind, size, digest,
                    number("X-Refers-To-Page"), intact))
    return sorted(out, key=_order)


def _batches(rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for r in rows:
        part.append(r)
        if len(part) == size:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part), _SCHEMA)], schema=_SCHEMA)
            part = []
    if part:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part), _SCHEMA)], schema=_SCHEMA)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of all archives under ``path``; each archive's rows are a run in order."""
    def read(batches):
        for b in batches:
            for run, content in zip(b.column("path"), b.column("content")):
                yield from _batches(_entries(run.as_py(), content.as_py()))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True)
             .load(path))
    return files.select("path", "content").mapInArrow(read, INDEX)


class LoserTree:
    """Merge of sorted runs: a match at every inner node, whose loser stays there until its winner is replaced."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.head = [self._next(i) for i in range(len(runs))]
        self.losers = [0] * max(len(runs), 1)
        self.winner = self._play(1) if len(runs) > 1 else 0

    def _next(self, i: int) -> tuple:
        row = next(self.runs[i], None)
        return (1,) if row is None else (0, _order(row), i, row)      # an ended run loses to all others

    def _play(self, node: int) -> int:
        if node >= len(self.runs):
            return node - len(self.runs)
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if self.head[b][:3] < self.head[a][:3]:
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and not self.head[self.winner][0]:
            w = self.winner
            yield self.head[w][3]
            self.head[w] = self._next(w)
            node = (w + len(self.runs)) // 2
            while node:
                if self.head[self.losers[node]][:3] < self.head[w][:3]:
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def _rows(parts: list[pa.RecordBatch], size: int = 64) -> Iterator[tuple]:
    """The rows of a run, a few at a time as Python objects."""
    for part in parts:
        for a in range(0, part.num_rows, size):
            yield from zip(*(c.to_pylist() for c in part.slice(a, size).columns))


def _merged(batches):
    """Rows sorted by run, then in order: merged into one order, with a number that rises over all tasks."""
    runs: list[list[pa.RecordBatch]] = []
    last = None
    for b in batches:
        b = b.select(_NAMES)
        run = b.column("run")
        turns = pc.not_equal(run.slice(1), run.slice(0, max(b.num_rows - 1, 0))).to_numpy(zero_copy_only=False)
        ends = [*(np.flatnonzero(turns) + 1).tolist(), b.num_rows]
        for a, e in zip([0, *ends], ends):
            if a < e:
                if run[a].as_py() != last:
                    runs.append([])
                    last = run[a].as_py()
                runs[-1].append(b.slice(a, e - a))
    at = TaskContext.get().partitionId() << 40
    for out in _batches(LoserTree([_rows(r) for r in runs])):
        order = pa.array(range(at, at + out.num_rows), pa.int64())
        at += out.num_rows
        yield pa.record_batch([*out.columns, order], names=[*_NAMES, "position"])


def capture_index(entries: DataFrame) -> DataFrame:
    """All entries in one order of URL key and time: ``position`` rises with it over the whole index."""
    runs = stage(entries, "warc-runs")
    return (runs.repartitionByRange("url_key", "timestamp", "run", "offset")
            .sortWithinPartitions("run", "url_key", "timestamp", "offset").mapInArrow(_merged, INDEX + ", position long"))


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as archives (into a fresh folder of the shared one unless ``path`` is given), read them back
    and return their capture index: one row a page, ``page`` its id. An empty table gives no rows; other columns of
    ``pages`` are ignored; repeated rows get a record each. Ids are whole numbers or null. A very long payload is a
    record like any other, in a file of its own; it has to fit into a task's memory."""
    path = path or staged_path(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return capture_index(read_archives(pages.sparkSession, path))
