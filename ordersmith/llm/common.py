"""Shared helpers: staged tables, row identity and Arrow text batches."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersmith.session import checkpoint_dir

#: Bytes of text that a task turns into arrays at a time (a longer text is cut between words).
SLICE_BYTES = 1 << 17

#: Bytes of rows that staging sends to a Python worker at a time (or one row), unless the session names a number.
BATCH_BYTES = 4 << 20

#: Paths staged for an owner (see ``staged_for``), by its name.
_STAGED: dict[str, list[str]] = {}
_OWNER: ContextVar[str | None] = ContextVar("owner", default=None)


def stage(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage to files that every executor sees, so later jobs agree on
    row identities however often tasks are lost and run again. Rows go to
    Python workers in batches of ``BATCH_BYTES``, since Spark's own of 10,000
    rows hold whole partitions of texts several times over in both processes.
    """
    spark = df.sparkSession
    path = staged_path(spark, tag)
    w = df.write
    if partition_by:
        w = w.partitionBy(partition_by)
    with _small_batches(spark):
        w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _small_batches(spark: SparkSession):
    """Writes inside use batches of ``BATCH_BYTES``; a number that the session sets itself holds."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key)


def staged_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/ordersmith-llm/{tag}-{uuid.uuid4().hex}"
    if owner := _OWNER.get():
        _STAGED.setdefault(owner, []).append(path)
    return path


@contextmanager
def staged_for(owner: str):
    """What is staged inside belongs to ``owner`` and goes with ``release_staged``."""
    token = _OWNER.set(owner)
    try:
        yield
    finally:
        _OWNER.reset(token)


def release_staged(spark: SparkSession, owner: str) -> None:
    """Delete what was staged for ``owner``; results that still read it must have been written."""
    for name in _STAGED.pop(owner, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until no column in ``taken`` has it (Spark ignores case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def _one_scan(docs: DataFrame) -> bool:
    """Whether every row of ``docs`` is one row of one file table: a scan under projections and filters alone, all of
    them the same whenever they are computed."""
    node = docs._jdf.queryExecution().analyzed()
    while True:
        kind = node.getClass().getSimpleName()
        if kind == "LogicalRelation":
            relation = node.relation()
            if relation.getClass().getSimpleName() != "HadoopFsRelation":
                return False
            roots = [str(relation.location().rootPaths().apply(i)).rstrip("/") + "/"
                     for i in range(relation.location().rootPaths().size())]
            return not any(i != j and a.startswith(b) for i, a in enumerate(roots) for j, b in enumerate(roots))
        if kind not in ("Project", "Filter", "SubqueryAlias", "View"):
            return False
        made = node.expressions()
        if any(not made.apply(i).deterministic() or "SubqueryExpression" in made.apply(i).getClass().getName()
               for i in range(made.size())):
            return False
        node = node.children().apply(0)


def with_uid(docs: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``docs`` with one unique value a row (ids may be null or repeated), and that column's name.

    Rows of one file table are known by (hash of the file's path, place in the
    file), which holds however the files are split into tasks. What joins,
    unions, explodes, limits or draws at random is staged first, as one row of a
    file may be several rows of it, or another one when it is computed again.
    """
    uid = fresh("row_uid", docs.columns)
    if not _one_scan(docs):
        docs = stage(docs, tag)
    meta = docs.metadataColumn("_metadata")
    return docs.withColumn(uid, F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("row"))), uid


def text_bytes(col: str = "text") -> Column:
    """The column's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def binary_views(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array without copying, and its n + 1 offsets (no nulls allowed)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    kind = np.int64 if pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type) else np.int32
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, kind)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64) if off else \
        np.zeros(len(arr) + 1, np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values, offsets


def doc_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents of at most ``limit`` bytes together (a longer document is a run of its own)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element by element."""
    x = np.asarray(x, dtype=np.uint64) + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every c of ``counts``, joined."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts)


def list_array(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list array from joined values and the lists' lengths."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def hashed_bitmap(hashes: DataFrame, bits_log2: int = 23) -> np.ndarray:
    """A bitmap of 2**bits_log2 bits with the bits of the hashes in ``hashes`` (one long column) set.

    Its size is fixed whatever the table's size, so it may go through the
    driver; a fuller bitmap only lets more rows pass.
    """
    pos = F.col(hashes.columns[0]).bitwiseAND(F.lit((1 << bits_log2) - 1))
    words = (hashes.filter(F.col(hashes.columns[0]).isNotNull())
             .select(F.shiftright(pos, 6).alias("w"), pos.alias("p"))
             .select("w", F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b"))).toArrow()
    out = np.zeros(1 << (bits_log2 - 6), np.uint64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy().astype(np.int64).view(np.uint64)
    return out


def probe_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the hashes' bits are set."""
    pos = hashes & _U(len(bitmap) * 64 - 1)
    return ((bitmap[(pos >> _U(6)).astype(np.int64)] >> (pos & _U(63))) & _U(1)).astype(bool)
