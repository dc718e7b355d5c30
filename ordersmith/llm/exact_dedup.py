"""Exact dedup by deterministic block naming.

A text without white space is cut into blocks of a fixed number of bytes. All
blocks are sorted and every distinct one gets an integer name; then adjacent
pairs of names are sorted and named in turn, until one name is left a
document. Equal (rounds, name) means equal texts: contents are compared,
never only hashes.

Scale: a task sends each distinct block once, so a text held by a third of all
rows reaches the sort once a task. After the first round only integers move.
Positions of one very long text are rows of their own and spread over tasks.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersmith.llm.common import stage, text_bytes, with_uid

#: Bytes that equality ignores: [\x20\x09-\x0D].
BLANKS = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 8192
#: Blocks that a task remembers before it begins anew, in bytes.
REMEMBERED_BYTES = 64 << 20


def _cut(block_bytes: int):
    def cut(batches):
        base, count = TaskContext.get().partitionId() << 40, 0
        seen: dict[bytes, int] = {}
        held = 0
        for b in batches:
            new, reps, shas = [], [], []
            for t in b.column("text"):
                x = t.as_py().translate(None, BLANKS)
                shas.append(hashlib.sha256(x).hexdigest())
                own = []
                for i in range(0, max(len(x), 1), block_bytes):
                    block = x[i: i + block_bytes]
                    rep = seen.get(block)
                    if rep is None:
                        if held > REMEMBERED_BYTES:
                            seen.clear()
                            held = 0
                        rep = seen[block] = base + count
                        count += 1
                        held += len(block)
                        new.append((rep, block))
                    own.append(rep)
                reps.append(own)
            docs = pa.record_batch([
                b.column("uid"), b.column("doc_id"), b.column("points"), pa.array(shas, pa.string()),
                pa.array(reps, pa.list_(pa.int64())), pa.nulls(len(shas), pa.int64()), pa.nulls(len(shas), pa.binary())],
                names=["uid", "doc_id", "points", "sha", "reps", "rep", "content"])
            yield docs
            for i in range(0, len(new), 2000):
                part = new[i: i + 2000]
                none = [pa.nulls(len(part), f.type) for f in docs.schema][:5]
                yield pa.record_batch(none + [pa.array([r for r, _ in part], pa.int64()),
                                              pa.array([c for _, c in part], pa.binary())], names=docs.schema.names)
    return cut


def _name_sorted(batches):
    """Names rows sorted by content: equal contents get one integer, unique over all tasks."""
    base, rank, last = TaskContext.get().partitionId() << 40, -1, None
    for b in batches:
        names = []
        for c in b.column("content"):
            c = c.as_py()
            if c != last:
                rank, last = rank + 1, c
            names.append(base + rank)
        yield pa.record_batch([b.column("rep"), pa.array(names, pa.int64())], names=["rep", "name"])


def block_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES, uid: str | None = None) -> DataFrame:
    """One row a document: uid, doc_id, points, sha, and the identity (level, name) of its text without blanks."""
    if uid is None:
        docs, uid = with_uid(docs, "dedup-rows")
    rows = docs.select(F.col(uid).alias("uid"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("points"),
                       text_bytes(text_col).alias("text"))
    kinds = rows.schema
    out = T.StructType([kinds["uid"], kinds["doc_id"], kinds["points"], T.StructField("sha", T.StringType()),
                        T.StructField("reps", T.ArrayType(T.LongType())), T.StructField("rep", T.LongType()),
                        T.StructField("content", T.BinaryType())])
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in out])
    cut = stage(rows.mapInArrow(_cut(block_bytes), out), "dedup-blocks")

    contents = cut.filter(F.col("rep").isNotNull()).select("rep", "content")
    names = (contents.repartition(F.xxhash64("content")).sortWithinPartitions("content")
             .mapInArrow(_name_sorted, "rep long, name long"))
    names = stage(names, "dedup-names")

    entries = cut.filter(F.col("reps").isNotNull()).drop("rep", "content").withColumn("n", F.size("reps"))
    most = entries.agg(F.max("n")).first()[0] or 1
    done = [entries.filter("n = 1").withColumn("rep", F.col("reps")[0]).join(names, "rep")
            .select("uid", F.lit(0).alias("level"), "name")]
    open_ = (entries.filter("n > 1").select("uid", "n", F.posexplode("reps").alias("pos", "rep"))
             .join(names, "rep").select("uid", "n", "pos", "name"))
    level = 0
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        pairs = stage(
            open_.groupBy("uid", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                 F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"))
            .withColumn("n", ((F.col("n") + 1) / 2).cast("int")), f"dedup-pairs{level}")
        names = stage(pairs.select("left", "right").distinct().sortWithinPartitions("left", "right")
                      .withColumn("name", F.monotonically_increasing_id()), f"dedup-names{level}")
        named = pairs.join(names, ["left", "right"]).select("uid", "n", "pos", "name")
        done.append(named.filter("n = 1").select("uid", F.lit(level).alias("level"), "name"))
        open_ = named.filter("n > 1")
    ids = done[0]
    for d in done[1:]:
        ids = ids.unionByName(d)
    return entries.select("uid", "doc_id", "points", "sha").join(ids, "uid")


def _preferred() -> Column:
    """Most code points first, then the smallest id (null ids last)."""
    return F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("z"), "doc_id", "uid")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, uid: str | None = None) -> DataFrame:
    """One row a document: uid, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without blanks (null counts as empty, so
    null and blank texts are one group). Of a group the row with the most code
    points in its original text stays, then the smallest id, null ids last; of
    rows alike in both, the first in storage. Other columns are ignored. An
    empty table gives no rows. ``uid`` names a column of ``docs`` that tells rows apart.
    """
    ids = stage(block_identities(docs, id_col, text_col, block_bytes, uid), "dedup-ids")
    # staged, so that the join reads both sides by plain exchanges and Spark can split a hot group
    best = stage(ids.groupBy("level", "name").agg(F.min(_preferred()).alias("best"),
                                                  F.count(F.lit(1)).alias("group_size")), "dedup-best")
    return ids.join(best, ["level", "name"]).select(
        "uid", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.uid") == F.col("uid")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with the columns of ``docs``, whatever their names.

    Of null, empty and blank texts one row stays, of repeated rows one; ids may
    be null; an empty table stays empty. Very long texts are cut into blocks
    and compared whole.
    """
    rows, uid = with_uid(docs, "dedup-kept")
    gone = exact_dedup(rows, id_col, text_col, uid=uid).filter("not kept").select(F.col("uid").alias(uid))
    return rows.join(gone, uid, "left_anti").select(*docs.columns)
