"""URL rules: a blocked Bloom filter passes possible hits to an exact hash join.

A rule lists a host and the beginning of a path. The canonical keys of a URL are
every host it belongs to (its own and those it is a subdomain of), each with
every beginning of its path that is as long as some rule's path. Each key's
hash picks one 512-bit block of the filter and six bits in it; keys whose bits
are all set are joined with the rules by their text, which removes false hits.
The longest rule that fits decides.

Scale: the filter's size is fixed by ``blocks_log2``; a larger list only lets
more keys through to the join. Pages without a possible hit carry no key into it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.llm.common import with_uid

BLOCKS_LOG2 = 13
BITS = 6
#: Between host and path of a key: neither of a page's holds it, so equal keys are equal hosts and paths.
_CUT = "#"
_U = np.uint64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: str = "url") -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _bits(hashes: np.ndarray, blocks_log2: int) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, bits), each of shape (BITS, n): six bits within the hash's block of eight 64-bit words."""
    block = hashes >> _U(64 - blocks_log2)
    x, words, bits = hashes, [], []
    for _ in range(BITS):
        x = x * _U(0x9E3779B97F4A7C15) + _U(0x7F4A7C15)
        at = x >> _U(55)                                             # 0..511
        words.append((block << _U(3)) + (at >> _U(6)))
        bits.append(_U(1) << (at & _U(63)))
    return np.array(words).astype(np.int64), np.array(bits)


def bloom_filter(keys: DataFrame, blocks_log2: int = BLOCKS_LOG2) -> np.ndarray:
    """The filter of a column ``key``: 2**blocks_log2 blocks of 512 bits, set in the tasks and joined by bitwise or."""
    def words(batches):
        for b in batches:
            w, bits = _bits(b.column("h").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), blocks_log2)
            yield pa.record_batch([pa.array(w.ravel()), pa.array(bits.ravel().view(np.int64))], names=["w", "b"])
    found = (keys.select(F.xxhash64("key").alias("h")).mapInArrow(words, "w long, b long")
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())          # at most 8 * 2**blocks_log2 rows
    out = np.zeros(8 << blocks_log2, np.uint64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().astype(np.int64).view(np.uint64)
    return out


def _possible(bloom: np.ndarray, blocks_log2: int):
    def possible(hashes: pa.Array) -> pa.Array:
        h = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        w, bits = _bits(h, blocks_log2)
        hit = ((bloom[w] & bits) == bits).all(axis=0) if len(h) else np.zeros(0, bool)
        return pa.ListArray.from_arrays(pa.array(np.asarray(hashes.offsets) - hashes.offsets[0].as_py(), pa.int32()),
                                        pa.array(hit))
    return possible


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", blocks_log2: int = BLOCKS_LOG2) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict. A rule fits its host and that host's
    subdomains where the url's path begins with its path; the longest text of
    host and path decides, then the longer host, then ``block`` of a rule
    listed twice. A url that isn't listed gets ``default``. Rules without a
    host fit nothing, a null path counts as empty. Pages may have null urls
    (empty host and path, no rule), null or repeated ids; other columns are
    ignored. Empty tables give no rows or no rules.
    """
    listed = (rules.select(F.translate("host", _UPPER, _LOWER).alias("rule_host"),
                           F.coalesce("path", F.lit("")).alias("rule_path"), F.col("verdict").alias("rule_verdict"))
              .filter("rule_host != ''")
              .groupBy(F.concat("rule_host", F.lit(_CUT), "rule_path").alias("key"), F.length("rule_host").alias("host_length"))
              .agg(F.max("rule_verdict").alias("rule_verdict"), F.first("rule_path").alias("rule_path")))
    lengths = [r[0] for r in listed.select(F.length("rule_path")).distinct().collect()]   # a number for each path length
    bloom = bloom_filter(listed.select("key"), blocks_log2)

    rows, uid = with_uid(pages, "url-rows")
    rows = rows.select(F.col(uid).alias("uid"), F.col(id_col).alias("page_id"),
                       url_host(url_col).alias("host"), url_path(url_col).alias("path"))
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.transform(F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"),
                                  lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda p: F.concat(h, F.lit(_CUT), p))))
    probe = F.arrow_udf(_possible(bloom, blocks_log2), "array<boolean>")
    probed = (rows.withColumn("keys", keys).withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k)))
              .withColumn("hit", probe("hashes")))
    possible = F.transform(F.filter(F.arrays_zip("keys", "hit"), lambda x: x["hit"]), lambda x: x["keys"])
    asked = probed.select("uid", "page_id", "host", "path", F.explode_outer(possible).alias("key"))
    joined = asked.join(listed.select("key", "host_length", "rule_verdict"), "key", "left")
    best = F.max(F.when(F.col("rule_verdict").isNotNull(),
                        F.struct(F.length("key").alias("n"), "host_length", "key", "rule_verdict")))
    return (joined.groupBy("uid", "page_id", "host", "path").agg(best.alias("best"))
            .select("page_id", "host", "path", F.replace("best.key", F.lit(_CUT), F.lit("")).alias("rule"),
                    F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict")))
