"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from typing import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersmith.llm import byte_bpe, whitening
from ordersmith.llm.decontamination import contamination
from ordersmith.llm.exact_dedup import exact_dedup
from ordersmith.llm.fill_in_middle import fill_in_middle, restore
from ordersmith.llm.language import predict as predict_language
from ordersmith.llm.near_dedup import near_dedup
from ordersmith.llm.packing import pack
from ordersmith.llm.quality import score_quality
from ordersmith.llm.token_counts import token_counts
from ordersmith.llm.toxicity import score_toxicity
from ordersmith.llm.url_filter import judge
from ordersmith.llm.warc import archive

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_BLANKS = "chr(32), ''), chr(9), ''), chr(10), ''), chr(11), ''), chr(12), ''), chr(13), ''"


@register("op3_exact_dedup", f"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
             replace(replace(replace(replace(replace(replace(coalesce(text, ''), {_BLANKS}) AS norm FROM documents),
g AS (SELECT norm, first(doc_id ORDER BY points DESC, doc_id NULLS LAST) AS keep_id, count(*) AS group_size
      FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)""")
def op3(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op9_near_dedup")
def op9(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "documents")).drop("uid")


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


@register("op5_decontamination", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hit AS (SELECT DISTINCT r, i, k, item_id FROM dw JOIN bw USING (k, g)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS s
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r)""")
def op5(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


@register("op6_packing")
def op6(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@register("op1_quality")
def op1(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_language_id")
def op7(spark, sf_dir):
    return predict_language(table(spark, sf_dir, "documents")).drop("probs")


@register("op8_toxicity")
def op8(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_token_counts")
def op2(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@register("op4_url_filter", f"""
WITH r(rh, rp, v) AS (VALUES {", ".join(map(str, URL_RULES))}),
p AS (SELECT row_number() OVER () AS i, page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
f AS (SELECT i, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS verdict
      FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY i)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f USING (i)""")
def op4(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


@register("op10_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, strlen(t) AS b, upper(sha1(t)) AS x FROM p),
n AS (SELECT page_id, b, x, list_transform(range(8), lambda i: CAST('0x' || substr(x, CAST(i * 5 + 1 AS BIGINT), 5) AS BIGINT)) AS c FROM h),
d AS (SELECT page_id, b, array_to_string(list_transform(c, lambda v:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 32768) % 32 + 1, 1) ||
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 1024) % 32 + 1, 1) ||
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 32) % 32 + 1, 1) ||
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1)), '') AS g FROM n),
f AS (SELECT g, min(page_id) AS first FROM d GROUP BY g)
SELECT page_id, b AS payload_bytes, g AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d JOIN f USING (g)""")
def op10(spark, sf_dir):
    return archive(table(spark, sf_dir, "pages")).select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op11_whitening")
def op11(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    rows = whitening.transform(vectors, model)
    error = whitening.identity_error(rows, model)
    explained = F.lit([float(e) for e in model.explained] or [0.0])
    # a deviation beyond a long, which the operator gives as a decimal, is null here
    return rows.select("vec_id", F.expr("try_cast(deviation as bigint)").alias("deviation"),
                       F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


_DRAW = "CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), {}, 8) AS BIGINT)"
_UNITS = "array_to_string(u[{}:{}], '')"


@register("op12_fill_in_middle", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  {", ".join(f"{_DRAW.format(1 + 8 * i)} AS h{i + 1}" for i in range(4))} FROM documents),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
             greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, n, form, t, {_UNITS.format(1, 'a')} AS prefix, {_UNITS.format('a + 1', 'b')} AS middle,
             {_UNITS.format('b + 1', 'n')} AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""")
def op12(spark, sf_dir):
    done = fill_in_middle(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


@register("op13_byte_bpe")
def op13(spark, sf_dir):
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(byte_bpe.decode(F.col("ids")), 256).alias("decoded_sha256"))


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
