"""Row identity: one result row for every input row, whatever made the input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordersmith.llm import decontamination, exact_dedup, near_dedup, url_filter, warc
from ordersmith.llm.common import with_uid

TEXTS = [f"{w} some words of a text that is long enough to hold five of them {w} and {w} more {i}"
         for i, w in enumerate(["river", "stone", "cloud", "paper", "light", "glass"])]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored"))
    rows = [(i, TEXTS[i % len(TEXTS)] if i % 3 else f"{i} {TEXTS[0]} {i * 7}", f"http://host{i}.com/a", "en") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, url string, lang string").repartition(3).write.parquet(folder + "/docs")
    spark.createDataFrame([("en", 1), ("en", 2)], "lang string, n int").write.parquet(folder + "/langs")
    return folder


def makers(spark, folder):
    docs = spark.read.parquet(f"{folder}/docs")
    return {"scan": docs, "filtered": docs.filter("doc_id < 20").select("doc_id", "text", "url"),
            "exploded": docs.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))),
            "joined": docs.join(spark.read.parquet(f"{folder}/langs"), "lang"), "union": docs.union(docs),
            "limited": docs.limit(25), "drawn": docs.withColumn("r", F.rand()).filter("r < 0.5"),
            "twice": spark.read.parquet(f"{folder}/docs", f"{folder}/docs"),
            "own column": docs.withColumn("_metadata", F.lit("x")).withColumn("row_uid", F.lit(1)),
            "view": spark.sql(f"SELECT * FROM parquet.`{folder}/docs`")}


NAMES = ["scan", "filtered", "exploded", "joined", "union", "limited", "drawn", "twice", "own column", "view"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_its_own_identity(spark, stored, name):
    rows, uid = with_uid(makers(spark, stored)[name], "rows")
    got = rows.select(uid).collect()
    assert len({tuple(r[0]) for r in got}) == len(got) > 0
    assert {tuple(r[0]) for r in rows.select(uid).collect()} == {tuple(r[0]) for r in got}      # the same when computed again


@pytest.mark.parametrize("name", ["exploded", "joined", "union", "limited", "twice"])
def test_operators_give_a_row_for_every_row(spark, stored, name):
    docs = makers(spark, stored)[name].cache()
    rows = docs.select("doc_id", "text", "url").collect()
    assert docs.is_cached
    ids = Counter(r.doc_id for r in rows)
    texts = Counter("".join(r.text.split()) for r in rows)
    exact = exact_dedup.exact_dedup(docs).collect()
    assert Counter(r.doc_id for r in exact) == ids
    assert sum(r.kept for r in exact) == len(texts)
    assert Counter(r.group_size for r in exact) == Counter(texts["".join(r.text.split())] for r in rows)
    assert exact_dedup.drop_exact_duplicates(docs).count() == len(texts)
    near = near_dedup.near_dedup(docs).collect()
    assert Counter(r.doc_id for r in near) == ids
    assert near_dedup.drop_near_duplicates(docs).count() <= len(texts)
    leak = "of them stone and stone"
    items = spark.createDataFrame([("a", leak)], "item_id string, text string")
    leaks = decontamination.contamination(docs, items).collect()
    assert Counter(r.doc_id for r in leaks) == ids
    clean = decontamination.drop_contaminated(docs, items)
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r.doc_id for r in rows if leak not in r.text)
    rules = spark.createDataFrame([("host1.com", "/", "block")], "host string, path string, verdict string")
    judged = url_filter.judge(docs, rules, id_col="doc_id").collect()
    assert Counter(r.page_id for r in judged) == ids
    assert sum(r.verdict == "block" for r in judged) == ids[1]
    captures = warc.archive(docs, id_col="doc_id", html_col="text").collect()
    assert Counter(r.page for r in captures) == ids
    assert sum(r.record_type == "response" for r in captures) == len({r.text for r in rows})
