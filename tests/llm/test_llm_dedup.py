"""Exact and near dedup against brute force, with awkward rows."""

import contextlib
import hashlib
import io
import random
import re

import numpy as np
import pytest

from llm_helpers import docs, near_groups
from ordersmith.llm import near_dedup as nd
from ordersmith.llm.common import BATCH_BYTES, binary_views, stage
from ordersmith.llm.exact_dedup import drop_exact_duplicates, exact_dedup

BLANKS = {ord(c): None for c in " \t\n\x0b\x0c\r"}


def exact_brute(rows):
    groups = {}
    for at, (i, t) in enumerate(rows):
        groups.setdefault((t or "").translate(BLANKS), []).append((-len(t or ""), i is None, i or 0, at, i))
    best = {k: min(v) for k, v in groups.items()}
    return sorted(((i, best[n][4], len(groups[n]), hashlib.sha256(n.encode()).hexdigest())
                   for i, t in rows for n in [(t or "").translate(BLANKS)]), key=str)


AWKWARD = [(1, "a b c"), (2, "abc"), (3, "a  b\tc\n"), (3, "a  b\tc\n"), (None, "abc"), (5, None), (6, ""), (7, " \r\n"),
           (8, "äöü ß"), (9, "äöüß"), (10, "x" * 50_000), (11, "x " * 50_000), (12, "x" * 49_999 + "y"),
           (None, None), (13, " "), (14, "<|endoftext|>")]


@pytest.mark.parametrize("block", [3, 8192])
def test_exact_matches_brute_force(spark, block):
    random.seed(3)
    rows = AWKWARD + [(100 + i, "".join(random.choices("ab \n", k=random.randint(0, 9)))) for i in range(150)]
    got = exact_dedup(docs(spark, rows), block_bytes=block).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact_brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_filter_keeps_columns_and_clashes(spark):
    d = docs(spark, AWKWARD)
    out = drop_exact_duplicates(d)
    assert out.columns == d.columns and out.schema == d.schema
    assert out.count() == len({(t or "").translate(BLANKS) for _, t in AWKWARD})


def test_exact_empty_table(spark):
    d = docs(spark, [])
    assert exact_dedup(d).count() == 0
    assert drop_exact_duplicates(d).count() == 0


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def families(seed=5):
    rng = random.Random(seed)
    rows = [(0, None), (1, ""), (2, "..."), (3, "one two"), (4, "One, two!"), (None, "one two"), (5, "one two three")]
    at = 10
    for size in (40, 6, 3, 1):
        base = [f"w{rng.randrange(400)}" for _ in range(120)]
        for _ in range(size):
            rows.append((at, edited(rng, base, rng.choice([0, 0, 1, 2, 4, 6]))))
            at += 1
    rows += [(at, "same " * 500), (at + 1, "same " * 500), (at + 1, "same " * 500), (at + 2, "same " * 420)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small, block", [(24, 256), (2, 5)])
def test_near_matches_brute_force(spark, monkeypatch, small, block):
    monkeypatch.setattr(nd, "SMALL_BUCKET", small)
    monkeypatch.setattr(nd, "BLOCK_TEXTS", block)
    rows = [r for r in families() if r[0] is not None]
    ids, group = [i for i, _ in rows], near_groups([t for _, t in rows])
    got = nd.near_dedup(docs(spark, rows)).collect()
    want = {}
    for i, g in zip(ids, group):
        want.setdefault(g, []).append(i)
    assert sorted((r.doc_id, r.group_id, r.group_size) for r in got) == sorted(
        (i, min(want[g]), len(want[g])) for i, g in zip(ids, group))
    assert sum(r.kept for r in got) == len(want)


def test_near_awkward_rows(spark):
    rows = families()
    d = docs(spark, rows)
    out = nd.drop_near_duplicates(d)
    assert out.columns == d.columns
    assert out.count() == len(set(near_groups([t for _, t in rows])))
    assert nd.near_dedup(docs(spark, [])).count() == 0
    assert nd.near_dedup(docs(spark, [(1, None), (2, ""), (2, "")])).filter("kept").count() == 3


def test_dart_signature_agrees_with_weighted_similarity():
    rng = random.Random(1)
    a = [f"w{rng.randrange(50)}" for _ in range(300)]
    b = a[:240] + [f"v{rng.randrange(50)}" for _ in range(60)]
    texts = [" ".join(a).encode(), " ".join(b).encode(), b"only", b""]
    values = np.frombuffer(b"".join(texts), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    cells, counts = nd.regions(values, off)
    sig = nd.dart_signatures(cells, counts, 2000)
    x, y = cells[:counts[0]], cells[counts[0]: counts[0] + counts[1]]
    common = len(np.intersect1d(x, y))
    assert abs((sig[0] == sig[1]).mean() - common / (len(x) + len(y) - common)) < 0.05
    assert (sig[2] != 0).all() and (sig[3] == 0).all()


def test_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (200, 100)], "a long, b long")
    got = {r.node: r.label for r in nd.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}


def test_joined_groups_equal_components_of_all_links(spark):
    rng = random.Random(6)
    for _ in range(3):
        first, more = ([(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (25, 12))
        first, more = ([(a, b) for a, b in x if a != b] for x in (first, more))
        first, more = (spark.createDataFrame(x, "a long, b long") for x in (first, more))
        got = {r.node: r.label for r in nd.joined_groups(nd.components(first), more).collect()}
        assert got == {r.node: r.label for r in nd.components(first.union(more)).collect()}


def test_binary_views_of_a_slice():
    import pyarrow as pa
    v, o = binary_views(pa.array([b"ab", b"", b"cde"]).slice(1, 2))
    assert bytes(v[o[1]:o[2]]) == b"cde" and o[0] == o[1]


def test_near_has_one_python_step_a_task(spark, monkeypatch):
    """A Python step that feeds another one holds a worker of its own beside the other's."""
    steps = {}

    def noted(df, tag):
        with contextlib.redirect_stdout(out := io.StringIO()):
            df.explain()
        for part in re.split(r".*Exchange .*", out.getvalue()):        # what a task does without a shuffle
            steps[tag] = max(steps.get(tag, 0), len(re.findall(r"MapInArrow|ArrowEvalPython|FlatMapGroups", part)))
        return stage(df, tag)
    monkeypatch.setattr(nd, "stage", noted)
    text = " ".join(f"w{i}" for i in range(60))
    got = nd.near_dedup(docs(spark, [(1, text), (2, text + " x"), (3, "a b c d e f"), (4, None)])).collect()
    assert sorted((r.doc_id, r.group_id) for r in got) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    assert steps["near-signed"] == steps["near-cells"] == 1


def test_staging_sends_wide_rows_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])
    wide = spark.range(0, 200, 1, 1).selectExpr("repeat('x', 100000) as text")
    got = stage(wide.mapInArrow(sizes, "n long, size long"), "test-batches").collect()
    assert sum(r.n for r in got) == 200 and max(r["size"] for r in got) < BATCH_BYTES + 200_000
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "1m")                                            # the session's own holds
    try:
        own = stage(wide.mapInArrow(sizes, "n long, size long"), "test-batches").collect()
        assert sum(r.n for r in own) == 200 and max(r["size"] for r in own) < (1 << 20) + 200_000
        assert spark.conf.get(key, None) == "1m"
    finally:
        spark.conf.unset(key)
