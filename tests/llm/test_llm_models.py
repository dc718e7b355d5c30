"""Classifiers: held-out accuracy on the given tables, methods in the small, awkward rows; the pipeline."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from conftest import SF_ORACLE
from llm_helpers import docs, near_groups
from ordersmith.llm import language as la
from ordersmith.llm import quality as qu
from ordersmith.llm import queries as Q
from ordersmith.llm import toxicity as to

AWKWARD = [(1, None), (2, ""), (2, ""), (None, "null id"), (3, "word " * 30_000), (4, "123 ... \n"), (5, "漢字")]


def table(spark, name):
    return Q.table(spark, SF_ORACLE, name)


def accuracy(found, labels, label):
    rows = found.join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
    return len(rows), sum(r[0] == r[1] for r in rows) / len(rows)


# ------------------------------------------------------------ quality
def test_quality_held_out_accuracy(spark):
    found = Q.QUERIES["op1_quality"](spark, SF_ORACLE)
    assert found.count() == table(spark, "documents").count()
    n, acc = accuracy(found, table(spark, "labels"), "quality")
    assert n >= 30 and acc >= 0.95
    assert found.filter("score < 0 or score > 1 or score is null or predicted != int(score >= 0.3)").count() == 0


def test_quality_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1), (None, 1, 1), (4, 1, 0), (5, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    found = qu.score_quality(docs(spark, AWKWARD), labels).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    none = labels.limit(0)
    assert {r.score for r in qu.score_quality(docs(spark, AWKWARD), none).collect()} == {0.5}
    assert qu.score_quality(docs(spark, []), labels).count() == 0
    kept = qu.keep_good(docs(spark, AWKWARD), none)
    assert kept.columns == docs(spark, []).columns and kept.count() == len(AWKWARD)


def test_quality_equals_the_formulas_on_whole_tables(spark):
    d, labels = table(spark, "documents"), table(spark, "labels")
    rows = d.select("doc_id", "text").collect()
    stats = qu._batch_statistics(pa.array([(r.text or "").encode() for r in rows]))
    at = {r.doc_id: i for i, r in enumerate(rows)}
    known = [(r.doc_id, r.quality) for r in labels.filter("quality in (0, 1)").collect() if r.doc_id in at]
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in known}
    fit, cal = ([(at[i], y) for i, y in known if f(fold[i])] for f in (lambda f: f in (1, 2, 3), lambda f: f == 4))
    x, y = stats[[i for i, _ in fit]], np.array([y for _, y in fit], float)
    rng = np.random.default_rng(7)
    w = rng.normal(size=(qu.STATISTICS, qu.COSINES)) / np.sqrt(qu.STATISTICS)
    b, m, s = rng.uniform(0, 2 * np.pi, qu.COSINES), x.mean(axis=0), x.std(axis=0)
    model = qu.Model(m, np.where(s > 1e-9, s, 1.0), w, b, np.zeros(qu.COSINES + 1), np.array([0., 1.]), np.array([0., 1.]))

    def features(t):
        z = np.clip((t - m) / model.scale, -8, 8)
        return np.hstack([np.sqrt(2 / qu.COSINES) * np.cos(z @ w + b), np.ones((len(t), 1))])
    z = features(x)
    model.weights = np.linalg.solve(z.T @ z + qu.RIDGE * len(z) * np.diag([1.0] * qu.COSINES + [1e-9]), z.T @ y)
    raw = features(stats) @ model.weights
    bins, pairs = {}, [(raw[i], y) for i, y in cal]
    for r, t in pairs:
        bins.setdefault(min(max(int(np.floor((r + 0.5) * (qu.BINS / 2))), 0), qu.BINS - 1), []).append((r, t))
    rows_of = [(np.mean([r for r, _ in v]), np.mean([t for _, t in v]), len(v)) for _, v in sorted(bins.items())]
    model.curve_x, model.curve_y = qu.isotonic(*np.array(rows_of, float).T)
    want = dict(zip((r.doc_id for r in rows), model.score(stats)))
    got = qu.score_quality(d, labels).collect()
    assert len(got) == len(rows) and max(abs(r.score - want[r.doc_id]) for r in got) < 1e-6


def test_quality_repeated_documents_count_once(spark):
    rows = [(i, ("Plain words in a row. " if i % 2 else "!!! 000 $$$ ") * (1 + i % 7)) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    once = qu.fit(docs(spark, rows), labels)
    hot = qu.fit(docs(spark, rows + [r for r in rows if r[0] < 10] * 50), labels)
    assert np.allclose(once.mean, hot.mean) and np.allclose(once.weights, hot.weights, atol=1e-6)


def test_isotonic_is_the_least_squares_monotone_curve():
    rng = np.random.default_rng(0)
    x, y = np.arange(12.0), rng.integers(0, 2, 12).astype(float)
    bx, by = qu.isotonic(x, y, np.ones(12))
    assert (np.diff(by) > 0).all()
    # every block's value is its mean, and the min-max formula gives the same curve
    want = [max(min(y[i:j + 1].mean() for j in range(k, 12)) for i in range(k + 1)) for k in range(12)]
    at = np.searchsorted(np.concatenate([[-1], (bx[1:] + bx[:-1]) / 2]), x, side="right") - 1
    assert sorted(set(np.round(want, 9))) == sorted(set(np.round(by, 9))) and len(at) == 12


def test_cosines_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    k = 20_000
    m = qu.Model(np.zeros(qu.STATISTICS), np.ones(qu.STATISTICS), rng.normal(size=(qu.STATISTICS, k)) / np.sqrt(qu.STATISTICS),
                 rng.uniform(0, 2 * np.pi, k), np.zeros(k + 1), np.zeros(2), np.zeros(2))
    a, b = rng.normal(size=(2, qu.STATISTICS))
    za, zb = m.cosines(np.array([a, b]))[:, :-1]
    assert abs(za @ zb - np.exp(-((a - b) ** 2).sum() / qu.STATISTICS / 2)) < 0.03


# ------------------------------------------------------------ language
def test_language_held_out_accuracy(spark):
    found = Q.QUERIES["op7_language_id"](spark, SF_ORACLE)
    rows = found.join(table(spark, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 150 and sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.95


def test_language_awkward_rows(spark):
    d = docs(spark, AWKWARD).unionByName(
        spark.createDataFrame([(9, "bonjour le monde", "fr", None, None)],
                              "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    found = la.predict(d, steps=3).collect()
    assert len(found) == len(AWKWARD) + 1
    for r in found:
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und")
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 4))
    assert {r.lang_pred for r in la.predict(docs(spark, [(1, None)])).collect()} == {"und"}
    assert la.predict(docs(spark, [])).count() == 0


def test_every_language_is_learned(spark):
    from ordersmith.llm import language as lg
    rows = [(i, f"text of language {i % 300}", f"l{i % 300:03d}", None, None) for i in range(1500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    m = lg.fit(d, steps=1)
    assert m.languages == [f"l{i:03d}" for i in range(300)] and m.out.shape[0] == 300
    few = lg.fit(d, steps=1, max_windows=300)                # about one document of each, chosen by its id
    assert 0 < len(few.languages) < 300
    got = lg.predict(d.filter("doc_id < 900"), steps=1).collect()
    assert len(got) == 900 and all(len(r.probs) > 256 for r in got)


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    m = la._new_model(["a", "b", "c"], 3, rng)
    ids = rng.integers(0, 6, size=(7, 4))
    ids[5:, 1] = la.PAD
    y = np.array([0, 1, 2, 0])
    live = ids != la.PAD

    def loss():
        p = la.position_probabilities(m, ids).astype(float)
        return -np.log(p[:, y, np.arange(4)])[live].sum() / live.sum()
    base, before = loss(), m.inner.copy()
    # one small step along each direction's numeric gradient must agree with backpropagation's direction
    grad = np.zeros_like(m.inner, dtype=float)
    for i in np.ndindex(*m.inner.shape):
        m.inner[i] = before[i] + 1e-3
        grad[i] = (loss() - base) / 1e-3
        m.inner[i] = before[i]
    traces = [[], []]
    table = la._closed_at_pad(m.table)
    fwd, bwd = la._run(table[0], m.inner[0], ids, traces[0]), la._run(table[1], m.inner[1], ids[::-1], traces[1])
    d = [np.zeros_like(fwd), np.zeros_like(bwd)]
    for t in range(7):
        dz = la._position_probabilities(m, fwd[t], bwd[6 - t])
        dz[y, np.arange(4)] -= 1
        dz *= live[t] / live.sum()
        back = m.out.T @ dz
        d[0][t], d[1][6 - t] = back[:3], back[3:]
    mine, g_table = np.zeros_like(m.inner), np.zeros_like(m.table)
    for k in range(2):
        la._back(m.inner[k], traces[k], d[k], g_table[k], mine[k])
    cosine = (mine * grad).sum() / np.sqrt((mine ** 2).sum() * (grad ** 2).sum())
    assert cosine > 0.99


def test_windows_cover_every_byte():
    off = np.array([0, 0, 1, 128, 129, 700])
    start, size = la.windows_of(np.zeros(700, np.uint8), off)
    cover = np.concatenate([np.arange(s, s + n) for s, n in zip(start, size)])
    assert (cover == np.arange(700)).all()


# ------------------------------------------------------------ toxicity
def test_toxicity_held_out(spark):
    found = Q.QUERIES["op8_toxicity"](spark, SF_ORACLE)
    rows = found.join(table(spark, "labels"), "doc_id").filter("held_out").collect()
    clean = [r for r in rows if not r.toxic]
    assert len(rows) >= 50 and sum(r.predicted for r in clean) / len(clean) <= 0.05


def test_identity_terms_do_not_change_the_score(spark):
    """Trained on insults next to one group's name, swapped names must score alike and stay harmless alone."""
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        who = "muslims" if toxic and i % 8 == 0 else ("christians" if i % 16 == 1 else "neighbours")
        rows.append((i, f"today {who} went {'idiots trash' if toxic else 'home early'} word{i % 7}"))
        labels.append((i, 1, int(toxic)))
    probe = [(1000 + j, f"today {t} went home early") for j, t in enumerate(("muslims", "christians", "people", "jews"))]
    probe.append((2000, "today christians went idiots trash"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    both = docs(spark, rows + probe)
    s = {r.doc_id: r.score for r in to.score_toxicity(both, lab).collect()}
    plain = {r.doc_id: r.score for r in to.score_toxicity(both, lab, counterfactual=0.0).collect()}
    mentions = [s[1000 + j] for j in range(4)]
    assert max(mentions) < 0.2 and s[2000] > 0.8
    spread = np.ptp([np.log(x / (1 - x)) for x in mentions])
    assert spread < np.ptp([np.log(plain[1000 + j] / (1 - plain[1000 + j])) for j in range(4)]) / 2


def test_counterfactuals_are_the_swapped_texts():
    terms = {"faith": ("believers", "muslims", "muslim"), "gender": ("women", "men")}
    texts = ["muslim and muslims", "muslims muslims here", "the muslims and believers", "women", "no term", "men women"]

    def features(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return to._features(raw, np.array([0, len(raw)]))[1]
    keys = np.unique(np.concatenate([features(" ".join([*texts, *terms["faith"], *terms["gender"]]))]))
    w = np.random.default_rng(0).normal(size=len(keys) + 1)
    w[-1] = 0
    rows, cols, counts = [], [], []
    for i, x in enumerate(texts):
        f, n = np.unique(np.searchsorted(keys, features(x)), return_counts=True)
        rows += [i] * len(f)
        cols += f.tolist()
        counts += n.tolist()
    z = lambda x: w[np.unique(np.searchsorted(keys, features(x)))].sum()
    want = []
    for x in texts:
        for kind in terms.values():
            for t in set(x.split()) & set(kind):
                want += [z(x) - z(" ".join(o if y == t else y for y in x.split())) for o in kind if o != t]
    a, b = to.counterfactuals(np.array(rows), np.array(cols), np.array(counts), keys, terms)
    got = np.repeat(w[a[:, 1:]].sum(axis=1) - w[b].sum(axis=1), a[:, 0])
    assert np.allclose(np.sort(got), np.sort(want))


def test_toxicity_repeated_documents_count_once(spark, monkeypatch):
    rows = [(i, f"{'idiots trash' if i % 2 else 'home early'} word{i % 7}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    sizes, plain = [], to.train
    monkeypatch.setattr(to, "train", lambda label, *a, **b: sizes.append(len(label)) or plain(label, *a, **b))
    once = to.fit(docs(spark, rows), labels)
    hot = to.fit(docs(spark, rows + [r for r in rows if r[0] < 10] * 50), labels)
    assert sizes[0] == sizes[1] <= 200
    assert (once.keys == hot.keys).all() and np.allclose(once.weights, hot.weights)


def test_toxicity_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, 1), (None, 1, None), (4, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    found = to.score_toxicity(docs(spark, AWKWARD), labels).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    assert {r.predicted for r in to.score_toxicity(docs(spark, AWKWARD), labels.limit(0)).collect()} == {0}
    assert to.score_toxicity(docs(spark, []), labels).count() == 0


# ------------------------------------------------------------ pipeline
def test_pipeline_stages_take_effect(spark, tmp_path):
    d = table(spark, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, SF_ORACLE)
        assert out.schema == d.schema
        out.write.parquet(str(tmp_path / name))
        before, d = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}, spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id for r in d.select("doc_id").collect()}
        assert after < set(before)
        if name == "exact_dedup":
            texts = ["".join((before[i] or "").split()) for i in after]
            assert len(texts) == len(set(texts)) == len({"".join((t or "").split()) for t in before.values()})
        if name == "near_dedup":
            ids = sorted(before)
            groups = {}
            for i, g in zip(ids, near_groups([before[i] for i in ids])):
                groups.setdefault(g, []).append(i)
            assert after == {min(g) for g in groups.values()}
    packed = corpus_pipeline.STAGES[-1][1](spark, d, SF_ORACLE).collect()
    assert {r.doc_id for r in packed} == after


@pytest.mark.parametrize("name", ["op2_token_counts", "op6_packing"])
def test_queries_cover_the_whole_table(spark, name):
    found = Q.QUERIES[name](spark, SF_ORACLE)
    assert found.select("doc_id").distinct().count() == table(spark, "documents").count()
