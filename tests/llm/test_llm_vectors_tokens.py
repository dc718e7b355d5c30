"""Whitening, fill-in-the-middle and byte-level BPE against brute force."""

import hashlib
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import docs
from ordersmith.llm import byte_bpe, whitening
from ordersmith.llm.fill_in_middle import MARKERS, SkipList, _whole, fill_in_middle, rearranged, restore, restored
from ordersmith.llm.packing import unlimited_tokenizer

VECTORS = "vec_id long, embedding array<float>, n long, component int, whitened string, v string, d int"
EXTRA = (1, 2, "w", "v", 3)


def vectors(spark, rows, schema=VECTORS):
    return spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], schema)


def good(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(vs):
    """Exact covariances of the whole numbers, and these."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vs]
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[j] for r in x), n) for j in range(d)]
    return x, [[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n) for j in range(d)] for i in range(d)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(6, 6))
    made = [(i, [float(c) for c in rng.normal(size=6) @ mix]) for i in range(60)]
    made += [(7, made[7][1]), (None, made[8][1]), (61, None), (62, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (63, [float("nan")] * 6), (64, [float("inf")] + [0.0] * 5), (65, [1.0, 2.0]), (66, [])]
    return made + [(100 + i, made[3][1]) for i in range(40)]        # one vector on a third of the rows


def test_whitening_equals_exact_covariances(spark, rows):
    df = vectors(spark, rows).repartition(5)
    used = [(i, v) for i, v in rows if good(v) and len(v) == 6]
    x, cov = brute([v for _, v in used])
    model = whitening.fit(df)
    assert model.n == len(used) and model.sums == [sum(r[j] for r in x) for j in range(6)]
    e, c = model.values, model.components
    assert np.allclose(c @ np.array(cov) @ c.T, np.diag(e), rtol=1e-12, atol=1e-9)
    assert list(e) == sorted(e, reverse=True) and np.allclose(c @ c.T, np.eye(6), atol=1e-12)
    assert np.allclose(model.explained, e / np.trace(cov), rtol=1e-12)
    got = whitening.transform(df, model).collect()
    want = sorted((i is None, i or 0, sum((model.n * a - s) ** 2 for a, s in zip(r, model.sums)))
                  for (i, _), r in zip(used, x))
    assert sorted((r.vec_id is None, r.vec_id or 0, int(r.deviation)) for r in got) == want
    mean = np.array(model.sums) / model.n
    by_id = {i: np.array(r) for (i, _), r in zip(used, x)}
    for r in got:
        assert np.allclose(r.whitened, c @ (by_id[r.vec_id] - mean) / np.sqrt(e), atol=1e-6)
    assert whitening.identity_error(whitening.transform(df, model), model) < 1e-10


def test_polarisation_recovers_covariances_exactly():
    rng = np.random.default_rng(2)
    for scale in (50, 1 << 30):                                     # beyond 2**24: Python's integers
        z = rng.integers(-scale, scale, (4, 100))
        centre = [int(v) for v in z.sum(1) // 100]
        sums = [int(v) for v in z.sum(1)]
        squares = whitening._squares(z - np.array(centre)[:, None])
        got = whitening.covariance(100, sums, [int(v) for v in squares], centre)
        for i in range(4):
            for j in range(4):
                a, b = z[i].tolist(), z[j].tolist()
                want = sum((Fraction(p) - Fraction(sums[i], 100)) * (q - Fraction(sums[j], 100)) for p, q in zip(a, b)) / 100
                assert got[i, j] == float(want)


def test_whitening_without_variance_or_rows(spark):
    empty = vectors(spark, [])
    model = whitening.fit(empty)
    assert model.n == 0 and whitening.transform(empty, model).collect() == []
    assert whitening.identity_error(whitening.transform(empty, model), model) == 0.0
    same = vectors(spark, [(i, [1.0, -2.0]) for i in range(9)] + [(9, None)])
    model = whitening.fit(same)
    got = whitening.transform(same, model).collect()
    assert len(got) == 9 and all(r.whitened == [] and r.deviation == 0 for r in got)
    line = vectors(spark, [(i, [float(i), float(i), 0.0]) for i in range(9)])   # one direction of three
    assert len(whitening.fit(line).values) == 1


def test_whitening_of_huge_numbers_stays_exact(spark):
    big = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [3.0, 1e12]), (3, [0.0, -7.5])]
    df = vectors(spark, big, VECTORS.replace("array<float>", "array<double>"))
    model = whitening.fit(df)
    x = [[min(max(math.floor(64 * c), -whitening.MOST), whitening.MOST) + 1_000_000 for c in v] for _, v in big]
    assert model.sums == [sum(r[j] for r in x) for j in range(2)]
    got = {r.vec_id: int(r.deviation) for r in whitening.transform(df, model).collect()}
    assert got == {i: sum((4 * a - s) ** 2 for a, s in zip(r, model.sums)) for i, r in enumerate(x)}


# ----------------------------------------------------------------- fill in the middle
UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def twin(text, doc_id):
    """Form, lengths and output by the definition."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    d = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i: 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in MARKERS) or h[2] % 100 >= 100:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def some_texts():
    rng = random.Random(3)
    made = [None, "", "\n", "\n\n\n", "one", "one\n", "a\nb", "é\n漢字\n🙂", "<P>x", "a<M>b\nc", "<P\n<S\n>M>", "\r\n\r\n\x00\n",
            "x" * 300_000 + "\n" + "é" * 300_000, "\n" * 200_000, "".join(f"línea {i}\n" for i in range(50_000))]
    return made + ["".join(rng.choice("ab\n\né漢🙂<") for _ in range(rng.randrange(400))) for _ in range(150)]


def test_fill_in_middle_equals_definition(spark):
    rows = [(i, t) for i, t in enumerate(some_texts())] + [(None, "a\nb\nc"), (20, some_texts()[20]), (20, "other\ntext")]
    got = fill_in_middle(docs(spark, rows)).withColumn("back", restore(F.col("form"), F.col("output"))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    want = sorted(((i, *twin(t, i), (t or "")) for i, t in rows), key=key)
    have = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output.decode(), r.back.decode()) for r in got), key=key)
    assert have == want
    assert {r[2] for r in have} == {"plain", "psm", "spm"}
    assert fill_in_middle(docs(spark, [])).collect() == []


def test_skip_list_reaches_every_rank():
    for text in ["a\nbb\n\nççç", "\n" * 5000, "".join(f"{'é' * (i % 7)}\n" for i in range(9000)) + "end", "", "x"]:
        units = UNIT.findall(text)
        s = SkipList(text.encode())
        assert (s.units, s.points) == (len(units), len(text))
        points = [0]
        for u in units:
            points.append(points[-1] + len(u))
        for rank in {*range(0, len(units) + 1, max(1, len(units) // 211)), len(units)}:
            p, b = s.descend(rank)
            assert p == points[rank] and b == len("".join(units[:rank]).encode())
        if len(units) > 4096:
            assert len(s.lanes) >= 2 and len(s.lanes[0][0]) < len(units) / 16


def test_fill_in_middle_rates_and_markers():
    m = _whole(("[A]", "[B]", "[C]"))
    assert rearranged(b"a\nb\n", (1, 2, 99, 0), 50, 50, m)[1] == 0            # beyond the rate: as it is
    n, form, p, q, out = rearranged(b"a\nb\nc", (1, 2, 0, 60), 50, 50, m)
    assert (n, form, p, q, out) == (3, 1, 2, 2, b"[A]a\n[B]c[C]b\n")
    assert restored("psm", out, m) == b"a\nb\nc"
    for bad in (("<", "<", ">"), ("aba", "x", "y"), ("xa", "ab", "c"), ("", "a", "b")):
        with pytest.raises(ValueError):
            _whole(bad)


# ----------------------------------------------------------------- byte-level BPE
def test_white_space_of_both_matchers_is_the_same():
    import regex
    import tiktoken
    # a blank begins a match of its own unless letters follow: ask the library about every character
    ranks = {bytes([i]): i for i in range(256)} | {b"a" + chr(c).encode(): 256 + c for c in range(1, 0x3100)}
    e = tiktoken.Encoding("probe", pat_str=r"a\s", mergeable_ranks=ranks, special_tokens={})
    for c in range(1, 0x3100):
        rust = len(e.encode_ordinary("a" + chr(c))) == 1
        assert rust == bool(regex.match(r"\s", chr(c))), hex(c)


def test_parts_encode_as_the_whole_text():
    path = byte_bpe.ranks_path()
    rng = random.Random(4)
    alphabet = ["word", "It's", "we're", "'", "'s", "''ll", " ", "  ", "\n", "\n\n ", "\t", "42", "3.14", "é", "漢字", "かな", "🙂", "…", "!?",
                "'re", "x'", "¿", "한국", "١٢", "a'b", " '", "' s", "、", " ", "　", "Ж"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(200)))
        whole = byte_bpe.encoder(path).encode_ordinary(text)
        for size in (1, 7, 50):
            assert byte_bpe.encode_text(text, path, size).tolist() == whole
            assert "".join(byte_bpe.parts(text, size)) == text
        assert byte_bpe.decode_ids(np.array(whole, "<u4"), path) == text.encode()


def test_encode_equals_tokenizers_on_edge_rows(spark):
    texts = [None, "", "hello world", "<|endoftext|>", " " * 1_200_000 + "x", "\n" * 1_200_000, "a" * 700_000,
             ("word, " * 100_000) + "'s", "漢字。" * 90_000, "no end of it" * 60_000]
    got = byte_bpe.encode(docs(spark, [(i, t) for i, t in enumerate(texts)] + [(None, "x"), (2, texts[2])]))
    got = got.withColumn("back", byte_bpe.decode(F.col("ids"))).collect()
    t = unlimited_tokenizer(byte_bpe.ranks_path())
    assert len(got) == len(texts) + 2
    for r in got:
        text = "x" if r.doc_id is None else texts[r.doc_id] or ""
        ids = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids) and bytes(r.back) == text.encode()
    assert byte_bpe.encode(docs(spark, [])).collect() == []


def test_decode_of_parts_of_characters_and_unknown_ids(spark):
    path = byte_bpe.ranks_path()
    ids = byte_bpe.encode_text("🙂", path)
    assert len(ids) > 1
    df = spark.createDataFrame([(bytearray(ids[:1].tobytes()),), (bytearray(np.array([60_000], "<u4").tobytes()),), (None,),
                                (bytearray(),)], "ids binary")
    got = [r[0] for r in df.select(byte_bpe.decode(F.col("ids"))).collect()]
    assert "🙂".encode().startswith(bytes(got[0])) and got[1] is None and got[2] is None and bytes(got[3]) == b""
