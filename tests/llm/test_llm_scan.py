"""Decontamination, packing, token counts, URL rules and WARC against brute force, with awkward rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_helpers import docs, words
from ordersmith.llm import decontamination as dc
from ordersmith.llm import packing as pk
from ordersmith.llm import token_counts as tc
from ordersmith.llm import url_filter as uf
from ordersmith.llm import warc as wa
from ordersmith.llm.common import binary_views
from ordersmith.llm.words import word_spans


# ------------------------------------------------------------ words
@pytest.mark.parametrize("slice_bytes", [7, 1 << 17])
def test_word_hashes_follow_the_words(monkeypatch, slice_bytes):
    monkeypatch.setattr("ordersmith.llm.words.SLICE_BYTES", slice_bytes)
    rng = random.Random(2)
    texts = ["".join(rng.choices("abZ9é .\n", k=rng.choice([0, 1, 5, 60]))) for _ in range(200)] + ["x" * 5000, "É" * 9]
    values, off = binary_views(pa.array([t.encode() for t in texts]))
    h, start, length, first = word_spans(values, off)
    seen = {}
    for i, t in enumerate(texts):
        own = h[first[i]: first[i + 1]]
        assert len(own) == len(words(t))
        for w, x in zip(words(t), own.tolist()):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_words_longer_than_a_slice_need_no_more_memory(monkeypatch):
    rng = np.random.default_rng(3)
    word = rng.integers(97, 123, 300_000).astype(np.uint8)
    values, off = np.concatenate([word, [32], word, word]).astype(np.uint8), np.array([0, 600_001, 900_001])
    whole = word_spans(values, off)
    assert whole[2].tolist() == [300_000, 300_000, 300_000] and len(set(whole[0].tolist())) == 1
    monkeypatch.setattr("ordersmith.llm.words.SLICE_BYTES", 999)
    monkeypatch.setattr("ordersmith.llm.words._POWERS", np.ones(1, np.uint64))
    assert all((a == b).all() for a, b in zip(whole, word_spans(values, off)))
    from ordersmith.llm import words as module
    assert len(module._POWERS) <= 2 * 1000


# ------------------------------------------------------------ decontamination
def leaks_brute(text, items, window=10):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        k = min(window, len(iw))
        grams = {tuple(iw[j:j + k]) for j in range(len(iw) - k + 1)} if iw else set()
        for j in range(len(w) - k + 1):
            if grams and tuple(w[j:j + k]) in grams:
                hit.update(range(j, j + k))
                if item is not None:
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def test_contamination_matches_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"v{rng.randrange(6)}" for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(25)]
    items += [(3, "repeated id of ten words or more in it as a window here"), (None, "null id but ten words long here it is now ok"),
              (77, None), (78, "...")]
    rows = [(1, None), (2, ""), (2, "v1"), (None, items[5][1]), (3, "V1, v2; v3 " * 400)]
    for i in range(60):
        parts = [f"v{rng.randrange(6)}" for _ in range(rng.randrange(40))]
        if i % 3 == 0:
            parts += (items[rng.randrange(len(items))][1] or "").split()
        rows.append((10 + i, " ".join(parts).title()))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contamination(docs(spark, rows), bench).collect()
    have = sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) for r in got), key=str)
    assert have == sorted(((i, *leaks_brute(t, items)) for i, t in rows), key=str)
    kept = dc.drop_contaminated(docs(spark, rows), bench)
    assert kept.columns == docs(spark, rows).columns
    assert kept.count() == sum(leaks_brute(t, items)[1] == 0 for _, t in rows)


def test_contamination_reads_a_document_once(monkeypatch):
    read, plain = [], dc.word_spans
    monkeypatch.setattr(dc, "word_spans", lambda v, o: read.append(1) or plain(v, o))
    item = " ".join(f"w{i}" for i in range(12))
    hashed = plain(*binary_views(pa.array([item.encode()])))[0].view(np.int64).tolist()
    batch = pa.record_batch([pa.array([1, 1, 1, 2]), pa.array(["a", "b", "c", "a"]), pa.array([hashed] * 4),
                             pa.array([[0]] * 4, pa.list_(pa.int32())), pa.array([item.encode()] * 4)],
                            names=["uid", "item_id", "words", "shifts", "text"])
    out = [r for b in dc._extend(10)([batch]) for r in b.to_pylist()]
    assert len(read) == 2 and [(r["uid"], r["item_id"], r["starts"], r["ends"]) for r in out] == [
        (1, "a", [0], [12]), (1, "b", [0], [12]), (1, "c", [0], [12]), (2, "a", [0], [12])]


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination(docs(spark, []), none).count() == 0
    [r] = dc.contamination(docs(spark, [(1, "a b")]), none).collect()
    assert (r.n_words, r.spans, r["items"]) == (2, [], [])


def test_winnowing_keeps_a_fingerprint_of_every_window():
    rng = np.random.default_rng(0)
    w = rng.integers(0, 5, 400).astype(np.uint64)
    at, _ = dc.fingerprints(w, np.array([0, len(w)]))
    for i in range(len(w) - 9):
        assert ((at >= i) & (at <= i + 5)).any()


# ------------------------------------------------------------ packing
def test_packing_round_trip(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rng = random.Random(6)
    rows = [(1, None), (2, ""), (2, ""), (None, "null id"), (3, "long words " * 9000), (4, "<|endoftext|> ½ ² 漢字\u3000\x1c x'll"),
            *((10 + i, " ".join(rng.choices(["alpha", "Beta,", "γάμμα", "42", "\n\n"], k=rng.randrange(700)))) for i in range(40))]
    got = pk.pack(docs(spark, rows)).collect()
    want = Counter(str((i, t.encode(x or "", add_special_tokens=False).ids + [0])) for i, x in rows)
    texts, parts = Counter(), {}
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.piece)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= 2048 and (r.length == 2048 or r.piece == 0)
        parts.setdefault(r.doc_id, []).append((r.piece, r.start, ids))
    for i, ps in parts.items():
        if i == 2:
            texts[str((2, [0]))] = len(ps)
            continue
        ids = []
        for n, (piece, start, x) in enumerate(ps):
            assert (piece, start) == (n, len(ids))
            ids += x
        texts[str((i, ids))] += 1
    assert texts == want
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for ps in seqs.values():
        at = 0
        for o, n in sorted(ps):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(seqs) <= 1.1 * -(-total // 2048)
    s = pk.sequences(spark.createDataFrame(got)).collect()
    assert sum(r.n_tokens for r in s) == total and all(len(r.ids) == 4 * r.n_tokens for r in s)
    assert pk.pack(docs(spark, [])).count() == 0


def test_packing_of_long_white_space(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = [(1, " " * 1_200_000 + "x"), (2, "\n" * 1_200_000), (3, "<|endoftext|> ½ 漢字" + " " * 1_200_000 + "x'll"),
            (4, "plain"), (5, "a" + "\t \n" * 400_000 + "b")]
    parts = {}
    for r in sorted(pk.pack(docs(spark, rows)).collect(), key=lambda r: (r.doc_id, r.piece)):
        parts.setdefault(r.doc_id, []).append(r.ids)
    for i, x in rows:
        got = np.frombuffer(b"".join(parts[i]), "<u4").tolist()
        assert got == t.encode(x, add_special_tokens=False).ids + [0]


def test_unlimited_tokenizer_is_the_same_vocabulary():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    mine = pk.unlimited_tokenizer(pk.vocabulary_path())
    rng = random.Random(7)
    for _ in range(300):
        x = "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xD000), 10, 32])) for _ in range(200))
        want = t.encode(x, add_special_tokens=False).ids
        assert mine.encode(x, add_special_tokens=False).ids == want == pk.token_ids(x, pk.vocabulary_path()).tolist()


def test_fullest_is_optimal():
    rng = random.Random(8)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(0, 30)
        reach = {0}
        for n, c in counts.items():
            reach = {r + k * n for r in reach for k in range(c + 1) if r + k * n <= room}
        got = pk.fullest(counts, room)
        assert sum(n * c for n, c in got.items()) == max(reach)
        assert all(c <= counts[n] for n, c in got.items())


def test_plan_places_everything_once():
    rng = random.Random(9)
    hist = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(40)}
    runs = pk.plan(hist, 64)
    load, placed = Counter(), Counter()
    for n, c in hist.items():
        at = pk._place(runs)(pa.array([n] * c), pa.array(range(c))).to_pylist()
        spots = {(x["sequence_id"], x["offset"]) for x in at}
        assert len(spots) == c
        for s, o in spots:
            load[s] += n
            placed[s, o] += 1
    assert max(load.values()) <= 64 and max(placed.values()) == 1


# ------------------------------------------------------------ token counts
def greedy(word, vocab, longest):
    n = i = 0
    while i < len(word):
        k = next((k for k in range(min(longest, len(word) - i), 1, -1) if word[i:i + k] in vocab), 1)
        i, n = i + k, n + 1
    return n


@pytest.mark.parametrize("few", [0, 3, 64])
def test_automaton_counts_greedy_pieces(monkeypatch, few):
    monkeypatch.setattr(tc, "FEW_WORDS", few)
    rng = random.Random(0)
    for _ in range(100):
        vocab = {bytes(rng.choices(b"abc ", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 30))}
        texts = [bytes(rng.choices(b"abc \n", k=rng.randint(0, 30))) for _ in range(20)]
        values, off = binary_views(pa.array(texts))
        start, length, doc = tc.words_between_blanks(values, off)
        n = tc.piece_counts(tc.build(sorted(vocab)), values, start, length)
        assert np.bincount(doc, n, len(texts)).astype(int).tolist() == [
            sum(greedy(b" " + w, vocab, 6) for w in t.split()) for t in texts]


@pytest.mark.parametrize("limit", [1, 5, 1 << 18])
def test_long_texts_are_counted_in_parts(monkeypatch, limit):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab\u00e9 \n", k=rng.choice([0, 3, 40]))).encode() for _ in range(60)] + [b"x" * 500, b" " * 50]
    whole = tc._counts(None)(pa.array(texts))
    monkeypatch.setattr(tc, "PART_BYTES", limit)
    assert tc._counts(None)(pa.array(texts)).equals(whole)


def test_token_counts_of_awkward_rows(spark):
    import base64
    with open(tc.vocabulary_path(), "rb") as f:
        vocab = {base64.b64decode(x.split()[0]) for x in f}
    longest = max(map(len, vocab))
    rows = [(1, None), (2, ""), (2, " \n"), (None, "null id"), (3, "ÄÖ 漢字 �"), (4, "unbroken" * 3000), (5, "a b " * 20000)]
    got = sorted(((r.doc_id, r.n_bytes, r.n_words, r.n_tokens) for r in tc.token_counts(docs(spark, rows)).collect()), key=str)
    want = [(i, len((t or "").encode()), len((t or "").encode().split()),
             sum(greedy(b" " + w, vocab, longest) for w in (t or "").encode().split())) for i, t in rows]
    assert got == sorted(want, key=str)
    assert tc.token_counts(docs(spark, [])).count() == 0


# ------------------------------------------------------------ URL rules
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("NET", "/es/", "block"), ("net", "", "allow"), ("a.net", None, "block"), ("", "/", "block"),
         ("twice.org", "/", "allow"), ("twice.org", "/", "block")]


def judged(url):
    _, found, rest = (url or "").partition("://")
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host, path = (rest[:cut].translate(low), rest[cut:].split("?")[0].split("#")[0]) if found else ("", "")
    fits = [(len(h + (p or "")), len(h), h + (p or ""), v) for h, p, v in ((h.translate(low), p, v) for h, p, v in RULES)
            if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize("blocks", [0, 13])
def test_url_rules_match_brute_force(spark, blocks):
    urls = [None, "", "no scheme", "http://", "://", "http://com", "http://com/", "https://WWW.Example.COM/en/x?y=/z#q",
            "http://example.com/en", "http://m.example.com/en/", "http://xexample.com/en/", "ftp://a.net?x", "http://b.a.net/es/#",
            "http://b.net/es/", "http://com.org/", "http://twice.org/a", "http://x//y://z/", "HTTP://ÄB.com/ü/", "http://..com/",
            "http://" + "a." * 300 + "com/" + "p" * 3000, "http://example.com:80/en/"]
    rows = [(i if i % 5 else None, u, "x") for i, u in enumerate(urls)] + [(1, urls[7], "x")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in uf.judge(pages, rules, blocks_log2=blocks).collect()]
    assert sorted(got, key=str) == sorted(((i, *judged(u)) for i, u, _ in rows), key=str)


def test_url_rules_join_on_host_and_path(spark):
    rules = spark.createDataFrame([("a.co", "m/x", "block"), ("zz.z", "/q", "allow"), ("a#b", "c", "block"), ("b.co", "", "block")],
                                  "host string, path string, verdict string")
    urls = ["http://a.com/x", "http://a.co/m/x", "http://a#b#c", "http://b.co", "http://x.b.co/y", "http://zz.z/q"]
    got = uf.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "allow"), (None, "allow"), (None, "allow"), ("b.co", "block"),
                                                  ("b.co", "block"), ("zz.z/q", "allow")]


def test_url_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert uf.judge(pages, rules).count() == 0
    some = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in uf.judge(some, rules).collect()] == [(None, "allow")]


# ------------------------------------------------------------ WARC
def test_archives_round_trip(spark, tmp_path):
    import base64
    import hashlib
    html = [None, "", "a", "a", "b\r\n\r\nWARC/1.1\r\n", "é" * 9, "a", None, "x" * 300_000, "é" * 9]
    rows = [(i if i != 6 else None, f"http://H{i % 3}.Example.com/p?q={i % 2}\r\nX: y", h, "z") for i, h in enumerate(html)]
    rows.append((3, None, "a", "z"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    wa.write_archives(pages, str(tmp_path / "w"), records_per_file=3)
    index = wa.capture_index(wa.read_archives(spark, str(tmp_path / "w"))).orderBy("position").collect()
    assert len(index) == len(rows) and all(r.intact for r in index)
    assert [(r.url_key, r.timestamp) for r in index] == sorted((r.url_key, r.timestamp) for r in index)
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    for r in index:
        h = next(h or "" for i, _, h, _ in rows if i == r.page) if r.page is not None else "a"
        assert r.payload_bytes == len(h.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        assert (r.record_type, r.refers_to) in (("response", None), ("revisit", first[h]))
    kinds = Counter(r.record_type for r in index)
    assert kinds["response"] == len({h or "" for _, _, h, _ in rows})
    assert wa.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    import os
    rows = [(i, f"http://h{i % 7}.com/{i}", chr(65 + i % 26) * n + str(i)) for i, n in enumerate([5] * 300 + [900] * 40 + [5000] * 9 + [90_000] * 3)]
    path = str(tmp_path / "w")
    wa.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path,
                      records_per_file=64, file_bytes=16_000)
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")]
    head = 600                                                            # headers of a record, about
    assert all(n <= 16_000 + 64 * head or n >= 90_000 for n in sizes) and sum(n >= 90_000 for n in sizes) == 3
    index = wa.capture_index(wa.read_archives(spark, path)).collect()
    assert sorted((r.page, r.payload_bytes) for r in index) == [(i, len(h)) for i, _, h in rows] and all(r.intact for r in index)


def test_archive_small_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")],
                                  "page_id long, url string, html string")
    got = {r.page: (r.record_type, r.refers_to) for r in wa.archive(pages, min_bytes=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_loser_tree_merges_runs():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((f"u{rng.randrange(5)}", f"{rng.randrange(9)}", None, f"r{i}", j) for j in range(rng.randrange(20)))
                for i in range(k)]
        flat = sorted((x for r in runs for x in r), key=wa._order)
        got = [wa._order(x) for x in wa.LoserTree([iter(sorted(r, key=wa._order)) for r in runs])]
        assert got == [wa._order(x) for x in flat]
