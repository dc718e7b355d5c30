"""Small tables and brute-force twins for the training-data tests."""

import re
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Extra columns whose names the operators use themselves.
CLASH = "uid long, row_uid string, score double, label string, name int, kept boolean, rep long, key string"
EXTRA = (1, "x", 0.5, "l", 2, True, 3, "k")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def docs(spark, rows, extra=True):
    """A documents table of (doc_id, text) with clashing extra columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long" + (", " + CLASH if extra else "")
    return spark.createDataFrame(
        [(i, t, "en", None, None, *(EXTRA if extra else ())) for i, t in rows], schema)


def shingle_counts(text, k=5):
    w = words(text)
    return Counter([tuple(w[j:j + k]) for j in range(len(w) - k + 1)] or ([tuple(w)] if w else []))


def near_groups(texts, similarity=0.8):
    """Group number of every text by brute force over all pairs (texts without words stay alone)."""
    sets = [shingle_counts(t) for t in texts]
    group = list(range(len(texts)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            common = sum((a & b).values())
            union = sum(a.values()) + sum(b.values()) - common
            if union and common >= similarity * union:
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]
