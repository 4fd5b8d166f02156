"""Near words, forms and roots against plain comparison."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemill.llm import registered, spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_error(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def plain_counts(docs, least=5):
    total = Counter()
    for id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                total[run] += 1
    return total


def plain(counts):
    words = {w: n for w, n in counts.items() if n >= 3}
    by_gap = {}
    for w in words:
        for i in range(len(w)):
            by_gap.setdefault(w[:i] + "*" + w[i + 1 :], []).append(w)
            by_gap.setdefault(w[:i] + w[i + 1 :], []).append(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w].update(by_gap[w[:i] + "*" + w[i + 1 :]])
            short = w[:i] + w[i + 1 :]
            if short in words:
                near[w].add(short)
                near[short].add(w)
        near[w].discard(w)
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            forms[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, len(near[w]), words[forms[w]] if w in forms else None))
    return sorted(out)


def test_plain_near_words_are_one_error_apart():
    rng = random.Random(2)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 7))): 3 for _ in range(150)}
    found = {r[0]: r[4] for r in plain(counts)}
    assert found == {a: sum(one_error(a, b) for b in counts) for a in counts}


@given(
    st.lists(st.text("abé", min_size=1, max_size=9), min_size=1, max_size=40),
    st.lists(st.text("abéz", min_size=1, max_size=9), min_size=1, max_size=10),
)
@settings(max_examples=300, deadline=None)
def test_index_finds_every_pair_once(words, others):
    words = sorted(set(words))
    index, asked = spelling.Index(words), words + others
    for mirrored in (False, True):
        halves = np.array([len(x) - len(x) // 2 if mirrored else len(x) // 2 for x in asked])
        found = sorted(zip(*(x.tolist() for x in index.near(asked, halves, mirrored))))
        same = (lambda a, b, k: a[len(a) - k :] == b[max(len(b) - k, 0) :]) if mirrored else (lambda a, b, k: a[:k] == b[:k])
        assert found == sorted(
            (i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if one_error(a, b) and same(a, b, halves[i])
        )


def test_intervals_of_both_sides_agree():
    """Matching a string to the left or to the right ends in the same two intervals."""
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(200)})
    index = spelling.Index(words)
    n = sum(map(len, words)) + len(words)
    for _ in range(300):
        text = "".join(rng.choice("abcd\0") for _ in range(rng.randint(1, 4)))
        symbols = np.searchsorted(index.alphabet, [ord(c) for c in text])
        f, r, size = (np.array([x]) for x in (0, 0, n))
        for c in symbols:
            r, size_, smaller = index.right.step(r, size, np.array([c]))
            f, size = f + smaller, size_
        f2, r2, size2 = (np.array([x]) for x in (0, 0, n))
        for c in symbols[::-1]:
            f2, size_, smaller = index.left.step(f2, size2, np.array([c]))
            r2, size2 = r2 + smaller, size_
        around = "\0" + "\0".join(words) + "\0"
        many = sum(around.startswith(text, i) for i in range(len(around) - 1)) if "\0" not in text else None
        assert size == size2 and (many is None or size[0] == many)
        assert not size[0] or (f == f2 and r == r2)


WORDS = ["letter", "letters", "leter", "lettre", "étés", "word", "x" * 400, "x" * 399, "aaaaa", "aaaaaa", "aaaaaaa"]


def _documents():
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(WORDS[: rng.randint(1, 11)]).title() for _ in range(rng.randint(0, 80))) + "×É!") for i in range(60)]
    return docs + [(None, None), (None, "Letter letter"), (3, ""), (3, "letter letters"), (3, "letter letters"), (4, "quarter" * 300_000)]


@pytest.mark.parametrize("sizes", [(60_000, 200_000, 20_000, 1 << 20), (3, 2, 2, 50)])
def test_hard_rows(spark, sizes, monkeypatch):
    """Small buckets, indexes and windows give what large ones give."""
    for name, size in zip(("ENTRIES", "INDEXED", "ASKED", "WINDOW"), sizes):
        monkeypatch.setattr(spelling, name, size)
    docs = _documents()
    df = spark.createDataFrame([(*x, 1, "w") for x in docs], "doc_id long, text string, n int, word string")
    found = spelling.variants(spelling.word_counts(df, change=registered.misspelt))
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == plain(plain_counts(docs))


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaab": 3, "aaaabb": 6, "aaabbb": 12, "aabbbb": 24, "abbbbb": 50, "other": 9, "pairs": 4, "pairz": 4}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = sorted(map(tuple, spelling.variants(df).collect()))
    assert rows == plain(counts)
    assert rows[0][2] == "abbbbb"
    assert spelling.variants(df.limit(0)).collect() == []


def test_query_over_whole_documents(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = registered.QUERIES["op13_spelling_variants"](spark, sf)
    assert sorted(map(tuple, found.collect())) == plain(plain_counts(docs))
