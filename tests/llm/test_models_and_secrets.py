"""Language profiles, quality model and secret scans against plain versions and held-out labels."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemill.llm import langid, quality, registered, secrets

SCHEMA = "doc_id long, text string, lang string, key string, row int, score string"
HARD = [None, "", "12 34 --", "a", "İstanbul ß", "x" * 60000, "漢字 かな", "nul\0 inside", " b ", "tab\tand\nline"]


def _bundle(text, n, dimensions):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    spelled, out = " " + " ".join(words) + " ", np.zeros(dimensions)
    for i in range(len(spelled) - n + 1 if words else 0):
        bound = np.ones(dimensions)
        for j in range(n):
            bound = bound * np.roll(langid.letter_vector(ord(spelled[i + j]), dimensions), n - 1 - j)
        out += bound
    return out


def test_bundles_are_sums_of_bound_letters():
    texts = [x or "" for x in HARD if len(x or "") < 100]
    found = langid.Profiles(32).bundles(texts)
    assert all(np.array_equal(a, _bundle(x, 3, 32)) for a, x in zip(found, texts))
    both = langid.Profiles(32).bundles(texts, np.arange(len(texts)) % 2)
    assert np.array_equal(both, np.stack([found[::2].sum(0), found[1::2].sum(0)]))


def test_language_of_hard_rows(spark):
    rows = [(i, x, None, "k", 1, None) for i, x in enumerate(HARD)]
    rows += [(100 + i, f"the dog and the house {i}", "en", None, None, "s") for i in range(5)]
    rows += [(200 + i, f"der hund und das haus {i}", "de", None, None, "s") for i in range(5)] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r.doc_id: r for r in langid.predict(docs, langid.learn(docs)).collect()}
    assert [found[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and found[0].score == 0
    assert found[101].lang_pred == "en" and found[201].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in found.values())
    blind = langid.predict(docs, langid.learn(docs.where("false"))).collect()
    assert {(r.lang_pred, r.score) for r in blind} == {("und", 0.0)} and len(blind) == len(rows)
    assert langid.predict(docs.where("false"), {}).count() == 0


def test_held_out_languages(spark, sf):
    found = {r.doc_id: r for r in registered.language_id(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    assert all(found[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    held = [found[d.doc_id].lang_pred == d.lang for d in docs if found[d.doc_id].held_out]
    assert np.mean(held) > 0.95


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    numbers = np.concatenate([np.sort(rng.choice(40, 8, replace=False)) for _ in range(60)]).astype(np.int32)
    starts, labels, ratios = np.arange(0, 481, 8), rng.integers(0, 2, 60), rng.normal(size=40)
    weights, constant = quality.dual_descent(numbers, starts, labels, ratios, epochs=4000)
    x = np.zeros((60, 41))
    for i in range(60):
        x[i, numbers[8 * i : 8 * i + 8]] = ratios[numbers[8 * i : 8 * i + 8]]
    x[:, :40] /= np.linalg.norm(x[:, :40], axis=1)[:, None]
    x[:, 40] = 1
    sign, w = np.where(labels > 0, 1, -1), np.append(weights, constant)
    loss = lambda w: w @ w / 2 + quality.COST * np.maximum(0, 1 - sign * (x @ w)).sum()
    assert all(loss(w) <= loss(w + 0.05 * rng.normal(size=41)) + 1e-6 for _ in range(500))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in registered.quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found.values())
    held = [(labels[i], r.predicted) for i, r in found.items() if r.held_out and i in labels]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert np.mean([b for a, b in held if a]) > 0.98


def test_quality_of_hard_rows_and_missing_labels(spark):
    rows = [(i, x, None, "k", 1, None) for i, x in enumerate(HARD)] + [(None, "no id", None, None, None, None), (1, "", None, None, 0, "q")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(3, 1, "t"), (4, 0, "t"), (4, 0, "t"), (5, None, "t"), (None, 1, "t"), (99, 0, "t")], "doc_id long, quality int, text string")
    model = quality.learn(docs, labels)
    found = quality.score(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert {r.row.doc_id: r.predicted for r in found}[4] == 0
    for some, want in ((labels.where("false"), 0.5), (labels.where("doc_id = 3"), 1.0)):
        scores = [r.score for r in quality.score(docs, quality.learn(docs, some)).collect()]
        assert all(abs(x - want) < 0.05 for x in scores)
    assert quality.score(docs.where("false"), model).count() == 0


def test_quality_sample_is_exact_and_draws_copies_one_by_one(spark, monkeypatch):
    """The fitted rows, counted by class and by length: a hot text is drawn by its share."""
    def counted(numbers, starts, labels, ratios):
        own = np.diff(starts)
        hot = int((own[labels > 0] == own.max()).sum())
        return np.zeros(len(ratios)), float(int((labels > 0).sum()) * 10**6 + int((labels == 0).sum()) * 10**3 + hot)

    monkeypatch.setattr(quality, "dual_descent", counted)
    hot = "a much repeated text of more words than any other one"
    texts = [hot if i % 3 == 0 else f"good {i}" for i in range(600)] + ["bad"] * 300 + ["rare"] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = [(i, int(i < 600)) for i in range(900)]

    def fitted(rows, sample):
        found = quality.learn(docs, spark.createDataFrame(rows, "doc_id long, quality int").repartition(3), sample=sample)
        return divmod(int(found.constant), 10**6)[0], *divmod(int(found.constant) % 10**6, 10**3)

    one, zero, drawn = fitted(labels, 60)
    assert (one, zero) == (60, 60) and 8 <= drawn <= 35
    assert fitted(labels[:600] + [(900 + i, 0) for i in range(4)], 60)[1] == 4
    # Repeated label rows count each, and are drawn each.
    one, zero, drawn = fitted([(0, 1)] * 300 + [(i, 1) for i in range(1, 600) if i % 3] + labels[600:], 60)
    assert (one, zero) == (60, 60) and 12 <= drawn <= 40


NAMES = "password|passwd|secret|token|api_key|apikey"
CASED = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in x) for x in NAMES.split("|"))
PLAIN = [
    ("assign", rf"""(?:{CASED})["']?[ ]*[:=][ ]*["']?(?P<x>[A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"(?P<x>AKIA[A-Z0-9]+)", 20),
    ("hex", r"(?P<x>[0-9a-f]+)", 24),
]


def _plain(text):
    out = []
    for k, (kind, pattern, least) in enumerate(PLAIN):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m["x"]) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


PIECES = [
    "password", "PassWd", "ſecret", "secret", "toKen", "toKen", "api_key", "APIKEY", " = ", ":", "=", "'", '"', "abc123", "hunter2x", "AKIA", "AKIA" + "Q7" * 8,
    "0123456789abcdef" * 2, "deadbeef", "é", "漢", "\n", " ", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "xoxb-123456789012",
]


@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=9).map("".join), max_size=6))
@settings(max_examples=300, deadline=None)
def test_index_loses_no_span(texts):
    scanner = secrets.Scanner(secrets.BASE + secrets.MORE)
    found = scanner.spans(texts)
    for text, spans in zip(texts, found):
        assert [f"{scanner.rules[k][0].kind}:{a}:{b}" for a, k, b in spans if k < 3] == _plain(text)
        more = [m.span() for r in secrets.MORE for m in re.finditer(r.pattern, text) if m.end() - m.start() >= r.least]
        assert [(a, b) for a, k, b in spans if k >= 3] == sorted(more)


@pytest.mark.parametrize("pattern, text", [("ab[cd]e", b"abc"), ("(foo|bar)baz", b"foo"), ("AKIA[A-Z]+", b"aki")])
def test_queries_name_mandatory_trigrams(pattern, text):
    query = secrets.trigram_query(pattern)
    assert text in secrets._query_grams(query)


def test_rules_without_trigrams_search_everything():
    assert secrets.trigram_query("[0-9a-f]+") == secrets.ALL
    assert secrets.trigram_query("a?b?c?") == secrets.ALL


def test_postings_spare_clean_texts():
    scanner = secrets.Scanner(secrets.BASE)
    texts = ["nothing here"] * 50 + ["my secret: abcdef1"]
    assert scanner.candidates(texts)[0].tolist() == [50] and len(scanner.candidates(texts)[2]) == 51


def test_scan_of_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.doc_id, d.text) for d in docs] + [(-1, None), (-1, None), (None, "token=abcdef"), (-2, "x" * 300000 + " AKIA" + "A" * 20)]
    given_docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "'a' AS spans")
    found = secrets.span_digests(secrets.scan(given_docs)).collect()
    want = []
    for key, text in rows:
        spans = _plain(text)
        counts = [sum(x.startswith(kind + ":") for x in spans) for kind, *_ in PLAIN]
        want.append((str(key), *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found) == sorted(want)
    assert sum(r.n_assign + r.n_access + r.n_hex for r in found) > 1
    assert secrets.scan(given_docs.where("false")).count() == 0
