"""The n-gram Jaccard join against all pairs."""

import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemill.llm import jaccard, registered, shingles
from tidemill.llm.components import components, written

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def _groups(rows, n, percent):
    """(id, size, least id of the component) of each row, by all pairs."""
    sets = [_set(text, n) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and common * 100 >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[max(find(i), find(j))] = min(find(i), find(j))
    best = {}
    for i, (key, _) in enumerate(rows):
        best.setdefault(find(i), []).append(key)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in best.items()}
    return [(key, len(s), least[find(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def _varied(seed, count, length, edits):
    rng, rows = random.Random(seed), []
    for i in range(count):
        if rows and rng.random() < 0.7:
            words = (rng.choice(rows[-12:])[1] or "").split()
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randint(0, 1)] = [f"w{rng.randint(0, 30)}"] * rng.randint(0, 2)
        else:
            words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, length))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


HARD = [(None, "no id here at all"), (None, "no id here at all"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "é É"), (8, "É É"), (9, "x " * 9000), (10, "x " * 9001), (4, "one")]


def _found(spark, rows, n, percent, **how):
    docs = spark.createDataFrame([(k, x, "n", 1) for k, x in rows], "doc_id long, text string, node string, n int").repartition(4)
    return [tuple(r) for r in jaccard.similar_groups(docs, n=n, percent=percent, **how).collect()]


@pytest.mark.parametrize("n, percent, seed, candidates", [(3, 90, 1, "segments"), (5, 80, 2, "segments"), (5, 80, 3, "rare")])
def test_same_components_as_all_pairs(spark, n, percent, seed, candidates):
    rows = HARD + [(100 + k, x) for k, x in _varied(seed, 420, 90, 5)]
    assert sorted(map(str, _found(spark, rows, n, percent, candidates=candidates))) == sorted(map(str, _groups(rows, n, percent)))


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    rng, base = random.Random(9), [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(120)] = f"r{rng.randint(0, 9999)}"
        rows.append((1000 - i, " ".join(words)))
    assert sorted(_found(spark, rows, 3, 90)) == sorted(_groups(rows, 3, 90))


def test_no_task_gets_a_common_segment_whole(spark):
    """Groups are folded, joined and hashed: no window over a segment, and blocks of all members."""
    nodes = [(1, node, 50) for node in range(3000)] * 2 + [(2, 7, 50), (2, 7, 50), (3, 8, 50), (3, 9, 50)]
    shared = jaccard._shared(spark.createDataFrame(nodes, "segment long, node long, n long").repartition(7))
    assert sorted(tuple(r) for r in shared.select("segment", "node", "n", "centre").collect()) == [
        *[(1, node, 50, 0) for node in range(3000)], (3, 8, 50, 8), (3, 9, 50, 8)]
    rows = shared.where("segment = 1").withColumns({"members": F.lit(3000).cast("long"), "least": F.col("node")})
    vectors = rows.select("node", F.array(*[F.lit(4)] * 16).alias("sizes"))
    blocks = jaccard._blocks(rows, vectors, 90)
    for frame in (shared, blocks):
        assert "Window" not in frame._jdf.queryExecution().optimizedPlan().toString()
    found = blocks.groupBy("one", "two").agg(F.countDistinct("node").alias("n")).collect()
    # Every two of six blocks meet, and each with itself.
    assert len(found) == 21 and all(r.n < 2 * 2 * jaccard.BLOCK for r in found)
    assert sum(r.n for r in found if r.one == r.two) == 3000


@given(st.integers(20, 400), st.integers(0, 60), st.randoms(use_true_random=False), st.sampled_from([80, 90, 95]))
@settings(max_examples=300, deadline=None)
def test_similar_sets_share_a_segment(size, edits, rng, percent):
    pool = shingles.mix(np.arange(1, 3000, dtype=np.uint64) * np.uint64(rng.randint(1, 1 << 40) * 2 + 1))
    one = set(rng.sample(pool.tolist(), size))
    two = set(one)
    for _ in range(min(edits, size // 3)):
        (two.discard if rng.random() < 0.5 else two.add)(rng.choice(pool.tolist()) if rng.random() < 0.5 else rng.choice(sorted(one)))
    if not two or len(one & two) * 100 < percent * len(one | two) or one == two:
        return
    classes = jaccard.Classes(percent)
    give = lambda x: set(classes.segments(np.array(sorted(x), np.uint64)).tolist())
    assert give(one) & give(two)


@given(st.integers(1, 400), st.integers(0, 60), st.randoms(use_true_random=False), st.sampled_from([80, 90, 95]))
@settings(max_examples=300, deadline=None)
def test_similar_sets_meet_at_a_probe(size, edits, rng, percent):
    pool = shingles.mix(np.arange(1, 3000, dtype=np.uint64) * np.uint64(rng.randint(1, 1 << 40) * 2 + 1))
    one = set(rng.sample(pool.tolist(), size))
    two = set(one)
    for _ in range(min(edits, size // 3)):
        (two.discard if rng.random() < 0.5 else two.add)(rng.choice(pool.tolist()) if rng.random() < 0.5 else rng.choice(sorted(one)))
    if not two or len(one & two) * 100 < percent * len(one | two) or one == two:
        return
    common = np.array(sorted(rng.sample(sorted(one), rng.randint(0, len(one)))), np.uint64)
    order = jaccard.Order(common, np.array([rng.randint(4, 9) for _ in common], np.int64))
    give = lambda x: set(order.probes(np.array(sorted(x), np.uint64), percent).tolist())
    assert give(one) & give(two)


def test_common_ngrams_come_last_and_are_bounded(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"w{i}x{j}" for j in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    order = jaccard.common_order(docs, "text", 5, "space")
    assert len(order.common) == 56 and set(order.counts.tolist()) == {40}
    shared = jaccard._shared(jaccard._signatures(docs, "text", 5, 80, "space", order))
    assert shared.count() == 0
    monkeypatch.setattr(jaccard, "ORDERED", 20)
    plain = jaccard.common_order(docs, "text", 5, "space")
    assert len(plain.common) == 0
    # Without counts texts meet at the passage; the result is the same.
    assert jaccard._shared(jaccard._signatures(docs, "text", 5, 80, "space", plain)).count() > 0
    assert sorted(map(tuple, jaccard.similar_groups(docs, n=5, percent=80, candidates="rare").collect())) == sorted(_groups(rows, 5, 80))


def test_components_of_long_chains(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (7, 7)]
    rng.shuffle(links)
    found = {r.node: r.least for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


def test_one_row_of_each_component_stays(spark):
    rows = [(k, x) for k, x in HARD] + [(100 + k, x) for k, x in _varied(5, 120, 60, 4)]
    docs = spark.createDataFrame([(k, x, "n", 1) for k, x in rows], "doc_id long, text string, node string, n int")
    kept = jaccard.without_similar(docs)
    assert kept.columns == docs.columns
    want = {(k, c) for (k, n, c) in _groups(rows, 5, 80) if n}
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(str(k) for k, x in found if _set(x, 5)) == sorted({str(c) for _, c in want})
    assert sum(not _set(x, 5) for _, x in found) == sum(not _set(x, 5) for _, x in rows)
    assert jaccard.without_similar(docs.where("false")).count() == 0


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = registered.jaccard_join(spark, sf)
    assert sorted(map(tuple, found.collect())) == sorted(_groups(rows, 3, 90))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_groups(empty).count() == 0


def test_whole_sets_go_to_blocks_only_where_a_link_is_left(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 2)
    sent, links = [], jaccard._block_links

    def counted(blocks, contents, percent):
        sent.append(blocks.count())
        return links(blocks, contents, percent)

    monkeypatch.setattr(jaccard, "_block_links", counted)
    rng, base = random.Random(11), [f"b{i}" for i in range(150)]
    rows = []
    for i in range(80):
        words = list(base)
        at = rng.randrange(120)
        words[at : at + rng.randint(4, 24)] = [f"r{rng.randint(0, 9999)}" for _ in range(rng.randint(4, 24))]
        rows.append((i, " ".join(words)))
    want = sorted(_groups(rows, 5, 80))
    for candidates in ("segments", "rare"):
        assert sorted(_found(spark, rows, 5, 80, candidates=candidates)) == want
    assert len({c for _, _, c in want}) > 5
    assert sum(sent) < 400  # of copies in all groups


@given(st.lists(st.tuples(st.integers(20, 700), st.integers(0, 40)), min_size=2, max_size=9), st.integers(0, 1 << 40), st.sampled_from([80, 90]))
@settings(max_examples=200, deadline=None)
def test_parities_keep_all_similar_pairs(shapes, seed, percent):
    rng = random.Random(seed)
    pool = shingles.mix(np.arange(1, 2000, dtype=np.uint64) + np.uint64(seed)).tolist()
    base = rng.sample(pool, 700)
    sets = [set(base[:size]) - set(rng.sample(base[:size], min(edits, size // 2))) | set(rng.sample(pool, edits)) for size, edits in shapes]
    order = range(len(sets))
    for one, two in ((0, 0), (0, 1)):
        frame = pd.DataFrame({
            "one": one, "two": two, "block": [one if one == two else k % 2 for k in order], "n": [len(x) for x in sets],
            "least": [k // 2 for k in order], "bits": [jaccard.parity(np.array(sorted(x), np.uint64)) for x in sets],
        })
        found = [tuple(sorted(x)) for x in zip(*(x.tolist() for x in jaccard._across(frame, percent)))]
        assert len(found) == len(set(found))
        met = {(i, j) for i in order for j in order if i < j and i // 2 != j // 2 and (one == two or (j - i) % 2)}
        assert set(found) <= met
        assert {(i, j) for i, j in met if len(sets[i] & sets[j]) * 100 >= percent * len(sets[i] | sets[j])} <= set(found)
        assert not {(i, j) for i, j in met if len(sets[i] & sets[j]) * 100 < (percent - 12) * len(sets[i] | sets[j])} & set(found)


def test_written_tables_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: sum(f.getName().startswith("shuffle_") for f in (x.apply(i) for x in [disk.getAllFiles()] for i in range(x.size())))
    before = held()
    rows = spark.range(20000).selectExpr("id % 977 AS k", "id AS v")
    table = written(rows.hint("merge").join(spark.range(977).selectExpr("id AS k"), "k").groupBy("v").count(), "freed")
    end = time.time() + 20
    while held() > before and time.time() < end:
        time.sleep(0.2)
    assert held() <= before
    assert table.count() == 20000
