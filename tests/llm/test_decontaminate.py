"""Containment search against exact counting of every item in every document."""

import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from tidemill.llm import decontaminate, registered

def _set(text, n=5):
    words = re.findall("[0-9a-z\x80-\x9f\xc0-\u1fff\u2070-\u2fff\u3040-\U0010ffff]+", (text or "").lower())
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def _whole(text):
    """Shingles of all widths: an item of fewer than five words is one of its own width."""
    return set().union(*(_set(text, n) for n in range(1, 6)))


def _pairs(docs, items, percent=80):
    sets = [(k, _whole(x)) for k, x in docs]
    out = []
    for item, text in items:
        own = _set(text)
        for key, whole in sets:
            if own and 100 * len(own & whole) >= percent * len(own):
                out.append((key, item, len(own), len(own & whole)))
    return sorted(out, key=str)


def _rows():
    rng = random.Random(6)
    word = lambda: f"wé{rng.randint(0, 300)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 70)))) for i in range(60)]
    items += [(1, items[1][1]), (1, "another text of the same id here"), (70, None), (71, ""), (72, " .!? "), (None, "an item that has no id"), (73, "Two words")]
    items += [(74, "alpha beta gamma delta"), (75, "alpha, BETA gamma"), (76, "omega"), (77, "Sätze ohne")]
    docs = [(1, None), (2, ""), (3, "..."), (4, "two WORDS"), (5, "two words more"), (6, "We say alpha beta; gamma delta and then " + "much more of text " * 200), (7, "Omega!"), (8, "two more words"),
            (9, "alpha beta " + "gamma " * 9), (None, "An item, that has no ID."), (None, "An item, that has no ID.")]
    for k in range(200):
        words = [word() for _ in range(rng.choice([3, 40, 900]))]
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 3)):
                if part:
                    part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = part
        docs.append((10 + k, rng.choice([" ", ", ", "\n", "\u2014", "\xa0"]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    docs += [docs[-1], (500, " ".join([docs[-1][1]] + [word() for _ in range(30000)]))]
    return docs, items


@pytest.mark.parametrize("sent", [decontaminate.SENT_BYTES, 0])
def test_same_pairs_as_exact_counting(spark, sent):
    docs, items = _rows()
    table = spark.createDataFrame([(k, x, "i", 1) for k, x in docs], "doc_id long, text string, item string, n int").repartition(3)
    bench = spark.createDataFrame([(k, x, "k") for k, x in items], "item_id long, text string, key string")
    found = decontaminate.contaminated(table, bench, sent_bytes=sent).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.common) for r in found), key=str) == _pairs(docs, items)
    assert all(r.containment == r.common / r.n_shingles for r in found)
    left = decontaminate.without_contaminated(table, bench, sent_bytes=sent)
    hit = {(k, x) for k, x in docs for _, i in items if _set(i) and 100 * len(_set(i) & _whole(x)) >= 80 * len(_set(i))}
    assert left.columns == table.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted((str(k), str(x)) for k, x in docs if (k, x) not in hit)


@pytest.mark.parametrize("sent", [decontaminate.SENT_BYTES, 0])
def test_empty_tables(spark, sent):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(docs.where("false"), bench, sent_bytes=sent).count() == 0
    assert decontaminate.contaminated(docs, bench.where("false"), sent_bytes=sent).count() == 0
    assert decontaminate.without_contaminated(docs, bench.where("false"), sent_bytes=sent).count() == 1


@given(st.integers(1, 5000), st.sampled_from([50, 80, 95]))
@settings(max_examples=200, deadline=None)
def test_a_sketch_holds_a_contained_shingle(n, percent):
    missed = n - -(-n * percent // 100)
    assert decontaminate.sketch_size(n, percent) > missed
    assert decontaminate.sketch_size(n, percent) <= decontaminate.sketch_size((1 << n.bit_length()) - 1, percent)


def test_whole_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    found = registered.decontamination(spark, sf).collect()
    want = _pairs(docs, items)
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.common) for r in found), key=str) == want and want
