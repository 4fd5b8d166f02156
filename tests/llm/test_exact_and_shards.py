"""Exact duplicates and shards on small hard tables."""

import re
from collections import defaultdict
from zlib import crc32

import pytest

from tidemill.llm import exact, sharding

SCHEMA = "doc_id long, text string, key string, recipe int, part string"
LONG = "".join(f"word{i} und {i * i}\n" for i in range(30000))
ROWS = [
    (1, "a b", "x", 1, None), (2, "ab", None, 2, "p"), (3, " a\tb\n", "x", 3, None), (4, None, None, None, None),
    (5, "", "", 0, ""), (6, LONG, "l", 1, None), (7, LONG.replace("\n", " \n"), "l", 1, None), (8, LONG + "x", "l", 1, None),
    (9, "é b", None, None, None), (9, "é b", None, None, None), (10, "éb", None, None, None), (None, "ab", None, 0, None),
    (11, "q r", None, None, None), (12, "qr", None, None, None),
]


def _expected(rows):
    groups = defaultdict(list)
    for key, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), key is None, key or 0, key))
    return sorted((str(k), str(min(g)[3]), len(g)) for g in groups.values() for *_, k in g)


@pytest.mark.parametrize("digest", ["xxhash64", "char_length"])
def test_equal_texts_share_the_row_that_stays(spark, digest):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = exact.exact_duplicates(docs, digest=digest).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in found) == _expected(ROWS)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_survivors_keep_all_columns_once(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = exact.without_exact_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 4, 7, 8, 9, 11, 12]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact.exact_duplicates(docs).count() == 0
    assert exact.without_exact_duplicates(docs).count() == 0
    assert sharding.sharded(docs).count() == 0


def test_shards_hold_near_equal_bytes_and_gapless_slots(spark):
    rows = [(i, "copy " * 40, None, None, None) for i in range(400)]
    rows += [(1000 + i, f"text {i} " * (i % 37), None, i, "p") for i in range(800)] + [(5000, None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = sharding.sharded(docs).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    sums, slots = defaultdict(int), defaultdict(list)
    for r in found:
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == crc32(texts[r.doc_id].encode())
        assert r.law == "bytes" and r.grown_shard is None
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    largest = max(r.size for r in found)
    assert set(sums) == set(range(8)) and max(sums.values()) - min(sums.values()) <= 2 * largest
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_copies_without_ids_of_their_own_are_divided(spark):
    """A third of all bytes in rows without an id, a quarter in one row repeated in full."""
    rows = [(None, "copy " * 40, None, None, None)] * 400 + [(7, "again " * 40, None, None, None)] * 250
    rows += [(1000 + i, f"text {i} " * (i % 30), None, i, "p") for i in range(600)]
    found = sharding.sharded(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    sums, slots = defaultdict(int), defaultdict(list)
    for r in found:
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    largest = max(r.size for r in found)
    assert set(sums) == set(range(8)) and max(sums.values()) - min(sums.values()) <= 8 * largest
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_a_small_group_of_equal_texts_stays_together(spark):
    rows = [(i, f"pair {i // 2} " * 9, None, None, None) for i in range(2000)]
    found = sharding.sharded(spark.createDataFrame(rows, SCHEMA)).collect()
    homes = defaultdict(set)
    for r in found:
        homes[r.doc_id // 2].add(r.shard)
    assert all(len(x) == 1 for x in homes.values())


def test_ranges_are_cut_again_until_small(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 4)
    monkeypatch.setattr(sharding, "PIECES", 4)
    rows = [(i, "same", None, None, None) if i % 3 == 0 else (i, f"t{i}", None, None, None) for i in range(300)]
    found = sharding.sharded(spark.createDataFrame(rows, SCHEMA), shards=5).collect()
    assert sorted(r.doc_id for r in found) == list(range(300))
    assert sorted((r.shard, r.slot) for r in found) == sorted({(r.shard, r.slot) for r in found})
