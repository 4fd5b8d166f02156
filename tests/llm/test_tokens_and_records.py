"""Length histograms and binary records against plain counts and exact round trips."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemill.llm import records, tokens

SCHEMA = "doc_id long, text string, key string, part int, file string"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, WORDS = Tokenizer.from_file(BYTES), records.WordIds(BYTES)
TEXTS = [
    None, "", " ", "a  b", "one two\nthree\n\nfour \n", "é ü ñ 漢字 🙂", "<|endoftext|> x", "a <|endoftext|> b", "don't we've 'tis",
    "tab\tand\x1cother\x0bspace nbsp em", "x" * 5000, "word, " * 4000, "Ends. \n", "\nBegins", "a\n b", "a\n\nb", "ßẞ ... !!!x",
]
ROWS = [(i * 3 % 17, x, "k", 1, None) for i, x in enumerate(TEXTS)] + [(None, "no id", None, None, None), (3, "again", None, 0, "f")] * 2


@given(st.lists(st.text(alphabet="ab é.,'\n\t 1!?ß漢<|endoftext> ", max_size=40), max_size=6))
@settings(max_examples=200, deadline=None)
def test_pieces_give_the_ids_of_whole_texts(texts):
    want = [np.array(LIBRARY.encode(x, add_special_tokens=False).ids, "<u2").tobytes() for x in texts]
    assert WORDS.of(texts) == want


ENCODING = tokens.rank_encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@given(st.text(alphabet="  \n\t\x0b\x1c\x85\xa0\u3000ab'.1", max_size=60))
@settings(max_examples=400, deadline=None)
def test_runs_of_white_space_are_counted_apart(text):
    before, tokens.LONG_RUN = tokens.LONG_RUN, re.compile(f"[{tokens.WHITE}]{{2,}}")
    try:
        assert tokens.encoded_length(ENCODING, text) == len(ENCODING.encode_ordinary(text))
    finally:
        tokens.LONG_RUN = before


def test_texts_of_any_length():
    n = 5_000_000
    assert tokens.encoded_length(ENCODING, " " * n) == n
    assert tokens.encoded_length(ENCODING, "a" * n) == len(ENCODING.encode_ordinary("a" * n))
    lines = tokens.encoded_length(ENCODING, "\n" * n)
    assert lines == n // 2
    assert tokens.encoded_length(ENCODING, "x" + "\n" * n + "y") == 2 + tokens.encoded_length(ENCODING, "\n" * (n - 1)) + 1
    assert tokens.encoded_length(ENCODING, " " * n + "word") == n - 1 + 1


def test_very_long_texts_in_spark(spark):
    docs = spark.createDataFrame([(1, " " * 2_000_000), (2, "\n" * 1_000_000 + "x"), (3, None)], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = tokens.encoded_lengths(docs, path, public_tokenizers.PATTERN, id="doc_id").collect()
    assert {r[0]: r[1] for r in found} == {1: 2_000_000, 2: 500_002, 3: 0}


def test_checksum_of_the_standard_example():
    data = np.frombuffer(b"123456789" + b"\0" * 32 + b"ab", np.uint8)
    found = records.Crc32c()(data, np.array([0, 9, 41]), np.array([9, 41, 43]))
    assert [hex(x) for x in found.tolist()][:2] == ["0xe3069283", "0x8a9136aa"]


def test_frames_round_trip_and_damage_is_noticed():
    crc = records.Crc32c()
    parts = [bytes(range(256)) * n for n in (1, 0, 7, 2)] + [b"xy"]
    sizes = np.array([len(x) for x in parts])
    data, offsets = records.frames(crc, np.frombuffer(b"".join(parts), np.uint8), sizes)
    assert [bytes(x) for x in records.unframed(crc, data, offsets, sizes)] == parts
    for at in (0, 9, 300, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframed(crc, bytes(broken), offsets, sizes)


def test_records_read_back_in_key_order(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    index = records.write_records(docs, str(tmp_path / "r"), BYTES, 2)
    found = sorted(records.record_digests(index, str(tmp_path / "r")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted([r[0] for r in ROWS], key=lambda x: (x is None, x))
    start, digests = 0, {}
    for key, text, *_ in ROWS:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
        digests.setdefault(key, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in found:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in digests[r.doc_id]
        start += r.n_tokens
    shuffled = records.read_records(index.orderBy("length", "nth").limit(7), str(tmp_path / "r")).collect()
    assert len(shuffled) == 7 and all(len(r.ids) == r.length for r in shuffled)
    assert records.drop_orphans(index, str(tmp_path / "r")) == 0


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    index = records.write_records(docs, str(tmp_path / "r"), BYTES, 2)
    assert records.record_digests(index, str(tmp_path / "r")).count() == 0
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    lengths = tokens.encoded_lengths(docs, path, public_tokenizers.PATTERN)
    assert tokens.limits(tokens.length_histogram(lengths)).count() == 0


def test_histogram_answers_every_limit(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BUCKET", 16)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = tokens.rank_encoding(path, public_tokenizers.PATTERN)
    counts = [len(encoding.encode_ordinary(r[1] or "")) for r in ROWS]
    lengths = tokens.encoded_lengths(spark.createDataFrame(ROWS, SCHEMA), path, public_tokenizers.PATTERN)
    histogram = tokens.length_histogram(lengths)
    report = tokens.limits(histogram)
    found = {r.context_limit: r for r in report.collect()}
    assert set(found) == set(counts)
    for limit, r in found.items():
        assert r.docs == counts.count(limit) and r.tokens == limit * r.docs
        assert r.docs_within == sum(x <= limit for x in counts) and r.docs_over == sum(x > limit for x in counts)
        assert r.tokens_within == sum(x for x in counts if x <= limit)
        assert r.truncated_tokens == sum(min(x, limit) for x in counts)
        assert r.share_within == r.docs_within / len(counts)
    for r in tokens.at_limits(histogram, [0, 3, 100, 10**9]).collect():
        assert r.truncated_tokens == sum(min(x, r.context_limit) for x in counts)
    for r in tokens.quantiles(report, [0.5, 0.99]).collect():
        assert r.n_tokens == sorted(counts)[int(np.ceil(r.share * len(counts))) - 1]
