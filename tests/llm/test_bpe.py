"""The transducer and the decoder against the tokenizers library and plain merging."""

import hashlib
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemill.llm import bpe, registered
from tidemill.llm.memory import releasing

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LIBRARY = {x: Tokenizer.from_file(x) for x in (WORD, BYTE)}
OURS = {x: (bpe.Encoder(x), bpe.Decoder(x)) for x in (WORD, BYTE)}
HARD = [
    None, "", " ", "Hello, World's 12 <|endoftext|>x <|startoftext|>", "ΟΔΟΣ ΣΣ İI ẞ", "é ÀB Å ẛ̣", "a\x1cb\x85c\xa0d​e",
    "🙂👩‍👩‍👧 漢字 ｶﾞ", "x" * 3000, "ab" * 2500 + " the", "thethe" * 700, "\n\n  a  \n", "don't I'LL we'Re '", "ǅ ŉ ﬁ", "\x00\x01 \x7f",
    "١٢٣ ½ Ⅷ", "| a.,;:!?| ...", " ".join(f"w{i}ord" for i in range(40000)),
]


def _both(path, text):
    ids = LIBRARY[path].encode(text, add_special_tokens=False).ids
    return ids, LIBRARY[path].decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_hard_texts(path):
    encoder, decoder = OURS[path]
    for text, found in zip(HARD, encoder.encode_many(x or "" for x in HARD)):
        ids, back = _both(path, text or "")
        assert np.frombuffer(found, np.int32).tolist() == ids
        assert decoder.decode(ids) == back


@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"]), max_size=60) | st.text(alphabet="aàAÀsS'tTe \n.,!12ÉﬁΣ", max_size=80))
@settings(max_examples=400, deadline=None)
def test_any_text(text):
    for path, (encoder, decoder) in OURS.items():
        ids, back = _both(path, text)
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == ids
        assert decoder.decode(ids) == back


@given(st.lists(st.integers(0, 50256), max_size=30))
@settings(max_examples=200, deadline=None)
def test_any_ids_decode(ids):
    assert OURS[BYTE][1].decode(ids) == LIBRARY[BYTE].decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_a_long_word_is_read_by_slices(path):
    """The transducer's memory does not grow with the word; borders of slices do not show."""
    encoder = OURS[path][0]
    for text in ("é" * (bpe.SLICE - 1) + "漢字" * 3, "ab" * bpe.SLICE + "é"):
        assert [encoder.ids[x] for x in encoder.tokens(text)] == _both(path, text)[0]
    word = "ab" * 1_000_000
    tracemalloc.start()
    try:
        for _ in zip(range(300), encoder.tokens(word)):
            pass
        assert tracemalloc.get_traced_memory()[1] < 1 << 20
    finally:
        tracemalloc.stop()


def test_stable_tokens_are_those_of_the_whole_word():
    rng = random.Random(3)
    for _ in range(300):
        letters = "abc"[: rng.randint(1, 3)]
        made, merges = set(letters), []
        while len(merges) < rng.randint(1, 9):
            a, b = rng.choice(sorted(made)), rng.choice(sorted(made))
            if a + b in made:
                break
            made.add(a + b)
            merges.append((a, b))
        if not merges:
            continue
        word = [rng.choice(letters) for _ in range(rng.randint(0, 300))]
        table = bpe.Merges(merges)
        block, bpe.BLOCK = bpe.BLOCK, 3
        try:
            assert list(table.stream(word)) == table.merged(word)
        finally:
            bpe.BLOCK = block


def test_tokens_come_before_the_word_has_ended():
    encoder = OURS[WORD][0]
    endless = (encoder.letters[b] for b in iter(lambda: random.Random(5).choice(b"aeinrst"), None))
    stream = encoder.merges.stream(endless, len)
    assert len([next(stream) for _ in range(200)]) == 200


def test_a_list_that_makes_a_token_twice_is_refused():
    with pytest.raises(ValueError):
        bpe.Merges([("a", "b"), ("ab", "c"), ("b", "c"), ("a", "bc")])


def test_whole_table(spark, sf):
    found = {r.doc_id: r for r in registered.bpe_round_trip(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        ids, back = _both(WORD, d.text or "")
        r = found[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_hard_rows(spark):
    rows = [(i, x, "ids", 1) for i, x in enumerate(HARD)] + [(None, "no id", None, None), (1, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    found = bpe.decoded(bpe.encoded(docs, BYTE), BYTE).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in found) == sorted((str(k), x or "") for k, x, *_ in rows)
    assert bpe.digests(bpe.decoded(bpe.encoded(docs.where("false"), WORD), WORD)).count() == 0


def test_remembered_pieces_take_little_memory():
    """Pieces not seen for long are forgotten, ids stay the same, and those seen again stay."""
    encoder = bpe.Encoder(WORD)
    texts = [" ".join(f"w{i}x{j}" for j in range(12_000)) + " often" for i in range(40)]
    tracemalloc.start()
    try:
        for text in texts:
            found = encoder.encode(text)
        assert tracemalloc.get_traced_memory()[1] < 52 << 20
    finally:
        tracemalloc.stop()
    assert "often" in encoder.known and texts[0].split()[0] not in encoder.known | encoder.older
    for text, ids in ((texts[0], encoder.encode(texts[0])), (texts[-1], found)):
        assert np.frombuffer(ids, np.int32).tolist() == _both(WORD, text)[0]


def test_workers_give_memory_back(monkeypatch):
    """After each batch that is done, and once more at the end, Arrow's free memory goes back."""
    released = []
    pool = SimpleNamespace(release_unused=lambda: released.append(None))
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    batches = [pa.RecordBatch.from_pydict({"key": [i]}) for i in range(3)]
    assert list(releasing(lambda rows: rows)(iter(batches))) == batches
    assert len(released) == 4
