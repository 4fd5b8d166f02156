"""The table of last tokens and the decoder against the sentencepiece library and plain merging."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from tidemill.llm import pieces, registered

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ENCODER, DECODER = pieces.Encoder(PATH), pieces.Decoder(PATH)
NAMES = list(ENCODER.ids)
HARD = [
    "", " ", "  Hello   World  ", "\n\n a\t", "▁a ▁▁b", "漢字 ｶﾞ🙂👩‍👩‍👧", "\x00\x01", "é�", " " * 37, "a" + " " * 15 + "b",
    "Éa__b 12 3_4 don't", "x y　z\xa0", "²½ª Ⅷ٣ x² 10²", "\x1c\x85", "<s> </s> <unk> <0x41>", "x" * 30000, "ab" * 30000, " " * 30000,
    "the " * 9000,
]


def _same(text):
    ids = LIBRARY.encode(text)
    assert ENCODER.encode(text) == ids
    assert DECODER.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", HARD, ids=range(len(HARD)))
def test_hard_texts(text):
    _same(text)


def test_pieces_side_by_side():
    rng = random.Random(5)
    for _ in range(3000):
        blank = rng.choice([" ", "▁"])
        _same("".join(rng.choice(NAMES) for _ in range(rng.randint(1, 8))).replace("▁", blank))


@given(st.text(max_size=60) | st.text(alphabet="  aethinsr\n.,1é²'", max_size=80))
@settings(max_examples=400, deadline=None)
def test_any_text(text):
    _same(text.encode("utf-8", "ignore").decode())


@given(st.lists(st.integers(0, 31999) | st.integers(0, 2) | st.integers(3, 258), max_size=30), st.integers(1, 4))
@settings(max_examples=400, deadline=None)
def test_any_ids_decode_in_any_slices(ids, size):
    assert "".join(DECODER.feed(ids[i : i + size] for i in range(0, len(ids), size))) == LIBRARY.decode(ids)


def test_pairs_against_plain_merging():
    rng = random.Random(9)
    for _ in range(4000):
        a, b = (ENCODER.ids[rng.choice(NAMES)] for _ in range(2))
        left = [x for x, _ in ENCODER.merged(NAMES[a - 259] + NAMES[b - 259])]
        assert ENCODER.compatible(a, b) == (left == [ENCODER.names[a], ENCODER.names[b]])


def test_whole_texts_and_chunks_give_the_same():
    whole = pieces.Encoder(PATH)
    whole.cut = None
    for text in [*HARD, "Mixed text, with 3 lines.\n  and blanks²\n"]:
        assert whole.encode(text) == ENCODER.encode(text)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    said = sentencepiece_model_pb2.ModelProto()
    said.ParseFromString(open(PATH, "rb").read())
    said.trainer_spec.model_type = 1
    other = tmp_path / "other.model"
    other.write_bytes(said.SerializeToString())
    with pytest.raises(ValueError):
        pieces.Encoder(str(other))


def test_hard_rows_in_spark(spark):
    rows = [(i, x, "en") for i, x in enumerate(HARD)] + [(None, "null id", None), (7, None, None), (7, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = pieces.decoded(pieces.encoded(docs, PATH), PATH)
    assert found.columns == ["doc_id", "ids", "decoded"]
    want = sorted(((i, LIBRARY.encode(x or "")) for i, x, _ in rows), key=repr)
    got = found.collect()
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=repr) == want
    assert all(r["decoded"] == LIBRARY.decode(list(r["ids"])) for r in got)
    assert pieces.digests(pieces.decoded(pieces.encoded(docs.limit(0), PATH), PATH)).collect() == []


def test_query_over_whole_documents(spark, sf):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = LIBRARY.encode(row["text"] or "")
        want.append((row["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    found = registered.QUERIES["op11_sentencepiece"](spark, sf)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(want)
