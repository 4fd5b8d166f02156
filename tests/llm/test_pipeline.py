"""The pipeline against plain versions of its stages, and its stages on hard rows."""

import hashlib
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontaminate, test_jaccard
from tidemill.llm import quality


def _expected(docs, items, accepted):
    rows = [d for d in docs if d.doc_id in accepted]
    best = {}
    for d in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", d.text or "")
        best.setdefault(key, []).append((-len(d.text or ""), d.doc_id))
    first = {min(x)[1] for x in best.values()}
    rows = [(d.doc_id, d.text) for d in rows if d.doc_id in first]
    groups = test_jaccard._groups(rows, 5, 80)
    rows = [r for r, (key, n, least) in zip(rows, groups) if not n or key == least]
    hit = {key for key, *_ in test_decontaminate._pairs(rows, items)}
    return [(key, text) for key, text in rows if key not in hit]


@pytest.fixture(scope="module")
def found(spark, sf):
    return {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}


def test_same_rows_as_plain_stages(spark, sf, found):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.score(table, quality.learn(table, labels), keep=[table["doc_id"]]).collect()
    accepted = {r.row.doc_id for r in scored if r.predicted}
    assert 0 < len(accepted) < table.count()
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = _expected(table.collect(), items, accepted)
    assert set(found) == {key for key, _ in want}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for key, text in want:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        r = found[key]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_stages_keep_columns_of_hard_and_empty_tables(spark, sf):
    kind = "doc_id long, text string, lang string, source string, n_chars long, row string, key int, `tie` string, body string"
    rows = [(i, x, None, None, None, "r", 1, None, "b") for i, x in enumerate([None, "", " ", "one", "Two words", "x " * 50000])]
    rows += [(None, "no id", None, None, None, None, None, None, None)] * 2
    for table in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == table.columns
            docs = spark.createDataFrame(out.collect(), table.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
        assert last.count() == docs.count()
