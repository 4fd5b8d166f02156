"""Benchmark items inside documents, by MinHash containment search over size partitions.

Items and documents are sets of five-word shingles, ordered by one hash.  An item's sketch
is its least hashes.  An item of n shingles that is contained to at least c misses at most
(1 - c) n of them, so with floor((1 - c) n) + 1 least hashes in its sketch at least one is
a shingle of the document, however long that is.  Items are partitioned by size: all of a
partition have sketches of the size that its largest item needs, and a document is probed
with those of its hashes that lie below the partition's greatest sketch hash.

A hit names a candidate (document, item); it is verified by counting the item's shingles
in the document exactly.  Sketches of a checked size go to the tasks whole, so documents are read once and do
not move; a larger benchmark meets the documents' hashes in a shuffled join.

* Words are runs of what is neither white space nor ASCII or general punctuation, lower-cased.
  An item of fewer than five words is one shingle of its own width; documents are probed with
  every width that the benchmark holds, so it is found inside documents of any length.
* Null or wordless items match nothing; null or wordless documents contain nothing.
* Repeated items and repeated documents are rows of their own.
* Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemill.llm.components import written
from tidemill.llm.memory import releasing
from tidemill.llm.shingles import Words, ngram_hashes, shingle_set, text_words

WORDS = 5
PERCENT = 80
# Punctuation and blanks beyond ASCII: Latin-1, general and CJK signs.
SIGNS = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f]")
SENT_BYTES = 8 << 20  # of sketches and item sets, up to which tasks get them whole
PART = 500            # documents hashed at once


def folded(text: str | None) -> str:
    text = (text or "").lower()
    return text if text.isascii() else SIGNS.sub(" ", text)


def sketch_size(n: int, percent: int) -> int:
    """Least hashes of which one must be contained, if ``percent`` of ``n`` are."""
    return n * (100 - percent) // 100 + 1 if n else 0


def item_sketches(items: DataFrame, id: str, text: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, item, n, size_class, width, shingle, in_sketch): a row for each shingle of each distinct item.

    ``width`` is the number of words in its shingles.  ``item`` names an id with its text.  The class is the power of two above the size; all
    sketches of a class have the size that its largest item needs.
    """
    given = items.select(items[id].alias("key"), items[text].cast("string").alias("body")).where("body IS NOT NULL").distinct()
    given = given.select("key", F.xxhash64("key", "body").alias("item"), "body")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Words("punctuation")
        for batch in batches:
            for at, own in enumerate(text_words(hasher, map(folded, batch.column(2).to_pylist()))):
                values = shingle_set(own, words)
                n, size_class = len(values), len(values).bit_length()
                least = sketch_size((1 << size_class) - 1, percent)
                this = pa.array([at] * n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(this), batch.column(1).take(this), pa.array([n] * n, pa.int32()),
                        pa.array([size_class] * n, pa.int32()), pa.array([min(words, len(own))] * n, pa.int32()),
                        pa.array(values.view(np.int64)), pa.array(np.arange(n) < least),
                    ],
                    names=["key", "item", "n", "size_class", "width", "shingle", "in_sketch"],
                )

    kind = given.schema["key"].dataType.simpleString()
    return given.mapInArrow(
        releasing(sketch), f"key {kind}, item long, n int, size_class int, width int, shingle long, in_sketch boolean"
    )


class Index:
    """Items' sets and, by size class, the sketches that documents are probed with."""

    def __init__(self, rows: pa.Table, percent: int) -> None:
        self.percent = percent
        item, shingle = rows["item"].to_numpy(), rows["shingle"].to_numpy().view(np.uint64)
        self.items, owner = np.unique(item, return_inverse=True)
        order = np.lexsort((shingle, owner))
        self.sets = np.split(shingle[order], np.cumsum(np.bincount(owner, minlength=len(self.items)))[:-1])
        self.classes = []
        sketch, size_class = rows["in_sketch"].to_numpy(), rows["size_class"].to_numpy()
        for k in np.unique(size_class):
            own = np.flatnonzero(sketch & (size_class == k))
            own = own[np.argsort(shingle[own], kind="stable")]
            self.classes.append((shingle[own], owner[own]))

    def hits(self, values: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(number of the document, number of the item, common shingles) of all containments."""
        sizes = [len(x) for x in values]
        flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(values)), sizes)
        pairs = [np.zeros(0, np.int64)]
        for hashes, items in self.classes:
            low = np.flatnonzero(flat <= hashes[-1])
            first = np.searchsorted(hashes, flat[low], side="left")
            many = np.searchsorted(hashes, flat[low], side="right") - first
            some = np.flatnonzero(many)
            at = np.repeat(first[some], many[some])
            at += np.arange(len(at)) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
            pairs.append(np.repeat(owner[low[some]], many[some]) * len(self.items) + items[at])
        for pair in np.unique(np.concatenate(pairs)).tolist():
            doc, item = divmod(pair, len(self.items))
            own, whole = self.sets[item], values[doc]
            at = np.searchsorted(whole, own)
            common = int((whole[np.minimum(at, len(whole) - 1)] == own).sum())
            if common * 100 >= len(own) * self.percent:
                yield doc, item, common


HIT = [StructField("item", LongType()), StructField("common", LongType())]


def _shingles(own: np.ndarray, widths: list[int]) -> np.ndarray:
    """A text's distinct shingles of all widths; hashes tell widths apart."""
    if len(widths) == 1:
        return shingle_set(own, widths[0])
    return np.unique(np.concatenate([ngram_hashes(own, n) for n in widths]))


def _parts(batch: pa.RecordBatch, hasher: Words, widths: list[int]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Shingle sets of the last column, PART documents at a time."""
    for begin in range(0, len(batch), PART):
        texts = batch.column(batch.num_columns - 1).slice(begin, PART).to_pylist()
        yield begin, [_shingles(x, widths) for x in text_words(hasher, map(folded, texts))]


def _sent(rows: DataFrame, index: Index, widths: list[int]) -> DataFrame:
    """(key, tie, item, common) of the documents (key, tie, body): tasks hold the index."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Words("punctuation")
        for batch in batches:
            for begin, values in _parts(batch, hasher, widths):
                found = list(index.hits(values))
                at = pa.array([begin + d for d, *_ in found], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at), batch.column(1).take(at),
                        pa.array([index.items[i] for _, i, _ in found], pa.int64()), pa.array([c for *_, c in found], pa.int64()),
                    ],
                    names=["key", "tie", "item", "common"],
                )

    return rows.mapInArrow(releasing(search), StructType([*rows.schema.fields[:2], *HIT]))


def _joined(rows: DataFrame, sketches: DataFrame, widths: list[int], percent: int) -> DataFrame:
    """The same for a benchmark of any size: hashes meet in joins."""
    # Hashes are unsigned: their order is that of signed numbers with the first bit turned.
    turned = F.col("shingle").bitwiseXOR(F.lit(-(1 << 63)))
    top = sketches.where("in_sketch").agg(F.max(turned).alias("top")).first()["top"]
    greatest = np.array([top or 0], np.int64).view(np.uint64)[0] ^ np.uint64(1 << 63)

    def shingles(batches: Iterator[pa.RecordBatch], least: bool) -> Iterator[pa.RecordBatch]:
        hasher = Words("punctuation")
        for batch in batches:
            for begin, values in _parts(batch, hasher, widths):
                own = [x[x <= greatest] if least else x for x in values]
                at = pa.array(np.repeat(np.arange(begin, begin + len(own)), [len(x) for x in own]), pa.int32())
                flat = np.concatenate(own).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(flat)], names=["key", "tie", "shingle"]
                )

    kind = StructType([*rows.schema.fields[:2], StructField("shingle", LongType())])
    probes = rows.mapInArrow(releasing(lambda x: shingles(x, True)), kind)
    met = sketches.where("in_sketch").select("shingle", "item")
    found = written(probes.join(met, "shingle").select("key", "tie", "item").distinct(), "candidates")
    names = found.select(F.col("key").alias("k"), F.col("tie").alias("t")).distinct()
    some = rows.join(names, rows["key"].eqNullSafe(names["k"]) & (rows["tie"] == names["t"]), "left_semi")
    whole = some.dropDuplicates(["key", "tie"]).mapInArrow(releasing(lambda x: shingles(x, False)), kind)
    own = sketches.select("item", "shingle", "n")
    pairs = found.join(own, "item")
    same = pairs["key"].eqNullSafe(whole["key"]) & (pairs["tie"] == whole["tie"]) & (pairs["shingle"] == whole["shingle"])
    counted = pairs.join(whole, same, "left_semi").groupBy("key", "tie", "item", "n").agg(F.count("*").alias("common"))
    return counted.where(F.col("common") * 100 >= F.col("n") * percent).select("key", "tie", "item", "common")


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(docs[id].alias("key"), F.xxhash64(body).alias("tie"), body.alias("body"))


def _hits(
    docs: DataFrame, items: DataFrame, id: str, text: str, item_id: str, item_text: str, words: int, percent: int, sent_bytes: int
) -> tuple[DataFrame, DataFrame, bool]:
    """(key, tie, item, common) of all containments, the items' sketches, and whether joins found them."""
    sketches = written(item_sketches(items, item_id, item_text, words, percent), "item-sketches")
    rows = _rows(docs, id, text)
    counts = {r["width"]: r["count"] for r in sketches.groupBy("width").count().collect()}
    widths = sorted({words, *counts})
    if 32 * sum(counts.values()) > sent_bytes:
        return _joined(rows, sketches, widths, percent), sketches, True
    table = sketches.select("item", "size_class", "shingle", "in_sketch").toArrow()
    return _sent(rows, Index(table, percent), widths), sketches, False


def contaminated(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", words: int = WORDS, percent: int = PERCENT, sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """Pairs: id, item id, n_shingles (of the item), common, containment; one for each row and item."""
    found, sketches, by_joins = _hits(docs, items, id, text, item_id, item_text, words, percent, sent_bytes)
    own = sketches.select("item", F.col("key").alias("item_key"), "n").distinct()
    # An item row that repeats is an item of its own.
    copies = items.groupBy(F.xxhash64(items[item_id], items[item_text].cast("string")).alias("item")).agg(F.count("*").alias("copies"))
    if by_joins:
        # Joins have found each (id, text) once; rows that repeat count again.
        repeats = _rows(docs, id, text).groupBy("key", "tie").agg(F.count("*").alias("times"))
        same = found["key"].eqNullSafe(repeats["key"]) & (found["tie"] == repeats["tie"])
        found = found.join(repeats, same).select(
            found["*"], F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
        ).drop("col")
    out = found.join(own, "item").join(copies, "item")
    out = out.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(
        F.col("key").alias(id), F.col("item_key").alias(item_id if item_id != id else "item"), F.col("n").alias("n_shingles"),
        "common", (F.col("common") / F.col("n")).alias("containment"),
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", words: int = WORDS, percent: int = PERCENT, sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    found, _, _ = _hits(docs, items, id, text, item_id, item_text, words, percent, sent_bytes)
    names = written(found.select(F.col("key").alias("k"), F.col("tie").alias("t")).distinct(), "contaminated")
    own = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id].alias("key"),
        F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("tie"),
    )
    return own.join(names, own["key"].eqNullSafe(names["k"]) & (own["tie"] == names["t"]), "left_anti").select("row.*")
