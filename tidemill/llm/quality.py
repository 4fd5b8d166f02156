"""Quality scores by Naive Bayes support vectors.

Features are indicators of hashed n-grams: three bytes in a row, and one to three word
shapes in a row (runs of small letters, capitals and digits shrink to one sign each; a
word like the one before it has a mark).  Every indicator is scaled by the log ratio of
its frequencies in the two classes, counted over all labelled rows; the vectors have
length one.  A linear hinge-loss model is fitted to them by dual coordinate descent.

The descent runs on SAMPLE rows of each class (a parameter; all rows of a smaller class),
in one task: those with the least hashes of text, id and number of the label row, so that
copies of a text are drawn one by one.  Everything else covers all rows.

* Null text counts as empty and gets the model's constant as its score.
* Label rows without a quality, or without their document, teach nothing; repeated label
  rows count each.  Without labels the score is 0.5; with one class it is that class.
* score >= 0.5 is predicted 1.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tidemill.llm.memory import releasing
from tidemill.llm.shingles import Words, mix
from tidemill.session import new_folder

SAMPLE = 10_000   # rows of each class that the model is fitted to, at most
DRAW = 16         # bits of the draws that are counted to find the SAMPLE least
BITS = 17         # 2^BITS features
BLOCK = 48        # documents whose indicators are set at once
PART = 480        # documents whose features are held at once
COST = 1.0        # weight of the hinge loss
EPOCHS = 12
SMOOTHING = 1.0
STEEPNESS = 4.0   # of the logistic curve that turns margins into scores


def _signs() -> np.ndarray:
    """Byte -> sign of a word shape; small letters, capitals and digits are one sign each."""
    out = np.arange(256, dtype=np.uint8)
    out[[*range(97, 123), *range(128, 256)]] = 2
    out[65:91] = 1
    out[48:58] = 3
    return out


SIGNS = _signs()


class Features:
    def __init__(self, bits: int = BITS) -> None:
        self.size = 1 << bits
        self.words = Words()
        self.flags = np.zeros((BLOCK, self.size), bool)

    def of(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ascending feature numbers of all texts, one after the other, and where each text's begin."""
        parts, counts = [], []
        for begin in range(0, len(texts), BLOCK):
            some = texts[begin : begin + BLOCK]
            flags = self.flags[: len(some)]
            flags[:] = False
            for row, text in zip(flags, some):
                self._mark(row, (text or "").encode("utf-8", "surrogatepass"))
            found = np.flatnonzero(flags)
            parts.append((found % self.size).astype(np.int32))
            counts += np.bincount(found // self.size, minlength=len(some)).tolist()
        numbers = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return numbers, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def _mark(self, row: np.ndarray, data: bytes) -> None:
        mask = np.uint64(self.size - 1)
        raw = np.frombuffer(data, np.uint8)
        if len(raw) > 2:
            wide = raw.astype(np.uint32)
            codes = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
            row[(codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.size.bit_length() + 1)] = True
        words, _ = self.words.of(data)
        if not len(words):
            return
        signs = SIGNS[raw]
        shapes, _ = self.words.of(signs[np.append(True, signs[1:] != signs[:-1])].tobytes())
        shapes[1:] += (words[1:] == words[:-1]).astype(np.uint64)
        gram = shapes
        for n in range(1, 4):
            row[mix(gram + np.uint64(n)) & mask] = True
            gram = mix(gram[:-1]) + shapes[n:]


@dataclass(frozen=True)
class Model:
    """``weights`` of the features, with the class ratios already in them; ``ratios`` set vector lengths."""

    ratios: np.ndarray
    weights: np.ndarray
    constant: float = 0.0
    bits: int = BITS
    steepness: float = field(default=STEEPNESS)

    def margins(self, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        sums = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[starts])
        length = np.sqrt(np.maximum(sums(self.ratios[numbers] ** 2), 1e-12))
        return sums(self.weights[numbers]) / length + self.constant


def dual_descent(
    numbers: np.ndarray, starts: np.ndarray, labels: np.ndarray, ratios: np.ndarray, cost: float = COST,
    epochs: int = EPOCHS, seed: int = 0,
) -> tuple[np.ndarray, float]:
    """Weights and constant of the hinge-loss model on the scaled, normalised indicators.

    Each step solves the dual for one row exactly, within [0, cost]; rows are visited in a
    new order each epoch, until the largest projected gradient is small.
    """
    weights, constant = np.zeros(len(ratios)), 0.0
    duals = np.zeros(len(labels))
    signs = np.where(labels > 0, 1.0, -1.0)
    rows = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        at = numbers[a:b]
        x = ratios[at]
        rows.append((at, x / max(np.sqrt(x @ x), 1e-6)))
    squares = [float(x @ x) + 1.0 for _, x in rows]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(rows)).tolist():
            at, x = rows[i]
            gradient = signs[i] * (weights[at] @ x + constant) - 1.0
            old = duals[i]
            projected = min(gradient, 0.0) if old <= 0 else max(gradient, 0.0) if old >= cost else gradient
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(old - gradient / squares[i], 0.0), cost)
                duals[i] = new
                step = (new - old) * signs[i]
                weights[at] += step * x
                constant += step
        if worst < 0.01:
            break
    return weights, constant


def learn(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, bits: int = BITS,
) -> Model:
    """The model of all rows of ``labels`` that have a document.

    One pass over the labelled documents leaves, in the shared folder, the class counts of
    the features (one row per task and feature) and the sampled rows' features.
    """
    spark = docs.sparkSession
    said = labels.where(labels[label].isNotNull() & labels[id].isNotNull()).select(
        labels[id].alias("label_id"), (labels[label] > 0).cast("int").alias("label")
    )
    # Repeated label rows are numbered, which gives each of them a draw of its own.
    said = said.groupBy("label_id", "label").agg(F.count("*").alias("n"))
    said = said.select("label_id", "label", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[id].alias("key"), body.alias("body"), F.xxhash64(body, docs[id], F.lit(20)).alias("hash"))
    # Labels grow with the documents: merged at every size, never sent whole.
    rows = rows.join(said.hint("merge"), rows["key"] == said["label_id"])
    rows = rows.select("body", "label", F.xxhash64("hash", "copy").alias("draw"))
    rows = rows.withColumn("drawn", _range("draw") <= _last_ranges(rows, sample)).select("body", "label", "drawn", "draw")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts, total = Features(bits), np.zeros((2, 1 << bits), np.int64), np.zeros(2, np.int64)
        same: Counter = Counter()
        for batch in _parts(batches):
            numbers, starts = features.of(batch.column(0).to_pylist())
            marks = batch.column(1).to_numpy(zero_copy_only=False)
            owner = np.repeat(marks, np.diff(starts))
            for k in (0, 1):
                counts[k] += np.bincount(numbers[owner == k], minlength=1 << bits)
                total[k] += int((marks == k).sum())
            drawn = []
            for i in np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False)).tolist():
                row = int(marks[i]), batch.column(3)[i].as_py()
                same[row] += 1
                if same[row] <= sample:  # rows with one draw are equal: more of them cannot be among the least
                    drawn.append(i)
            if drawn:
                own = [numbers[starts[i] : starts[i + 1]].tobytes() for i in drawn]
                yield _gathered(
                    [-2] * len(own), marks[drawn], [0] * len(own), own, batch.column(3).take(pa.array(drawn))
                )
        at = np.flatnonzero(counts.any(axis=0))
        at, values = np.append(at, -1), np.concatenate([counts[:, at], total[:, None]], axis=1)
        yield _gathered(at, values[0], values[1], [None] * len(at), pa.nulls(len(at), pa.int64()))

    path = new_folder(spark, "quality-features")
    # at: a feature, -1 for the class sizes, -2 for a sampled row (zero: its label).
    rows.mapInArrow(releasing(gather), "at int, zero long, one long, own binary, tie long").write.parquet(path)
    found = spark.read.parquet(path)
    counts = found.where("at > -2").groupBy("at").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"))
    table = counts.toArrow()  # 2^bits rows and one, at most
    at, zero, one = (table.column(x).to_numpy() for x in ("at", "zero", "one"))
    sizes = [int(x[at == -1].sum()) for x in (zero, one)]
    ratios = np.zeros(1 << bits)
    if not min(sizes):
        return Model(ratios, ratios, float(bool(sizes[1])) - float(bool(sizes[0])), bits)
    feature = at >= 0
    rate = lambda x, n: (x[feature] + SMOOTHING) / (n + 2 * SMOOTHING)
    ratios[at[feature]] = np.log(rate(one, sizes[1]) / rate(zero, sizes[0]))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, left = [], [sample, sample]
        for batch in batches:
            marks = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.sort(np.concatenate([np.flatnonzero(marks == k)[: left[k]] for k in (0, 1)]))
            left = [left[k] - int((marks[at] == k).sum()) for k in (0, 1)]
            kept.append(batch.take(pa.array(at)))
            if not any(left):
                break
        rows = pa.Table.from_batches(kept, schema=pa.schema([("label", pa.int64()), ("own", pa.binary())]))
        own = [np.frombuffer(x, np.int32) for x in rows["own"].to_pylist()]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        numbers = np.concatenate(own) if own else np.zeros(0, np.int32)
        weights, constant = dual_descent(numbers, starts, rows["label"].to_numpy(), ratios)
        yield pa.RecordBatch.from_arrays([pa.array([(weights * ratios).tobytes()]), pa.array([constant])], names=["w", "c"])

    drawn = found.where("at = -2").select(F.col("zero").alias("label"), "own", "tie")
    drawn = drawn.repartition(1).sortWithinPartitions("tie", "label").select("label", "own")
    row = drawn.mapInArrow(releasing(fit), "w binary, c double").first()
    return Model(ratios, np.frombuffer(row["w"], np.float64), row["c"], bits)


def _range(draw: str) -> Column:
    return F.shiftright(draw, 64 - DRAW)


def _last_ranges(rows: DataFrame, sample: int) -> Column:
    """By label, the range of draws in which the ``sample``-th least lies; the last one of a smaller class.

    Draws are counted by ranges: at most 2^DRAW rows of each class reach the driver.
    """
    counts = rows.groupBy("label", _range("draw").alias("range")).agg(F.count("*").alias("n")).toArrow()
    label, ranges, n = (counts.column(x).to_numpy() for x in ("label", "range", "n"))
    last = []
    for k in (0, 1):
        own = np.sort(ranges[label == k])
        sums = np.cumsum(n[label == k][np.argsort(ranges[label == k])])
        at = int(np.searchsorted(sums, sample))
        last.append(int(own[at]) if at < len(own) else (1 << DRAW - 1) - 1)
    return F.when(F.col("label") > 0, last[1]).otherwise(last[0])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, PART of them at a time."""
    for batch in batches:
        for begin in range(0, len(batch), PART):
            yield batch.slice(begin, PART)


def _gathered(at, zero, one, own, tie) -> pa.RecordBatch:
    arrays = [pa.array(at, pa.int32()), pa.array(zero, pa.int64()), pa.array(one, pa.int64()), pa.array(own, pa.binary()), tie]
    return pa.RecordBatch.from_arrays(arrays, names=["at", "zero", "one", "own", "tie"])


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """For every row: ``row`` (a struct of ``keep``, by default of all columns), score, predicted."""
    keep = [docs[c] for c in docs.columns] if keep is None else keep
    given = docs.select(F.struct(*keep).alias("row"), docs[text].cast("string").alias("body"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.bits)
        for batch in _parts(batches):
            margins = model.margins(*features.of(batch.column(1).to_pylist()))
            scores = 1 / (1 + np.exp(-np.clip(model.steepness * margins, -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["row", "score", "predicted"],
            )

    kind = StructType([given.schema["row"], StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return given.mapInArrow(releasing(judge), kind)


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that are predicted 1, with all their columns."""
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.bits)
        for batch in _parts(batches):
            margins = model.margins(*features.of(batch.column(at).to_pylist()))
            yield batch.filter(pa.array(margins >= 0))

    return docs.mapInArrow(releasing(keep), docs.schema)
