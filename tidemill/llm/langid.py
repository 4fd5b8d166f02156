"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  An n-gram binds its letters: each
vector is rotated by its place and the vectors are multiplied.  A document bundles, that
is adds, the vectors of its n-grams; a language's prototype bundles all its documents.
The prediction is the language whose prototype has the greatest cosine.

Texts are lower-cased; whatever is no letter separates words, and a word begins and ends
with a blank.  Sums are integers, so the order of tasks and retries changes nothing.

* A null text, or one without a letter, is ``und`` with score 0.
* Ties go to the first language in alphabetical order; repeated rows count each.
* Without any labelled document every text is ``und`` with score 0.
* Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

DIMENSIONS = 1024
N = 3
SEED = 7
SLICE = 1 << 19  # characters bundled at once
BLOCK = 2048     # n-gram vectors built at once
UNKNOWN = "und"


def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The fixed vector of a code point; 32 is the blank."""
    bits = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, dimensions, np.int8)
    return (2 * bits - 1).astype(np.int8)


class Profiles:
    """Bundles of texts.  Letter vectors are kept; n-gram vectors are built as needed."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = N) -> None:
        self.dimensions, self.n = dimensions, n
        self.rotated: dict[int, np.ndarray] = {}
        self.letter: dict[int, bool] = {}

    def _vectors(self, code: int) -> np.ndarray:
        """The letter's vector, rotated for each place in the n-gram."""
        if code not in self.rotated:
            vector = letter_vector(code, self.dimensions)
            self.rotated[code] = np.stack([np.roll(vector, self.n - 1 - i) for i in range(self.n)])
        return self.rotated[code]

    def _grams(self, texts: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group, n-gram number and count of each pair that occurs; codes of the n-grams' letters."""
        joined = "\0".join(x.lower() for x in texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        seen, at = np.unique(codes, return_inverse=True)
        for code in seen.tolist():
            self.letter.setdefault(code, chr(code).isalpha())
        is_letter = np.array([self.letter[x] for x in seen.tolist()], bool)[at]
        # The texts are split by the NULs put between them, not by NULs inside.
        sizes = np.array([len(x.lower()) + 1 for x in texts])
        owner = np.repeat(np.arange(len(texts)), sizes)[: len(codes)]
        # Letters stay; the first other character behind a letter becomes a blank.
        blank = np.zeros(len(codes), bool)
        blank[1:] = ~is_letter[1:] & is_letter[:-1]
        keep = is_letter | blank
        symbols, owner = np.where(is_letter, at + 1, 0)[keep], owner[keep]
        # A blank in front of each text, and one behind a text that ends with a letter.
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        last = np.append(first[1:], len(owner)) - 1
        open_end = last[symbols[last] > 0] + 1 if len(owner) else first
        places = np.concatenate([first, open_end])
        owners = np.concatenate([owner[first], owner[open_end - 1]]) if len(owner) else owner
        order = np.argsort(-(places * 2 + np.r_[np.ones(len(first), int), np.zeros(len(open_end), int)]), kind="stable")
        symbols = np.insert(symbols, places[order][::-1], 0)
        owner = np.insert(owner, places[order][::-1], owners[order][::-1])
        k = self.n
        if len(symbols) < k:
            return np.zeros((0, 3), np.int64), np.zeros((0, k), np.uint32)
        gram = np.zeros(len(symbols) - k + 1, np.int64)
        for i in range(k):
            gram = gram * (len(seen) + 1) + symbols[i : len(symbols) - k + 1 + i]
        inside = owner[: len(gram)] == owner[k - 1 :]
        distinct, number = np.unique(gram[inside], return_inverse=True)
        pair, count = np.unique(groups[owner[: len(gram)][inside]] * len(distinct) + number, return_counts=True)
        rows = np.stack([pair // max(1, len(distinct)), pair % max(1, len(distinct)), count], axis=1)
        parts = []
        for _ in range(k):
            parts.append(distinct % (len(seen) + 1))
            distinct = distinct // (len(seen) + 1)
        letters = np.append(np.uint32(32), seen)[np.stack(parts[::-1], axis=1)]
        return rows, letters

    def bundles(self, texts: list[str], groups: np.ndarray | None = None) -> np.ndarray:
        """A row of ``dimensions`` whole numbers for each text, or group of texts; zeros without a letter."""
        groups = np.arange(len(texts)) if groups is None else groups
        out = np.zeros((int(groups.max(initial=-1)) + 1, self.dimensions), np.float64)
        rows, letters = self._grams(texts, groups)
        # Whole numbers below 2^24 are exact in single precision.
        number = np.float32 if rows[:, 2].sum() < 1 << 24 else np.float64
        if not len(rows):
            return out
        used, inverse = np.unique(letters, return_inverse=True)
        table = np.stack([self._vectors(int(x)) for x in used])
        inverse = inverse.reshape(letters.shape)
        rows = rows[np.argsort(rows[:, 1], kind="stable")]
        for begin in range(0, len(letters), BLOCK):
            part = inverse[begin : begin + BLOCK]
            vectors = table[part[:, 0], 0]
            for i in range(1, self.n):
                vectors = vectors * table[part[:, i], i]
            a, b = np.searchsorted(rows[:, 1], [begin, begin + BLOCK])
            some = rows[a:b]
            owners, own = np.unique(some[:, 0], return_inverse=True)
            counts = np.zeros((len(owners), len(part)), number)
            counts[own, some[:, 1] - begin] = some[:, 2]
            out[owners] += counts @ vectors.astype(number)
        return out


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE or i + 1 == len(texts):
            yield begin, i + 1
            begin, size = i + 1, 0


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of each language among the rows with a label.

    Tasks bundle what they read by language and hand on one vector for each; vectors are
    added by language and dimension.  The model has languages x dimensions numbers.
    """
    given = labelled.where(labelled[lang].isNotNull()).select(
        labelled[lang].cast("string").alias("lang"), labelled[text].cast("string").alias("body")
    )

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, sums = Profiles(dimensions), {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _slices(texts):
                names, groups = np.unique(langs[a:b], return_inverse=True)
                found = profiles.bundles([x or "" for x in texts[a:b]], groups)
                for name, vector in zip(names.tolist(), found):
                    sums[name] = sums.get(name, 0) + vector
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(vector.astype(np.int64))],
                names=["lang", "at", "value"],
            )

    sums = given.mapInArrow(bundle, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("v"))
    out: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():
        out.setdefault(row["lang"], np.zeros(dimensions))[row["at"]] = row["v"]
    return dict(sorted(out.items()))


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], id: str = "doc_id", text: str = "text", dimensions: int = DIMENSIONS
) -> DataFrame:
    """One row per document: id, lang_pred, score (cosine, from 0)."""
    names = [x for x in sorted(prototypes) if np.any(prototypes[x])]
    unit = np.stack([prototypes[x] / np.linalg.norm(prototypes[x]) for x in names]) if names else None
    given = docs.select(docs[id].alias("key"), docs[text].cast("string").alias("body"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(dimensions)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            langs, scores = [], []
            for a, b in _slices(texts):
                found = profiles.bundles([x or "" for x in texts[a:b]])
                size = np.linalg.norm(found, axis=1)
                if unit is None:
                    langs += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                cosine = found @ unit.T / np.where(size > 0, size, 1)[:, None]
                best = cosine.argmax(axis=1)
                langs += [names[k] if s > 0 else UNKNOWN for k, s in zip(best.tolist(), size.tolist())]
                scores += np.where(size > 0, np.clip(cosine.max(axis=1), 0, 1), 0).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["key", "lang_pred", "score"],
            )

    kind = given.schema["key"].dataType.simpleString()
    return given.mapInArrow(judge, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", id)


def part_of(id: Column, parts: int) -> Column:
    """The part of a fixed split: crc32 of the id as text (null: empty), modulo ``parts``."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % parts
