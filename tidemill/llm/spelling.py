"""Spelling variants: words one error apart, found in bidirectional FM-indexes of the vocabulary.

Of two words one inserted, deleted or replaced code point apart, one has the other's first
half or its last half unchanged.  The search matches that half exactly and extends the
match across the other half, allowing one error: to the right over a first half, to the
left over a last half.  A match is an interval of suffix ranks of the vocabulary, whose
words stand between delimiters, and the interval of the same match in the reversed text;
an extension on either side moves both.  Ranks come from a wavelet matrix of the
Burrows-Wheeler transform, for many words at once.

The vocabulary is cut by halves: a word is stored under the first and last halves that a
word of its length, or of one more or less, may ask for, and asks under its own two.
Halves are dealt to buckets by hash, and their number follows the size of the vocabulary.
A bucket builds its index for some words at a time and asks it for some words at a time.

* Null or empty text has no words; a null id is the empty text to the rule that changes words.
* Words are counted over whole texts, a window at a time; repeated rows count again.
* Equal counts give the form that is least in code-point order.
* Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.components import written

LETTERS = "A-Za-z\\u00C0-\\u00FF"
LEAST_LENGTH, LEAST_COUNT = 5, 3
WINDOW = 1 << 20     # characters of a text whose words are counted at once
KEPT = 300_000       # distinct words counted by a task before they are handed on
ENTRIES = 60_000     # entries of a bucket, on average
INDEXED = 200_000    # words in one index
ASKED = 20_000       # words searched at once

Change = Callable[[str, str], str]


def _runs(text: str, run: re.Pattern[str], gap: re.Pattern[str]) -> Iterator[list[str]]:
    """Runs of letters of a text, only A-Z lower-cased, a window of it at a time."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    begin = 0
    while begin < len(text):
        end = len(text)
        if begin + WINDOW < end:
            found = gap.search(text, begin + WINDOW)
            end = found.start() if found else end
        yield run.findall(text, begin, end)
        begin = end


def word_counts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", change: Change | None = None, least: int = LEAST_LENGTH
) -> DataFrame:
    """word, n: runs of at least ``least`` letters and their number, after ``change(id, run)``, which may shorten."""
    given = docs.select(docs[id].cast("string").alias("key"), docs[text].cast("string").alias("body"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shorter runs cannot become long enough.
        run, gap = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[^{LETTERS}]")
        total: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            columns = [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())]
            out = pa.RecordBatch.from_arrays(columns, names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for words in _runs(body or "", run, gap):
                    for word, n in Counter(words).items():
                        if change:
                            word = change(key or "", word)
                            if len(word) < least:
                                continue
                        total[word] = total.get(word, 0) + n
                    if len(total) >= KEPT:
                        yield rows()
        yield rows()

    return given.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of a cyclic text, which repeats nothing as a whole, in order of what they begin."""
    n, bits = len(codes), max(1, int(codes.max()).bit_length())
    width = max(1, min(63 // bits, depth))
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = key << bits | np.roll(codes, -i)
    while True:
        order = np.argsort(key, kind="stable")
        fresh = np.diff(key[order], prepend=-1) != 0
        if fresh.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        key = rank * n + np.roll(rank, -width)
        width *= 2


class Wavelet:
    """Ranks of symbols in a sequence, bit by bit."""

    def __init__(self, symbols: np.ndarray, kinds: int) -> None:
        self.bits = max(1, (kinds - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=kinds))[:-1]])
        at = symbols
        for bit in reversed(range(self.bits)):
            high = (at >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~high)]).astype(np.int32))
            at = np.concatenate([at[~high], at[high]])
        all_symbols = np.arange(kinds)
        begin = self._down(np.zeros(kinds, np.int64), np.zeros(kinds, np.int64), all_symbols)[0]
        self.shift = first - begin

    def _down(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        smaller = np.zeros(len(lo), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            high = (symbol >> bit & 1).astype(bool)
            a, b = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            smaller += np.where(high, b - a, 0)
            lo, hi = np.where(high, zeros[-1] + lo - a, a), np.where(high, zeros[-1] + hi - b, b)
        return lo, hi, smaller

    def step(self, lo: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval behind a symbol, its size, and the smaller symbols that were in the old one."""
        a, b, smaller = self._down(lo, lo + size, symbol)
        return a + self.shift[symbol], b - a, smaller

    def children(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """All symbols of each interval: owner, symbol, and what ``step`` tells of it."""
        owner, hi = np.arange(len(lo)), lo + size
        symbol, smaller = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for zeros in self.zeros:
            a, b = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            low, high = b > a, hi - lo > b - a
            owner = np.concatenate([owner[low], owner[high]])
            smaller = np.concatenate([smaller[low], (smaller + b - a)[high]])
            symbol = np.concatenate([symbol[low] << 1, symbol[high] << 1 | 1])
            lo, hi = (
                np.concatenate([a[low], (zeros[-1] + lo - a)[high]]),
                np.concatenate([b[low], (zeros[-1] + hi - b)[high]]),
            )
        return owner, symbol, lo + self.shift[symbol], hi - lo, smaller


class Index:
    """Bidirectional FM-index of distinct words in code-point order."""

    def __init__(self, words: list[str]) -> None:
        self.count = len(words)
        points = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.alphabet = np.unique(np.append(points, 0))
        codes = np.searchsorted(self.alphabet, points)
        depth = max(map(len, words), default=0) + 1
        self.left, self.right = (self._transform(x, depth) for x in (codes, codes[::-1]))

    def _transform(self, codes: np.ndarray, depth: int) -> Wavelet:
        return Wavelet(codes[suffix_order(codes, depth) - 1], len(self.alphabet))

    def coded(self, words: list[str], mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words, one row each (-1: not in the index, -2: behind the word), and their lengths."""
        sizes = np.array([len(x) for x in words], np.int64)
        points = np.frombuffer("".join(x[::-1] if mirrored else x for x in words).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, points)
        at[self.alphabet[np.minimum(at, len(self.alphabet) - 1)] != points] = -1
        out = np.full((len(words), int(sizes.max(initial=0)) + 1), -2, np.int64)
        out[np.arange(out.shape[1]) < sizes[:, None]] = at
        return out, sizes

    def near(self, words: list[str], halves: np.ndarray, mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``words``, place in the index) one error apart, the half unchanged.

        A half is so many first code points or, mirrored, last ones.
        """
        codes, sizes = self.coded(words, mirrored)
        ahead = self.left if mirrored else self.right

        def extended(states: tuple[np.ndarray, ...], symbol: np.ndarray) -> tuple[np.ndarray, ...]:
            q, i, at, other, size = states
            lo, left, smaller = ahead.step(at, size, np.maximum(symbol, 0))
            on = (symbol >= 0) & (left > 0)
            return q[on], i[on] + 1, lo[on], (other + smaller)[on], left[on]

        def chosen(states: tuple[np.ndarray, ...], which: np.ndarray) -> tuple[np.ndarray, ...]:
            return tuple(x[which] for x in states)

        def joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
            return tuple(np.concatenate(x) for x in zip(*parts))

        # A state: word, code points of it used, rank ahead, rank in the other text, size.  All begin at delimiters.
        zero = np.zeros(len(words), np.int64)
        exact = (np.arange(len(words)), zero, zero, zero, np.full(len(words), self.count, np.int64))
        ready = []
        while len(exact[0]):
            done = exact[1] >= halves[exact[0]]
            ready.append(chosen(exact, done))
            exact = chosen(exact, ~done)
            exact = extended(exact, codes[exact[0], exact[1]])
        exact = joined(ready) if ready else exact
        erred, found = [chosen(exact, np.zeros(0, np.int64))], []
        while len(exact[0]) or len(erred[0][0]):
            q, i, at, other, size = exact
            now, inside = codes[q, i], i < sizes[q]
            owner, symbol, lo, left, smaller = ahead.children(at, size)
            fits = (symbol > 0) & (symbol != now[owner])
            owner, lo, left, smaller = owner[fits], lo[fits], left[fits], smaller[fits]
            rank = other[owner] + smaller
            # One code point more in the other word; of equal neighbours the last place counts.
            more = (q[owner], i[owner], lo, rank, left)
            replaced = chosen((q[owner], i[owner] + 1, lo, rank, left), inside[owner])
            # One less, likewise.
            less = chosen((q, i + 1, at, other, size), inside & (codes[q, np.minimum(i + 1, codes.shape[1] - 1)] != now))
            exact = extended(exact, np.where(inside, now, -1))
            # What has erred goes on exactly, to the delimiter.
            waiting = joined([*erred, more, replaced, less])
            end = waiting[1] == sizes[waiting[0]]
            ended = extended(chosen(waiting, end), np.zeros(int(end.sum()), np.int64))
            found.append((ended[0], ended[2] if mirrored else ended[3]))
            on = chosen(waiting, ~end)
            erred = [extended(on, codes[on[0], on[1]])]
        if not found:
            return zero[:0], zero[:0]
        return tuple(np.concatenate(x) for x in zip(*found))


def _asked(rows: pd.DataFrame) -> pd.DataFrame:
    """word, n_near, less (minus the largest count near it), best: for the words that ask in a bucket."""
    known = dict(zip(rows["word"].tolist(), rows["n"].tolist()))
    vocabulary = sorted(known)
    counts = np.array([known[x] for x in vocabulary], np.int64)
    gathered: dict[str, tuple[int, int, str]] = {}
    for begin in range(0, len(vocabulary), INDEXED):
        words, n = vocabulary[begin : begin + INDEXED], counts[begin : begin + INDEXED]
        index, points = Index(words), np.array(words, object)
        for side in (0, 1):
            asking = rows["word"][(rows["side"] == side) & rows["asks"]].tolist()
            for at in range(0, len(asking), ASKED):
                part = asking[at : at + ASKED]
                first = np.array([len(x) // 2 for x in part])
                halves = np.array([len(x) for x in part]) - first if side else first
                q, v = index.near(part, halves, bool(side))
                if side:
                    # Where the first halves agree the other side has found the pair.
                    pairs = zip(q.tolist(), v.tolist())
                    new = np.array([not words[b].startswith(part[a][: first[a]]) for a, b in pairs], bool)
                    q, v = q[new], v[new]
                order = np.lexsort((v, -n[v], q))
                q, v = q[order], v[order]
                begins = np.flatnonzero(np.diff(q, prepend=-1))
                for a, b, k in zip(q[begins].tolist(), v[begins].tolist(), np.diff(np.append(begins, len(q))).tolist()):
                    old = gathered.get(part[a], (0, 0, ""))
                    best = min((-int(n[b]), points[b]), old[1:]) if old[0] else (-int(n[b]), points[b])
                    gathered[part[a]] = (old[0] + k, *best)
    out = [(w, *x) for w, x in gathered.items()]
    return pd.DataFrame(out, columns=["word", "n_near", "less", "best"])


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n from a stored vocabulary (word, n).

    The form is the near word of largest count, if that is twice the word's at least.
    """
    buckets = max(1, 4 * vocabulary.count() // ENTRIES)
    size = F.length("word")

    def entry(side: int, half: Column, asks: Column) -> Column:
        bucket = F.pmod(F.xxhash64(F.lit(side), half), F.lit(buckets))
        return F.struct(F.lit(side).alias("side"), asks.alias("asks"), bucket.alias("bucket"))

    first = (size / 2).cast("int")
    # The halves that words of one code point less, as many, and one more ask for.
    entries = [
        entry(0, F.substring("word", F.lit(1), k), k == first) for k in (((size - 1) / 2).cast("int"), ((size + 1) / 2).cast("int"))
    ] + [entry(1, F.substring("word", size - k + 1, k), k == size - first) for k in (first, first + 1)]
    asked = (
        vocabulary.select("word", "n", F.explode(F.array(*entries)).alias("entry")).select("word", "n", "entry.*")
        .groupBy("bucket").applyInPandas(_asked, "word string, n_near long, less long, best string")
    )
    nothing = F.lit(None).cast("struct<less:long,best:string>")
    none = vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), nothing.alias("near"))
    found = asked.select("word", F.lit(0).cast("long").alias("n"), "n_near", F.struct("less", "best").alias("near"))
    merged = none.unionByName(found).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("near").alias("near")
    )
    enough = -F.col("near.less") >= 2 * F.col("n")
    form, form_n = F.when(enough, F.col("near.best")), F.when(enough, -F.col("near.less"))
    return merged.select("word", "n", "n_near", form.alias("form"), form_n.alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the forms followed from each word of a stored table that has one.

    Counts double with every form, so a chain has some tens of words and every round halves it.
    """
    now = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        then = written(moved, "roots")
        if not then.where("moved").limit(1).count():
            return then.select("word", "root")
        now = then.select("word", "root")


def variants(counts: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words (word, n) counted often enough."""
    vocabulary = written(counts.where(F.col("n") >= least), "vocabulary")
    forms = written(near_words(vocabulary), "forms")
    ends = roots(forms).withColumnRenamed("word", "of")
    joined = forms.join(ends, forms["word"] == ends["of"], "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
