"""Jaccard join of word n-gram sets by vertical partitioning.

The global order of n-grams (by their hash) is cut into fragments, so a document's set
falls into segments that can be handled apart.

Candidates by ``segments``: two sets that are similar enough differ in few n-grams, and each differing
n-gram spoils one fragment.  With more fragments than differences some segments must be
equal, so documents meet where they share a whole segment.  Sizes are classed, and every
class has the number of fragments that its greatest difference asks for.  Segments of one
n-gram or none are common to many texts; each class has some more fragments than needed,
so a document may leave out that many of them, and one with more gives all.

Candidates by ``rare`` n-grams: those that a first pass found common come last, by their
counts, all others go by their hash.  Of two sets that are similar enough the least n-gram
that both have lies among the first few of each, as many as a similar set may lack and one
more; only these look for partners.  This holds for every order that is the same for all, so
the counts need not be complete.  At low similarities it takes less than half the rows of
``segments``, which have few n-grams each then.  But no more than ORDERED n-grams go by counts:
where more are common, groups of an n-gram are larger and more of their members are compared.

Counts: a pair's overlap in a fragment is no more than the smaller segment; pairs for which
the sum of these bounds is too small go first.  For the others the overlap is counted in each
fragment apart, and the partial counts are summed per pair.

What is needed are components, not all pairs.  Equal sets are one node.  In each group of
nodes that meet (in a segment or at an n-gram), all are first compared with the group's least node; then, where
a group still holds several components, all pairs across them are compared: one by one in
small groups, in blocks in large ones, which give no pairs but links that join components.
So no link is lost, and no group makes more rows than it has members.

Two sets that meet once mostly meet in many groups, so whole sets do not go to blocks at
first: parity bits of their n-grams, an eighth of their bytes, tell most pairs apart.  Of the
pairs that they leave, some that would join all components of a block are counted once for
all groups.  Only members that still may have a link to another component then meet with all
their n-grams.

* A set is of distinct n-grams; fewer words make one n-gram of all.  Null, empty and
  wordless texts have none: size 0, linked with nothing.
* Repeated rows are rows of their own with the same component.  Null ids count as greater
  than all others.  Extra columns are ignored; an empty table gives no rows.
* N-grams and sets are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidemill.llm.components import components, written
from tidemill.llm.memory import releasing
from tidemill.llm.shingles import Words, mix, shingle_set, text_words

RATIO = 1.5      # between the sizes of neighbouring classes
LARGEST = 1 << 40
COMMON = 4       # documents of an n-gram that is common
ORDERED = 1 << 18  # common n-grams that are ordered by their counts, at most
HELD = 1 << 21   # n-grams that a task counts at once
FRAGMENTS = 8    # in which overlaps of pairs are counted
THIN = 4         # n-grams in the finer segments whose sizes bound a pair's overlap, about
SMALL = 16       # members of a group whose pairs are listed
BLOCK = 512      # members of a larger group that are compared at once, on average
COLUMNS = 4096   # n-grams of a block that are counted at once
PARITY = 8       # parity bits for each n-gram, at least


class Classes:
    """Size classes for a similarity of ``percent`` and more, with their fragments and spare ones."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        bounds = [1]
        while bounds[-1] < LARGEST:
            bounds.append(max(bounds[-1] + 1, math.ceil(bounds[-1] * RATIO)))
        self.bounds = np.array(bounds)
        self.fragments, self.spare = [], []
        for low, high in zip(bounds, bounds[1:]):
            # A member s meets t from s to s * 100 / percent.
            least = (high - 1) + (high - 1) * 100 // percent
            differ = least * (100 - percent) // (100 + percent)
            need = differ + 1
            thin = math.sqrt(low * high) / need
            few = need * math.exp(-thin) * (1 + thin)
            spare = math.ceil(few + 2 * math.sqrt(few)) if differ else 0
            self.fragments.append(need + spare if differ else 0)
            self.spare.append(spare)

    def of(self, size: int) -> range:
        """Classes in which a set of ``size`` looks for partners: its own and those of smaller ones."""
        least = -(-size * self.percent // 100)
        low, high = np.searchsorted(self.bounds, [least, size], side="right") - 1
        return range(low, high + 1)

    def segments(self, values: np.ndarray) -> np.ndarray:
        """Hashes of the segments that a sorted set gives, in all its classes."""
        out = []
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values), out=sums[1:])
        for k in self.of(len(values)):
            count = self.fragments[k]
            if not count:
                continue  # only equal sets are similar
            cuts = cut(values, count)
            sizes = np.diff(cuts)
            salt = np.arange(count, dtype=np.uint64) + np.uint64(k << 42)
            hashes = mix(sums[cuts[1:]] - sums[cuts[:-1]] + mix(salt))
            thin = sizes < 2
            out.append(hashes if thin.sum() > self.spare[k] else hashes[~thin])
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Order:
    """The order of n-grams: all but ``common`` (ascending) by their value, then ``common`` by ``counts``."""

    def __init__(self, common: np.ndarray, counts: np.ndarray) -> None:
        self.common, self.counts = common, counts

    def probes(self, values: np.ndarray, percent: int) -> np.ndarray:
        """Members of a sorted set of which a different set, similar by ``percent``, has one among its own."""
        size = len(values)
        if size * 100 < (size + 1) * percent:
            return values[:0]  # only an equal set is similar
        count = size - -(-size * percent // 100) + 1
        at = np.searchsorted(self.common, values)
        known = np.zeros(size, bool)
        inside = at < len(self.common)
        known[inside] = self.common[at[inside]] == values[inside]
        rare = values[~known][:count]
        late = values[known]
        late = late[np.lexsort((late, self.counts[at[known]]))[: count - len(rare)]]
        return np.concatenate([rare, late])


def cut(values: np.ndarray, count: int) -> np.ndarray:
    """Where the fragments of the order begin in a sorted set; ``count`` + 1 places."""
    edges = np.arange(1, count, dtype=np.uint64) * np.uint64((1 << 64) // count)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])


def parity(values: np.ndarray) -> bytes:
    """Of each number of 2^j low bits whether an odd count of n-grams has it; PARITY to 2 * PARITY bits an n-gram.

    Two sets differ in at least as many n-grams as parities.
    """
    bits = 1 << max(6, (PARITY * len(values) - 1).bit_length())
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _node(values: np.ndarray) -> int:
    """The 64-bit name of a set (as a signed number)."""
    total = mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(values))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _sets(texts: list, hasher: Words, n: int) -> Iterator[np.ndarray]:
    for words in text_words(hasher, texts):
        yield shingle_set(words, n)


def _members(docs: DataFrame, id: str, text: str, n: int, separators: str) -> DataFrame:
    """(key, tie, node, n, sizes): tie is a hash of the text; no node without words.

    ``sizes`` counts the n-grams in each of 2^j fragments, THIN to 2 * THIN on average.
    """
    body = docs[text].cast("string")
    given = docs.select(docs[id].alias("key"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("tie"), body.alias("body"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Words(separators)
        for batch in batches:
            for begin in range(0, len(batch), 500):
                part = batch.slice(begin, 500)
                counts, nodes, sizes = [], [], []
                for values in _sets(part.column(2).to_pylist(), hasher, n):
                    counts.append(len(values))
                    nodes.append(_node(values) if len(values) else None)
                    fine = 1 << max(4, (len(values) // THIN).bit_length() - 1)
                    sizes.append(np.diff(cut(values, fine)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()),
                        pa.array(sizes, pa.list_(pa.int32())),
                    ],
                    names=["key", "tie", "node", "n", "sizes"],
                )

    kind = given.schema["key"].dataType.simpleString()
    return given.mapInArrow(releasing(name), f"key {kind}, tie long, node long, n long, sizes array<int>")


def _distinct_sets(batches: Iterator[pa.RecordBatch], separators: str, n: int) -> Iterator[list]:
    """(node, set) of the texts in a task, some hundreds at a time; a set that repeats is given once."""
    hasher, seen = Words(separators), set()
    for batch in batches:
        for begin in range(0, len(batch), 500):
            part = []
            for values in _sets(batch.column(0).slice(begin, 500).to_pylist(), hasher, n):
                node = _node(values) if len(values) else None
                if node is None or node in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(node)
                part.append((node, values))
            yield part


def _repeated(docs: DataFrame, text: str, n: int, separators: str) -> DataFrame:
    """(gram, copies) of the n-grams that a task meets in several sets."""
    given = docs.select(docs[text].cast("string").alias("body"))

    def told(held: list) -> pa.RecordBatch:
        grams, copies = np.unique(np.concatenate(held), return_counts=True)
        often = copies > 1
        arrays = [pa.array(grams[often].view(np.int64)), pa.array(copies[often])]
        return pa.RecordBatch.from_arrays(arrays, names=["gram", "copies"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in _distinct_sets(batches, separators, n):
            for _, values in part:
                held.append(values)
                size += len(values)
                if size >= HELD:
                    yield told(held)
                    held, size = [], 0
        if held:
            yield told(held)

    return given.mapInArrow(releasing(count), "gram long, copies long")


def common_order(docs: DataFrame, text: str, n: int, separators: str) -> Order:
    """The order of the table's n-grams; at most ORDERED of them, the most common, go by their counts.

    The counts are written first, so all passes see the same order.
    """
    counts = _repeated(docs, text, n, separators).groupBy("gram").agg(F.sum("copies").alias("copies"))
    counts = written(counts.where(F.col("copies") >= COMMON), "common-grams")
    digits = F.length(F.bin("copies"))
    least, total = 64, 0
    for r in sorted(counts.groupBy(digits.alias("digits")).count().collect(), reverse=True):
        total += r["count"]
        if total > ORDERED:
            break
        least = r["digits"]
    rows = counts.where(digits >= least).toArrow()
    grams, copies = (rows.column(c).to_numpy() for c in ("gram", "copies"))
    grams = grams.astype(np.int64).view(np.uint64)
    place = np.argsort(grams)
    return Order(grams[place], copies[place].astype(np.int64))


def _signatures(docs: DataFrame, text: str, n: int, percent: int, separators: str, order: Order | None = None) -> DataFrame:
    """(segment, node, n), a row for each segment that a set gives, or with an order for each of
    its n-grams that look for partners; a task gives each set once."""
    given = docs.select(docs[text].cast("string").alias("body"))

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = None if order else Classes(percent)
        for part in _distinct_sets(batches, separators, n):
            if not part:
                continue
            probes = [order.probes(values, percent) if order else classes.segments(values) for _, values in part]
            counts = [len(x) for x in probes]
            nodes = np.repeat(np.array([node for node, _ in part], np.int64), counts)
            sizes = np.repeat(np.array([len(values) for _, values in part], np.int64), counts)
            arrays = [pa.array(np.concatenate(probes).view(np.int64)), pa.array(nodes), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays(arrays, names=["segment", "node", "n"])

    return given.mapInArrow(releasing(give), "segment long, node long, n long")


def _shared(signatures: DataFrame) -> DataFrame:
    """(segment, node, n, centre) of segments where two nodes or more meet; the centre is the least node.

    Ends are folded before they move and joined back, so no task gets a common segment whole.
    """
    ends = signatures.groupBy("segment").agg(F.min("node").alias("centre"), F.max("node").alias("top"))
    # Copies in other tasks give a set again.
    return signatures.join(ends.where("centre < top").drop("top"), "segment").distinct()


def _contents(docs: DataFrame, wanted: DataFrame, id: str, text: str, n: int, separators: str) -> DataFrame:
    """(node, fragment, grams, bits, n): the segments of the sets of ``wanted`` (key, tie); other texts do not move on.

    The first segment of a set comes with the parity bits of all its n-grams and their number.
    """
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[id].alias("key"), F.xxhash64(body).alias("tie"), body.alias("body"))
    rows = rows.join(wanted, rows["key"].eqNullSafe(wanted["key"]) & (rows["tie"] == wanted["tie"]), "left_semi")

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Words(separators)
        for batch in batches:
            for begin in range(0, len(batch), 500):
                nodes, parts, grams, bits, counts = [], [], [], [], []
                for values in _sets(batch.column(0).slice(begin, 500).to_pylist(), hasher, n):
                    if not len(values):
                        continue
                    cuts = cut(values, FRAGMENTS)
                    node = _node(values)
                    for f in range(FRAGMENTS):
                        if cuts[f] < cuts[f + 1]:
                            known = bool(nodes) and nodes[-1] == node
                            bits.append(None if known else parity(values))
                            counts.append(None if known else len(values))
                            nodes.append(node)
                            parts.append(f)
                            grams.append(values[cuts[f] : cuts[f + 1]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes, pa.int64()), pa.array(parts, pa.int32()), pa.array(grams, pa.list_(pa.int64())),
                        pa.array(bits, pa.binary()), pa.array(counts, pa.int64()),
                    ],
                    names=["node", "fragment", "grams", "bits", "n"],
                )

    return rows.select("body").mapInArrow(releasing(give), "node long, fragment int, grams array<long>, bits binary, n long")


def overlaps(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with ``common``: partial counts of the fragments, summed per pair."""
    one = contents.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("x"))
    two = contents.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("y"))
    partial = F.size(F.array_intersect("x", "y")).cast("long")
    met = pairs.join(one, "a").join(two, ["b", "fragment"])
    # A document that repeats gives its segments again, with the same count.
    each = met.groupBy(*pairs.columns, "fragment").agg(F.max(partial).alias("part"))
    return each.groupBy(*pairs.columns).agg(F.sum("part").alias("common"))


def _near(pairs: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b, na, nb) whose sizes, whole and by fragment, allow the similarity."""
    near = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).distinct()
    one = vectors.select(F.col("node").alias("a"), F.col("sizes").alias("x"))
    two = vectors.select(F.col("node").alias("b"), F.col("sizes").alias("y"))

    def halved(v: str) -> Column:
        return F.transform(F.sequence(F.lit(0), (F.size(v) / 2 - 1).cast("int")), lambda i: F.get(v, 2 * i) + F.get(v, 2 * i + 1))

    # Sizes of sets that may be similar differ by less than two, so fragments do by a halving.
    x = F.when(F.size("x") > F.size("y"), halved("x")).otherwise(F.col("x"))
    y = F.when(F.size("y") > F.size("x"), halved("y")).otherwise(F.col("y"))
    most = F.aggregate(F.zip_with(x, y, lambda m, n: F.least(m, n)), F.lit(0), lambda s, n: s + n)
    near = near.join(one, "a").join(two, "b")
    return near.where(most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b", "na", "nb")


def _linked(near: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs that are similar enough."""
    counted = overlaps(near, contents)
    return counted.where(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent).select("a", "b")


def _listed_pairs(rows: DataFrame) -> DataFrame:
    """Pairs across components in groups of SMALL members at most: (a, b, na, nb)."""
    lists = rows.where(F.col("members") <= SMALL).groupBy("segment").agg(
        F.sort_array(F.collect_set(F.struct("node", "n", "least"))).alias("m")
    )
    one = lists.select("m", F.explode("m").alias("x"))
    two = one.select("x", F.explode(F.filter("m", lambda y: (y["node"] > F.col("x.node")) & (y["least"] != F.col("x.least")))).alias("y"))
    return two.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"))


def _blocks(rows: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """(segment, one, two, block, node, least): members of larger groups, block against block.

    A group of m members makes (m / BLOCK)^2 / 2 tasks of two blocks; a member is copied
    m / BLOCK times, and no pair is a row.  A hash of the node names its block, so no task
    numbers a whole group.  Only members stay for whom the sizes by fragment allow a link to
    another component; a common passage alone does not.
    """
    large = rows.where(F.col("members") > SMALL).withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    large = large.withColumn("block", F.pmod(F.xxhash64("node", F.lit(30)), "blocks").cast("int"))
    each = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    each = each.join(vectors, "node").select("segment", "one", "two", "block", "node", "n", "least", "sizes")

    def prune(frame: pd.DataFrame) -> pd.DataFrame:
        return _possible(frame, percent)

    kind = "segment long, one int, two int, block int, node long, least long"
    return each.groupBy("segment", "one", "two").applyInPandas(prune, kind)


def _possible(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Members of two blocks (or of one with itself) that may have a link across components."""
    frame = frame.reset_index(drop=True)
    length = int(frame["sizes"].map(len).min())
    # Finer vectors are added up; more n-grams in a fragment only widen the bound.
    table = np.stack([np.asarray(x, np.int32).reshape(length, -1).sum(axis=1) for x in frame["sizes"]])
    first = np.flatnonzero(frame["block"] == frame["one"].iloc[0])
    second = np.flatnonzero(frame["block"] == frame["two"].iloc[0])
    least, n = frame["least"].to_numpy(), frame["n"].to_numpy()
    found = np.zeros(len(frame), bool)
    step = max(1, (1 << 21) // (len(second) * length))
    for begin in range(0, len(first), step):
        some = first[begin : begin + step]
        most = np.minimum(table[some][:, None, :], table[second][None, :, :]).sum(axis=2)
        may = most * (100 + percent) >= (n[some][:, None] + n[second][None, :]) * percent
        may &= least[some][:, None] != least[second][None, :]
        found[some[may.any(axis=1)]] = True
        found[second[may.any(axis=0)]] = True
    return frame.loc[found, ["segment", "one", "two", "block", "node", "least"]]


def _across(frame: pd.DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows x and y of two blocks (or of one with itself) whose parities allow a link across components, likely ones first."""
    n, least, block = (frame[c].to_numpy() for c in ("n", "least", "block"))
    within = frame["one"].iloc[0] == frame["two"].iloc[0]
    length = frame["bits"].map(len).to_numpy()
    found = [np.zeros((3, 0), np.int64)]
    for size in np.unique(length):
        # Sizes of sets that may be similar differ by less than two, so their numbers of bits do by a halving.
        some, more = np.flatnonzero(length == size), np.flatnonzero(length == 2 * size)
        table = np.stack([np.frombuffer(frame["bits"].iloc[i], np.uint64) for i in some])
        if len(more):
            twice = np.stack([np.frombuffer(frame["bits"].iloc[i], np.uint64) for i in more])
            table = np.concatenate([table, twice[:, : size // 8] ^ twice[:, size // 8 :]])
        pool = np.concatenate([some, more])
        step = max(1, (1 << 21) // table.size)
        for begin in range(0, len(some), step):
            x = some[begin : begin + step]
            odd = np.bitwise_count(table[begin : begin + len(x), None] ^ table[None]).sum(axis=2, dtype=np.int64)
            total = n[x][:, None] + n[pool][None, :]
            may = odd * (100 + percent) <= total * (100 - percent)
            may &= least[x][:, None] != least[pool][None, :]
            may &= np.arange(begin, begin + len(x))[:, None] < np.arange(len(pool))[None, :]
            if not within:
                may &= block[x][:, None] != block[pool][None, :]
            i, j = np.nonzero(may)
            found.append(np.stack([x[i], pool[j], (odd[i, j] << 20) // total[i, j]]))
    x, y, score = np.concatenate(found, axis=1)
    order = np.argsort(score, kind="stable")
    return x[order], y[order]


def _joining(one: np.ndarray, two: np.ndarray) -> list[int]:
    """Places of the links between components ``one`` and ``two`` that join what those before them did not."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    ends = np.stack([np.minimum(one, two), np.maximum(one, two)], axis=1)
    out = []
    for k in np.sort(np.unique(ends, axis=0, return_index=True)[1]):
        x, y = find(int(one[k])), find(int(two[k]))
        if x != y:
            root[x] = y
            out.append(int(k))
    return out


def _met(blocks: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """Members (segment, one, two, block, node, least, n) of ``blocks`` whose parities allow a link to another component.

    ``partners`` and their ``sizes`` are those of pairs that would join the components of two blocks.
    """

    def prune(frame: pd.DataFrame) -> pd.DataFrame:
        node, n, least = (frame[c].to_numpy() for c in ("node", "n", "least"))
        x, y = _across(frame, percent)
        kept = np.union1d(x, y)
        partners: dict[int, list[int]] = {int(i): [] for i in kept}
        for k in _joining(least[x], least[y]):
            partners[int(x[k])].append(int(y[k]))
        out = frame.iloc[kept][["segment", "one", "two", "block", "node", "least", "n"]]
        lists = {"partners": [node[v].tolist() for v in partners.values()], "sizes": [n[v].tolist() for v in partners.values()]}
        return out.assign(**{c: pd.Series(v, out.index, dtype=object) for c, v in lists.items()})

    kind = "segment long, one int, two int, block int, node long, least long, n long, partners array<long>, sizes array<long>"
    return blocks.join(parities, "node").groupBy("segment", "one", "two").applyInPandas(prune, kind)


def _partner_pairs(met: DataFrame) -> DataFrame:
    """Distinct pairs (a, b, na, nb) of members and their partners."""
    rows = met.select(F.struct("node", "n").alias("x"), F.explode(F.arrays_zip(F.col("partners").alias("node"), F.col("sizes").alias("n"))).alias("y"))
    rows = rows.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return rows.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).distinct()


def _block_links(blocks: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components among the members of ``blocks``."""
    rows = contents.join(blocks.select("node").distinct(), "node", "left_semi")
    # A document that repeats gives its segments again.
    sets = rows.groupBy("node").agg(
        F.flatten(F.transform(F.sort_array(F.collect_set(F.struct("fragment", "grams"))), lambda x: x["grams"])).alias("grams")
    )
    each = blocks.join(sets, "node").select("segment", "one", "two", "block", "node", "least", "grams")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return _compared(frame, percent)

    return each.groupBy("segment", "one", "two").applyInPandas(compare, "a long, b long").distinct()


def _compared(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that join the components of two blocks (or of one with itself)."""
    frame = frame.reset_index(drop=True)
    first = np.flatnonzero(frame["block"] == frame["one"].iloc[0])
    second = np.flatnonzero(frame["block"] == frame["two"].iloc[0])
    sizes = frame["grams"].map(len).to_numpy()
    owner = np.repeat(np.arange(len(frame)), sizes)
    _, number, seen = np.unique(np.concatenate(frame["grams"].to_list()), return_inverse=True, return_counts=True)
    # N-grams that one member alone has add nothing.
    use = seen > 1
    column = np.cumsum(use) - 1
    common = np.zeros((len(first), len(second)), np.float32)
    keep = use[number]
    owner, number = owner[keep], column[number[keep]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    for begin in range(0, int(use.sum()), COLUMNS):
        a, b = np.searchsorted(number, [begin, begin + COLUMNS])
        table = np.zeros((len(frame), COLUMNS), np.float32)
        table[owner[a:b], number[a:b] - begin] = 1
        common += table[first] @ table[second].T
    union = sizes[first][:, None] + sizes[second][None, :] - common
    least = frame["least"].to_numpy()
    near = (common * 100 >= union * percent) & (least[first][:, None] != least[second][None, :])
    i, j = np.nonzero(near)
    one, two = least[first[i]], least[second[j]]
    picked = _joining(one, two)
    return pd.DataFrame({"a": one[picked], "b": two[picked]}, dtype="int64")


def _with_least(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, "node", "left").withColumn("least", F.coalesce("least", "node"))


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """(node, least) of the components ``found`` once ``links`` join them too."""
    more = written(links, "more-links")
    if more.isEmpty():
        return found
    roots = found.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return written(components(more.unionByName(roots)), "components")


def similar_components(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, separators: str = "space",
    candidates: str = "segments",
) -> DataFrame:
    """One row per document: key, tie, n (set size), component (least node of it; null without words).

    ``percent`` is over 50; ``candidates`` are found by ``segments`` or by ``rare`` n-grams.
    """
    if candidates not in ("segments", "rare"):
        raise ValueError("candidates are found by segments or by rare n-grams")
    if not 50 < percent <= 100:
        raise ValueError("the similarity has to be over 50 percent")
    members = written(_members(docs, id, text, n, separators), "sets")
    order = common_order(docs, text, n, separators) if candidates == "rare" else None
    shared = written(_shared(_signatures(docs, text, n, percent, separators, order)), "shared-segments")
    nodes = shared.select("node", "n").distinct()
    vectors = members.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]).select("node", "sizes")
    vectors = written(vectors, "segment-sizes")

    def contents_of(wanted: DataFrame, hint: str | None) -> DataFrame:
        """Segments of one document for each wanted node."""
        rows = members.join(wanted, "node", "left_semi").groupBy("node")
        rows = written(rows.agg(F.min(F.struct(F.col("key").isNull(), "key", "tie")).alias("r")).select("r.key", "r.tie"), "wanted")
        rows = rows.hint(hint) if hint else rows
        return written(_contents(docs, rows, id, text, n, separators), "segments")

    # First every member with the centre of its group.
    size = nodes.select(F.col("node").alias("centre"), F.col("n").alias("na"))
    pairs = shared.where("node <> centre").select("centre", "node", "n").distinct().join(size, "centre")
    pairs = pairs.select(F.col("centre").alias("a"), F.col("node").alias("b"), "na", F.col("n").alias("nb"))
    near = written(_near(pairs, vectors, percent), "near-pairs")
    # The nodes grow with the documents: merged at every size.
    known = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    contents = contents_of(known, "merge")
    found = written(components(_linked(near, contents, percent)), "components")

    # Then the components that still meet in a group.
    rows = _with_least(shared.drop("centre"), found)
    apart = rows.groupBy("segment").agg(F.min("least").alias("lo"), F.max("least").alias("hi"), F.count("*").alias("members"))
    rows = written(rows.join(apart.where("lo < hi").select("segment", "members"), "segment"), "groups-apart")
    listed = _near(_listed_pairs(rows), vectors, percent)
    tested = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    listed = written(listed.join(tested, ["a", "b"], "left_anti"), "near-pairs")
    late = listed.select(F.col("a").alias("node")).unionByName(listed.select(F.col("b").alias("node")))
    blocks = written(_blocks(rows, vectors, percent), "blocks")
    late = late.unionByName(blocks.select("node")).distinct()
    contents = contents.unionByName(contents_of(late.join(known, "node", "left_anti"), None))
    parities = contents.where("bits IS NOT NULL").select("node", "bits", "n").join(blocks.select("node").distinct(), "node", "left_semi")
    # A document that repeats gives its bits again.
    parities = written(parities.dropDuplicates(["node"]), "parities")
    met = written(_met(blocks, parities, percent), "blocks-met")
    likely = _partner_pairs(met).join(tested, ["a", "b"], "left_anti")
    listed = written(listed.unionByName(likely).distinct(), "pairs-apart")
    found = _joined(found, _linked(listed, contents, percent))
    # At last all that may still join components of a large group, where two blocks hold several yet.
    blocks, pair = _with_least(met.select("segment", "one", "two", "block", "node"), found), ["segment", "one", "two"]
    apart = blocks.groupBy(*pair).agg(F.min("least").alias("lo"), F.max("least").alias("hi")).where("lo < hi")
    left = _met(blocks.join(apart.select(*pair), pair, "left_semi"), parities, percent)
    left = written(left.select(*pair, "block", "node", "least"), "blocks-left")
    found = _joined(found, _block_links(left, contents, percent))
    return _with_least(members, found).select("key", "tie", "n", F.col("least").alias("component"))


def similar_groups(docs: DataFrame, id: str = "doc_id", **how) -> DataFrame:
    """One row per document: id, n_shingles, component_id (least id of its component)."""
    rows = similar_components(docs, id, **how)
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("key").alias("first"))
    first = F.when(F.col("component").isNull(), F.col("key")).otherwise(F.col("first"))
    return rows.join(least, "component", "left").select(
        F.col("key").alias(id), F.col("n").alias("n_shingles"), first.alias("component_id")
    )


def without_similar(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The row of the least id in each component, and all rows without words; all columns stay."""
    rows = written(similar_components(docs, id, text, **how), "component-of-row")
    order = F.struct(F.col("key").isNull(), "key", "tie")
    first = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("r")).select("r.key", "r.tie")
    wordless = rows.where("component IS NULL").select("key", "tie").distinct()
    kept = first.select("key", "tie", F.lit(1).alias("copies")).unionByName(wordless.select("key", "tie", F.lit(None).alias("copies")))
    # A struct is never null, so null ids join too, and the window below needs no other exchange.
    kept = kept.select(F.struct(F.col("key").alias("k")).alias("at"), "tie", "copies")
    own = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.struct(docs[id].alias("k")).alias("at"),
        F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("tie"),
    )
    own = own.join(kept, ["at", "tie"])
    # A row that repeats in full stays once, unless it has no words and is linked with nothing.
    nth = F.row_number().over(Window.partitionBy("at", "tie").orderBy(F.xxhash64("row")))
    return own.withColumn("nth", nth).where("copies IS NULL OR nth <= copies").select("row.*")
