"""Secret scans by a trigram index.

Each rule is a regular expression.  From its parse tree follows a Boolean query over
trigrams that every match must contain; a segment of documents is indexed by the trigrams
that the rules ask for, posting lists are intersected and united, and only the documents
left are searched with the expression.  Rules without a mandatory trigram search every
document.  A segment is an Arrow batch: index and postings live in the task that reads
it, no text moves, and a lost task builds its segments again.

* Null text counts as empty: no spans.  Repeated rows are rows of their own.
* Spans are code points, end exclusive; matches of a rule are leftmost and do not overlap.
* Extra columns are ignored; an empty table gives no rows.
* Rules fold case for ASCII only (``(?ai:...)``), as the index does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op, _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

EXACT = 16        # strings an expression may stand for before only their trigrams are kept
SEGMENT = 4 << 20  # bytes of text indexed at once

ALL, NONE = ("and",), ("or",)  # queries that hold always and never


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int


# Fixed by the contract of the scan; ASCII letters of the names match in either case.
BASE = (
    Rule(
        "assign",
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Further kinds, each with mandatory trigrams.
MORE = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    Rule("forge", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
)


# -- trigram queries ----------------------------------------------------------
# A query is ("gram", text) or ("and" | "or", query, ...).  Everything is lower-cased
# for A-Z, in rules and texts alike, so a query may only let more documents through.


def _fold(code: int) -> str:
    return chr(code + 32) if 65 <= code <= 90 else chr(code)


def _all_of(*parts: tuple) -> tuple:
    parts = tuple(dict.fromkeys(x for x in parts if x != ALL))
    return NONE if NONE in parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any_of(*parts: tuple) -> tuple:
    parts = tuple(dict.fromkeys(x for x in parts if x != NONE))
    return ALL if ALL in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _grams(text: str) -> tuple:
    data = text.encode()
    return _all_of(*(("gram", data[i : i + 3]) for i in range(len(data) - 2)))


def _need(strings: frozenset | None) -> tuple:
    """What holds if one of the strings occurs; None stands for any string."""
    return ALL if strings is None else _any_of(*map(_grams, sorted(strings)))


@dataclass(frozen=True)
class _Info:
    """``exact``: all texts the expression can match, or None; ``need``: a query that holds then."""

    exact: frozenset | None
    need: tuple = ALL


def _codes(items: list) -> frozenset | None:
    out = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(_fold(value))
        elif kind is op.RANGE and value[1] - value[0] < 4 * EXACT:
            out |= {_fold(x) for x in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(out) if len(out) <= EXACT else None


def _sequence(items) -> _Info:
    """Neighbours with few texts are joined, so grams run over their borders."""
    run, need, whole = frozenset([""]), [], True
    for item in items:
        info = _info(item)
        need.append(info.need)
        joined = None if info.exact is None else frozenset(a + b for a in run for b in info.exact)
        if joined is None or len(joined) > EXACT:
            need.append(_need(run))
            whole = False
            run = frozenset([""]) if info.exact is None else info.exact
        else:
            run = joined
    need.append(_need(run))
    return _Info(run if whole else None, _all_of(*need))


def _info(item) -> _Info:
    kind, value = item
    if kind is op.LITERAL:
        return _Info(frozenset([_fold(value)]))
    if kind is op.IN:
        return _Info(_codes(value))
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        exact = None
        if all(x.exact is not None for x in parts):
            exact = frozenset().union(*(x.exact for x in parts))
        return _Info(exact if exact is not None and len(exact) <= EXACT else None, _any_of(*(x.need for x in parts)))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, body = value
        one = _sequence(body)
        if most == 1 and one.exact is not None:
            return _Info(one.exact | {""})
        return _Info(None, one.need if least else ALL)
    if kind is op.AT:
        return _Info(frozenset([""]))
    return _Info(None)


def trigram_query(pattern: str) -> tuple:
    """The Boolean query that every text with a match of ``pattern`` answers; ALL if there is none."""
    return _sequence(_parser.parse(pattern)).need


def _query_grams(query: tuple) -> set[bytes]:
    return {query[1]} if query[0] == "gram" else set().union(*map(_query_grams, query[1:]))


def _answer(query: tuple, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Ascending numbers of the documents in the segment for which the query holds."""
    if query[0] == "gram":
        return postings[query[1]]
    if query == ALL:
        return np.arange(n)
    parts = [_answer(x, postings, n) for x in query[1:]]
    if query[0] == "or":
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, int)
    out, *rest = sorted(parts, key=len)
    for x in rest:
        out = np.intersect1d(out, x, assume_unique=True)
    return out


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = [(r, re.compile(r.pattern), trigram_query(r.pattern)) for r in rules]
        self.grams = sorted(set().union(*(_query_grams(q) for *_, q in self.rules)))
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[[int.from_bytes(x, "big") for x in self.grams]] = True

    def postings(self, texts: list[str]) -> dict[bytes, np.ndarray]:
        """Gram -> ascending numbers of the texts that contain it."""
        parts = [x.encode("utf-8", "surrogatepass") for x in texts]
        raw = np.frombuffer(b"\n".join(parts), np.uint8)
        low = (raw | (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)).astype(np.uint32)
        codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        at = np.flatnonzero(self.wanted[codes]) if len(raw) > 2 else np.zeros(0, int)
        found = codes[at] if len(at) else np.zeros(0, np.uint32)
        owner = np.searchsorted(np.cumsum([len(x) + 1 for x in parts]), at, side="right")
        return {x: np.unique(owner[found == int.from_bytes(x, "big")]) for x in self.grams}

    def candidates(self, texts: list[str]) -> list[np.ndarray]:
        """For each rule, the numbers of the texts to search."""
        postings = self.postings(texts)
        return [_answer(query, postings, len(texts)) for *_, query in self.rules]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text, sorted (start, number of the rule, end)."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, ((rule, search, _), some) in enumerate(zip(self.rules, self.candidates(texts))):
            for i in some.tolist():
                for m in search.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[i].append((m.start(), number, m.end()))
        return [sorted(x) for x in out]


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, spans array<struct<kind, start, end>> in order of start, then rule."""
    given = docs.select(docs[id].alias("key"), docs[text].cast("string").alias("body"))
    kinds = [r.kind for r in rules]
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for keys, texts in segments(batch):
                found = [
                    [{"kind": kinds[k], "start": a, "end": b} for a, k, b in spans] for spans in scanner.spans(texts)
                ]
                yield pa.RecordBatch.from_arrays([keys, pa.array(found, pa.list_(span))], names=["key", "spans"])

    kind = given.schema["key"].dataType.simpleString()
    out = given.mapInArrow(search, f"key {kind}, spans array<struct<kind:string,start:int,end:int>>")
    return out.withColumnRenamed("key", id)


def segments(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of a batch, some SEGMENT characters at a time, whole texts always."""
    texts = [x or "" for x in batch.column(1).to_pylist()]
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SEGMENT or i + 1 == len(texts):
            yield batch.column(0).slice(begin, i + 1 - begin), texts[begin : i + 1]
            begin, size = i + 1, 0


def span_digests(found: DataFrame, id: str = "doc_id", base: tuple[Rule, ...] = BASE) -> DataFrame:
    """id, n_<kind> of the base rules, base_sha256 and spans as kind:start:end, comma-joined."""
    def among(kinds: list[str]) -> Column:
        return F.filter("spans", lambda x: x["kind"].isin(kinds))

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    counts = [F.size(among([r.kind])).cast("long").alias(f"n_{r.kind}") for r in base]
    own = among([r.kind for r in base])
    return found.select(
        id, *counts, F.sha2(said(own), 256).alias("base_sha256"), said(F.col("spans")).alias("spans")
    )

