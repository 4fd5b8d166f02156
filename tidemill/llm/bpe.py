"""BPE as a streaming transducer with bounded lookahead, and its decoder.

A merge list fixes how far to the right a token can depend on text: a boundary moves to
the left only through merges of ever later rank, each of which takes in a right part that
begins where the merge before it began.  The heaviest such chain is a sufficient
lookahead.  Words are read as they come; once the lookahead lies behind a token, the token
is stable and is emitted, and the buffer never holds more than a block and the lookahead.

Files of the tokenizers library are read as they are: added tokens, normalisers,
splitting pattern, byte letters, end-of-word suffix, decoder.  The kinds are those of the
public files; another kind raises an error.

* Null text counts as empty: no ids, empty text back.
* Repeated rows are rows of their own; extra columns are ignored or kept, as asked.
* An empty table gives no rows.
"""

from __future__ import annotations

import codecs
import itertools
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemill.llm.memory import releasing
from tidemill.llm.shingles import mix

BLOCK = 256         # symbols settled at once in a long word
KEPT = 1_000_000    # characters of pieces remembered anew until those not seen meanwhile are forgotten
LONGEST = 200       # characters of a piece that is worth remembering
PIECES = 200_000    # pieces encoded at once
SLICE = 1 << 12     # characters of a long word read at once
WINDOW = 1 << 16    # characters of a text cut into pieces at once
BATCH = 1 << 19     # characters of text, or ids, in one batch of results
# White space as the files' patterns mean it, inside brackets.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
TAIL = ".,;:!?|"     # punctuation that often ends a piece
NEVER = 1 << 40     # rank of a pair that does not merge
# The splitting pattern of byte-level files that name none.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else 256 and up."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """A merge list over symbols (strings of letters), in which each token is made one way."""

    def __init__(self, merges: list[tuple[str, str]]) -> None:
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.lookahead = self._lookahead(merges)

    @staticmethod
    def _lookahead(merges: list[tuple[str, str]]) -> int:
        """Symbols of the base alphabet that must be known behind a token before it is stable.

        ``reach[u]``: the farthest that what happens right of a boundary can have moved it
        when the last merge on the way had ``u`` as its left part.  The next one must have a
        later rank and a right part that begins, merge by merge, with ``u``.
        """
        size: dict[str, int] = {}
        left: dict[str, str] = {}
        reach: dict[str, int] = {}
        most = 0
        for a, b in merges:
            for x in (a, b):
                size.setdefault(x, 1)
            best, x = size[b], b
            while x is not None:
                best = max(best, reach.get(x, 0))
                x = left.get(x)
            best += size[a]
            whole = a + b
            if whole in size:
                raise ValueError(f"{whole} is made twice, or before its merge")
            size[whole], left[whole] = size[a] + size[b], a
            reach[a] = max(reach.get(a, 0), best)
            most = max(most, best)
        return most

    def merged(self, symbols: list[str]) -> list[str]:
        """All merges of a closed word: the lowest rank first, from the left."""
        ranks, parts = self.ranks, symbols
        while len(parts) > 1:
            pairs = [ranks.get(x, -1) for x in zip(parts, parts[1:])]
            low = min((x for x in pairs if x >= 0), default=-1)
            if low < 0:
                break
            out, i, n = [], 0, len(parts)
            while i < n:
                if i + 1 < n and pairs[i] == low:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def stream(self, symbols: Iterable[str], width: Callable[[str], int] = len) -> Iterator[str]:
        """Tokens of one word, each as soon as it is stable; ``width`` counts a token's symbols.

        Tokens that end before the last ``lookahead`` symbols read so far do not change
        any more; what follows them is merged as if the word began there.
        """
        buffer: list[str] = []
        symbols, size = iter(symbols), self.lookahead + BLOCK
        while True:
            buffer += itertools.islice(symbols, size - len(buffer))
            if len(buffer) < size:
                yield from self.merged(buffer)
                return
            used, stable = 0, len(buffer) - self.lookahead
            for token in self.merged(buffer):
                if used + width(token) > stable:
                    break
                used += width(token)
                yield token
            del buffer[:used]
            # A token longer than a block waits for more.
            size = max(self.lookahead, len(buffer)) + BLOCK


class Encoder:
    """Ids of texts under a file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model = said["model"]
        if model["type"] != "BPE" or model["byte_fallback"] or model["dropout"] or model["continuing_subword_prefix"]:
            raise ValueError("only plain BPE files are read")
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.merges = Merges(merges)
        self.ids: dict[str, int] = model["vocab"]
        self.added = {x["content"]: x["id"] for x in said["added_tokens"]}
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] or regex.search(r"\s", x["content"]) for x in said["added_tokens"]):
            raise ValueError("only plain added tokens are read")
        longest = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.cut_added = regex.compile(f"({'|'.join(longest)})") if longest else None
        self.steps = self._normalisers(said["normalizer"])
        pattern = self._pattern(said["pre_tokenizer"])
        explicit = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
        self.words = regex.compile(explicit)
        # Where no word holds white space, texts are cut there first.
        self.by_space = all(self.words.findall(f" {x} ") == [x] for x in "a1!") and not self.words.findall(" \n")
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.letters = _byte_letters()
        self.simple = self.by_space and "Lowercase" in self.steps and self.words.findall("ab" + TAIL) == ["ab", TAIL]
        self._tables()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept = 0

    @staticmethod
    def _normalisers(said: dict | None) -> list[str]:
        steps = [] if said is None else said["normalizers"] if said["type"] == "Sequence" else [said]
        names = [x["type"] for x in steps]
        if any(x["type"] == "Replace" and (x["pattern"], x["content"]) != ({"Regex": r"\s+"}, " ") for x in steps):
            raise ValueError("only white space is replaced")
        if set(names) - {"NFC", "Replace", "Lowercase"}:
            raise ValueError(f"unknown normaliser among {names}")
        return names

    @staticmethod
    def _pattern(said: dict) -> str:
        steps = said["pretokenizers"] if said["type"] == "Sequence" else [said]
        pattern = None
        for x in steps:
            if x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"]:
                pattern = x["pattern"]["Regex"]
            elif x["type"] == "ByteLevel" and not x["add_prefix_space"]:
                pattern = BYTE_LEVEL if x["use_regex"] else pattern
            else:
                raise ValueError(f"unknown splitter {x['type']}")
        return pattern

    def normalised(self, text: str) -> str:
        for step in self.steps:
            if step == "NFC":
                text = unicodedata.normalize("NFC", text)
            elif step == "Replace":
                text = self.spaces.sub(" ", text)
            else:
                # Letter by letter: a sigma at the end of a word is no exception.
                text = text.replace("\u03a3", "\u03c3").lower()
        return text

    def _width(self, token: str) -> int:
        return len(token) - len(self.suffix) if self.suffix and token.endswith(self.suffix) else len(token)

    def tokens(self, word: str) -> Iterator[str]:
        """Tokens of one word of the splitting pattern, as the transducer emits them."""
        return self.merges.stream(self._symbols(word), self._width)

    def _symbols(self, word: str) -> Iterator[str]:
        """The symbols of a word, which is read a slice of it at a time."""
        before = None
        for begin in range(0, len(word), SLICE):
            for b in word[begin : begin + SLICE].encode("utf-8", "surrogatepass"):
                if before is not None:
                    yield before
                before = self.letters[b]
        if before is not None:
            yield before + self.suffix

    def _words(self, piece: str) -> Iterator[str | int]:
        """Words of a piece, and the ids of added tokens."""
        for part in self.cut_added.split(piece) if self.cut_added else [piece]:
            if part in self.added:
                yield self.added[part]
            elif part:
                yield from self.words.findall(self.normalised(part))

    def _cut(self, text: str) -> Iterator[list[str]]:
        """The text in pieces that are encoded one by one, a window of it at a time."""
        if not self.by_space:
            yield [text]
            return
        odd = any(x in text for x in "\x1c\x1d\x1e\x1f")  # white space to Python only
        begin = 0
        while begin < len(text):
            gap = self.spaces.search(text, begin + WINDOW) if begin + WINDOW < len(text) else None
            end = gap.start() if gap else len(text)
            window = text[begin:end]
            yield self.spaces.split(window) if odd else window.split()
            begin = end

    def encode_many(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of the whole texts, four little-endian bytes each."""
        out: list[list[bytes]] = []
        waiting, size = [], 0
        for i, text in enumerate(texts):
            out.append([])
            for pieces in self._cut(text):
                waiting.append((i, pieces))
                size += len(pieces)
                if size >= PIECES:
                    self._settle(waiting, out)
                    waiting, size = [], 0
        self._settle(waiting, out)
        return [b"".join(x) for x in out]

    def _settle(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if self.kept > KEPT:
            self.known, self.older, self.kept = {}, self.known, 0
        known, older = self.known, self.older
        new = set().union(*(x for _, x in waiting)).difference(known)
        again = new.intersection(older)
        new -= again
        for piece in again:
            known[piece] = older.pop(piece)
            self.kept += len(piece)
        at: dict[str, int] = {}
        plan = []
        for piece in new:
            core = piece.rstrip(TAIL)
            if self.simple and core.isalpha() and core.isascii():
                words = [core.lower(), piece[len(core) :]] if len(core) < len(piece) else [core.lower()]
            else:
                words = self._words(piece)
            plan.append((piece, [x if isinstance(x, int) else ~at.setdefault(x, len(at)) for x in words]))
        data, ends = self._closed(list(at))
        for piece, words in plan:
            known[piece] = b"".join(
                x.to_bytes(4, "little") if x >= 0 else data[ends[~x] : ends[~x + 1]] for x in words
            )
        for i, pieces in waiting:
            out[i].append(b"".join(map(known.__getitem__, pieces)))
        for piece in new:
            if len(piece) > LONGEST:
                del known[piece]
            else:
                self.kept += len(piece)

    def _closed(self, words: list[str]) -> tuple[bytes, list[int]]:
        """Ids of all words, and the byte at which each word's end.

        Words shorter than the lookahead close before anything could be emitted; they are
        merged together, step by step.  Longer ones go through the transducer.
        """
        coded = [x.encode("utf-8", "surrogatepass") if len(x) <= LONGEST else None for x in words]
        long = {i for i, x in enumerate(coded) if x is None or len(x) > LONGEST}
        short = [b"" if i in long else x for i, x in enumerate(coded)] if long else coded
        ids, counts = self.lockstep(short)
        if not long:
            return ids.tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in long:
            parts[i] = np.fromiter((self.ids[x] for x in self.tokens(words[i])), np.int32)
        return b"".join(x.tobytes() for x in parts), [0, *np.cumsum([x.nbytes for x in parts]).tolist()]

    def lockstep(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of closed words, and how many each has: every word takes its next merge at once."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(x) for x in words], np.int64)
        symbols, owner = self.single[raw].astype(np.int64), np.repeat(np.arange(len(words)), sizes)
        last = np.cumsum(sizes)[sizes > 0] - 1
        symbols[last] = self.final[raw[last]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = np.full(len(symbols), NEVER, np.int64)
            rank[:-1] = np.where(owner[1:] == owner[:-1], self._rank(symbols[:-1] << 20 | symbols[1:]), NEVER)
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(owner))))
            open_ = low < NEVER
            done.append((owner[~open_], symbols[~open_]))
            hit = np.flatnonzero((rank == low) & open_)
            # In a run of equal pairs that overlap, the first, third, ... are merged.
            begins = np.diff(hit, prepend=-9) != 1
            run = np.cumsum(begins) - 1
            hit = hit[(hit - hit[begins][run]) % 2 == 0] if len(hit) else hit
            symbols[hit] = self.product[rank[hit]]
            keep = open_
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owner = np.concatenate([x for x, _ in done] or [owner])
        ids = np.concatenate([x for _, x in done] or [symbols]).astype(np.int32)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def _rank(self, pairs: np.ndarray) -> np.ndarray:
        slot = self._slot(pairs)
        out = np.full(len(pairs), NEVER, np.int64)
        left = np.arange(len(pairs))
        while len(left):
            found = self.slots[slot]
            hit = found == pairs[left]
            out[left[hit]] = self.slot_rank[slot[hit]]
            on = ~hit & (found >= 0)
            left, slot = left[on], (slot[on] + 1) & (len(self.slots) - 1)
        return out

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return mix(pairs.astype(np.uint64)).astype(np.int64) & (len(self.slots) - 1)

    def _tables(self) -> None:
        """Ids of single symbols and a hash table from pairs of ids to their rank."""
        ids, letters = self.ids, self.letters
        self.single = np.array([ids[letters[b]] for b in range(256)])
        self.final = np.array([ids[letters[b] + self.suffix] for b in range(256)])
        self.product = np.array([ids[a + b] for a, b in self.merges.ranks])
        self.slots = np.full(1 << 18, -1, np.int64)
        self.slot_rank = np.zeros(1 << 18, np.int32)
        pairs = np.array([ids[a] << 20 | ids[b] for a, b in self.merges.ranks], np.int64)
        left = np.arange(len(pairs))
        slot = self._slot(pairs)
        while len(left):
            # Of those that want a free slot the first takes it; the others go on.
            _, first = np.unique(slot, return_index=True)
            first = first[self.slots[slot[first]] < 0]
            self.slots[slot[first]], self.slot_rank[slot[first]] = pairs[left[first]], left[first]
            on = np.ones(len(left), bool)
            on[first] = False
            left, slot = left[on], (slot[on] + 1) & (len(self.slots) - 1)

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]


class Decoder:
    """Text of ids that come one after the other.

    Byte-level files give bytes, and the state is the unfinished character; a byte that
    cannot go on gives the replacement sign.  Files without a decoder give the tokens'
    names with one blank between, and the state is whether one has been given.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        names = {v: k for k, v in said["model"]["vocab"].items()} | {x["id"]: x["content"] for x in said["added_tokens"]}
        if said["decoder"] is not None and said["decoder"]["type"] != "ByteLevel":
            raise ValueError(f"unknown decoder {said['decoder']['type']}")
        self.bytes = None
        if said["decoder"]:
            letters = {c: b for b, c in _byte_letters().items()}
            self.bytes = {
                i: bytes(letters[c] for c in x) if all(c in letters for c in x) else x.encode() for i, x in names.items()
            }
        self.names = names

    def feed(self, pieces: Iterable[Sequence[int]]) -> Iterator[str]:
        """Text for each run of ids, given as soon as it is certain."""
        if self.bytes is None:
            between = ""
            for ids in pieces:
                found = " ".join(self.names[i] for i in ids if i in self.names)
                if found:
                    yield between + found
                    between = " "
            return
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in pieces:
            yield state.decode(b"".join(self.bytes.get(i, b"") for i in ids))
        yield state.decode(b"", True)

    def decode(self, ids: Sequence[int]) -> str:
        return "".join(self.feed(ids[i : i + WINDOW] for i in range(0, len(ids), WINDOW)))


def encoded(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ids array<int>."""
    given = docs.select(docs[id].alias("key"), docs[text].cast("string").alias("body"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for part in _parts(batch, 1):
                rows = encoder.encode_many(x or "" for x in part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(rows)], names=["key", "ids"])

    out = StructType([StructField("key", given.schema["key"].dataType), StructField("ids", ArrayType(IntegerType()))])
    return given.mapInArrow(releasing(encode), out).withColumnRenamed("key", id)


def decoded(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All rows and columns with the text of ``ids`` in a column ``out``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for batch in batches:
            for part in _parts(batch, batch.schema.get_field_index(ids)):
                lists = part.column(ids)
                at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
                texts = [decoder.decode(values[a:b].tolist()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    kind = StructType([x for x in rows.schema] + [StructField(out, StringType())])
    return rows.mapInArrow(releasing(decode), kind)


def _lists(rows: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of some BATCH characters or ids, whole rows always."""
    values = batch.column(column)
    sizes = pc.utf8_length(values) if pa.types.is_string(values.type) else pc.list_value_length(values)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + BATCH, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def digests(rows: DataFrame, id: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by one blank), decoded_sha256."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        id, F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
