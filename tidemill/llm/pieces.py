"""SentencePiece models of merge type: ids by a table of last tokens, and their decoder.

Adjacent symbols merge by the score of what they make, the leftmost of equal scores
first.  A run of tokens is what merging leaves of a text if and only if merging leaves
each two neighbours as they are: up to the first merge across a border the two sides
merge as they would alone.  So every prefix of a text has one last token.  An automaton
finds the tokens that end at a place; the one whose left neighbour, the last token of the
prefix before it, does not merge across their border is stored.  Ids are recovered from
the end of the text backwards.

Two neighbours merge across their border if a symbol on the right edge of the one's merge
tree and one on the left edge of the other's make a token earlier than either is used up
by its own tree.  A token has one tree, as its symbols always merge as they do alone.

The table is filled for a chunk at a time: a border between two characters that no token
holds side by side is never crossed, so a chunk's ids do not depend on its neighbours.
Ids of chunks are remembered by a task, a bounded number of them.

Models read: merge type with byte fallback, no character map, blanks as ``\\u2581`` with
one in front.  Another kind raises an error.

* Null text counts as empty: no ids, empty text back.
* Characters that the model lacks become their UTF-8 bytes' ids; bytes that make no
  character decode to one replacement sign each.
* ``\\u2581`` in a text is a blank to the model and comes back as one.
* Repeated rows are rows of their own; extra columns are ignored or kept, as asked.
* An empty table gives no rows.
"""

from __future__ import annotations

import codecs
import itertools
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemill.llm.bpe import _lists, _parts

BLANK = "▁"
KEPT = 300_000     # chunks whose ids a task remembers
LONGEST = 100      # characters of a chunk that is worth remembering
PAIRS = 1_000_000  # pairs of tokens whose test a task remembers
WINDOW = 1 << 16   # ids decoded at once
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed by the file format
NEVER = float("-inf")


class Model:
    """The pieces of a file: names, kinds and scores by id."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        said = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            said.ParseFromString(file.read())
        rules, kinds = said.normalizer_spec, {x.type for x in said.pieces}
        if said.trainer_spec.model_type != 2 or not said.trainer_spec.byte_fallback:
            raise ValueError("not a merge model with byte fallback")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("the model changes characters")
        if not rules.add_dummy_prefix or said.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model does not put a blank in front")
        if kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"unknown kinds of pieces {sorted(kinds)}")
        self.names = [x.piece for x in said.pieces]
        self.kinds = [x.type for x in said.pieces]
        self.scores = [x.score for x in said.pieces]
        self.ids = {x: i for i, x in enumerate(self.names) if self.kinds[i] == NORMAL}
        self.bytes = {int(x[1:-1], 16): i for i, x in enumerate(self.names) if self.kinds[i] == BYTE}
        self.unknown = said.trainer_spec.unk_surface
        if any(c not in self.ids for x in self.ids for c in x):
            raise ValueError("a piece holds a character that is none")


def chunks_of(names: Iterable[str]) -> re.Pattern[str] | None:
    """What cuts a text where no piece crosses: letters and others apart, blanks in front.

    Letters that a piece joins to other characters count as such.  None if that is not enough.
    """
    names, odd = [x.replace(BLANK, " ") for x in names], ""
    while True:
        letter = rf"[^\W\d_{re.escape(odd)}]"
        cut = re.compile(rf" *{letter}+| *(?:(?!{letter})[^ ])+| +")
        crossing = [x for x in names if len(cut.findall(x)) > 1]
        more = "".join({c for x in crossing for c in re.findall(letter, x) if len(x.strip()) < 4})
        if not crossing or not more:
            return None if crossing else cut
        odd += more


class Encoder:
    """Ids of texts, four little-endian bytes each."""

    def __init__(self, path: str) -> None:
        model = Model(path)
        self.ids, self.scores, self.names, self.bytes = model.ids, model.scores, model.names, model.bytes
        self.cut = chunks_of(self.ids)
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self._trees()
        self.found = ahocorasick.Automaton()
        for name, i in self.ids.items():
            if self.whole[i]:
                self.found.add_word(name, (len(name), i))
        self.found.make_automaton()

    def merged(self, text: str) -> list[tuple[str, tuple[str, str] | None]]:
        """What plain merging leaves of a short text, each with the merge that made it."""
        out: list[tuple[str, tuple[str, str] | None]] = [(c, None) for c in text]
        while len(out) > 1:
            best, at = NEVER, -1
            for i in range(len(out) - 1):
                made = self.ids.get(out[i][0] + out[i + 1][0])
                if made is not None and self.scores[made] > best:
                    best, at = self.scores[made], i
            if at < 0:
                break
            a, b = out[at][0], out[at + 1][0]
            out[at : at + 2] = [(a + b, (a, b))]
        return out

    def _trees(self) -> None:
        """Each token's tree and edges; tokens that merging never makes are left out."""
        n = len(self.names)
        self.whole, self.plain = [False] * n, [False] * n
        self.made: dict[tuple[int, int], int] = {}
        # Symbols of an edge from the whole token inwards, with the score of what uses each up.
        self.left: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        self.right: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for name in sorted(self.ids, key=len):
            i, score = self.ids[name], self.scores[self.ids[name]]
            self.left[i], self.right[i] = [(i, NEVER)], [(i, NEVER)]
            if len(name) == 1:
                self.whole[i] = self.plain[i] = True
                continue
            left = self.merged(name)
            if len(left) > 1:
                continue
            a, b = (self.ids[x] for x in left[0][1])
            self.whole[i] = True
            # Scores fall from the leaves to the whole token: time can be read from them.
            self.plain[i] = all(self.plain[x] and (len(self.names[x]) == 1 or self.scores[x] > score) for x in (a, b))
            self.plain[i] &= name.strip(BLANK) != ""
            self.made[a, b] = i
            self.left[i] += [(x, max(y, score) if x == a else y) for x, y in self.left[a]]
            self.right[i] += [(x, max(y, score) if x == b else y) for x, y in self.right[b]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves the text of two tokens as these two."""
        key = a << 32 | b
        said = self.pairs.get(key)
        if said is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            said = self.pairs[key] = self._compatible(a, b)
        return said

    def _compatible(self, a: int, b: int) -> bool:
        if not (self.plain[a] and self.plain[b]):
            return [x for x, _ in self.merged(self.names[a] + self.names[b])] == [self.names[a], self.names[b]]
        made, scores = self.made, self.scores
        for x, used_x in self.right[a]:
            for y, used_y in self.left[b]:
                both = made.get((x, y))
                # Of equal scores the left one merges first.
                if both is not None and scores[both] > used_x and scores[both] >= used_y:
                    return False
        return True

    def _chunk(self, chunk: str) -> bytes:
        """Ids of one chunk, in which blanks are BLANK already."""
        # By end of prefix: the id of its last token, ~code point for a character without a piece.
        last = array("q", [0]) * (len(chunk) + 1)
        filled, pairs, compatible = 0, self.pairs, self.compatible
        for end, (size, i) in self.found.iter(chunk):
            end += 1
            if end == filled:
                continue
            while filled < end - 1:
                last[filled + 1] = ~ord(chunk[filled])
                filled += 1
            before = last[end - size] if end > size else -1
            if before >= 0:
                fits = pairs.get(before << 32 | i)
                if fits is None:
                    fits = compatible(before, i)
                if not fits:
                    continue
            last[end] = i
            filled = end
        while filled < len(chunk):
            last[filled + 1] = ~ord(chunk[filled])
            filled += 1
        out, end = array("i"), len(chunk)
        while end:
            i = last[end]
            if i >= 0:
                out.append(i)
                end -= len(self.names[i])
            else:
                out.extend(self.bytes[x] for x in reversed(chr(~i).encode()))
                end -= 1
        out.reverse()
        return out.tobytes()

    def encode_many(self, texts: Iterable[str]) -> list[bytes]:
        out = []
        for text in texts:
            if not text:
                out.append(b"")
                continue
            text = " " + text.replace(BLANK, " ")
            if not self.cut:
                out.append(self._chunk(text.replace(" ", BLANK)))
                continue
            if len(self.known) > KEPT:
                self.known.clear()
            known, parts = self.known, self.cut.findall(text)
            new = set(parts).difference(known)
            for chunk in new:
                known[chunk] = self._chunk(chunk.replace(" ", BLANK))
            out.append(b"".join(map(known.__getitem__, parts)))
            for chunk in new:
                if len(chunk) > LONGEST:
                    del known[chunk]
        return out

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_many([text])[0]).tolist()


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


class Decoder:
    """Text of ids that come one after the other.

    The state is the unfinished character and whether the blank in front is still to come.
    """

    def __init__(self, path: str) -> None:
        model = Model(path)
        codecs.register_error("tidemill-each-byte", _each_byte)
        self.bits = [x.replace(BLANK, " ").encode() for x in model.names]
        for byte, i in model.bytes.items():
            self.bits[i] = bytes([byte])
        self.normal = [x == NORMAL for x in model.kinds]
        # What ends a character that its bytes have begun.
        self.breaks = {i for i, x in enumerate(model.kinds) if x in (UNKNOWN, CONTROL)}
        for i in self.breaks:
            self.bits[i] = model.unknown.encode() if model.kinds[i] == UNKNOWN else b""
        self.silent = {i for i, x in enumerate(model.kinds) if x == CONTROL}

    def feed(self, runs: Iterable[Sequence[int]]) -> Iterator[str]:
        """Text for each run of ids, given as soon as it is certain."""
        state = codecs.getincrementaldecoder("utf-8")("tidemill-each-byte")
        at_start = True
        for ids in runs:
            if at_start:
                ids = list(itertools.dropwhile(self.silent.__contains__, ids))
                if not ids:
                    continue
            bits = [self.bits[i] for i in ids]
            if at_start:
                at_start = False
                if self.normal[ids[0]] and bits[0].startswith(b" "):
                    bits[0] = bits[0][1:]
            if self.breaks.isdisjoint(ids):
                yield state.decode(b"".join(bits))
                continue
            for i, x in zip(ids, bits):
                yield state.decode(b"", True) + state.decode(x) if i in self.breaks else state.decode(x)
        yield state.decode(b"", True)

    def decode(self, ids: Sequence[int]) -> str:
        return "".join(self.feed(ids[i : i + WINDOW] for i in range(0, len(ids), WINDOW)))


def encoded(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ids array<int>."""
    given = docs.select(docs[id].alias("key"), docs[text].cast("string").alias("body"))
    encoder = Encoder(path)  # tasks get a copy, which is as large as the vocabulary

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, 1):
                rows = encoder.encode_many(x or "" for x in part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(rows)], names=["key", "ids"])

    out = StructType([StructField("key", given.schema["key"].dataType), StructField("ids", ArrayType(IntegerType()))])
    return given.mapInArrow(encode, out).withColumnRenamed("key", id)


def decoded(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All rows and columns with the text of ``ids`` in a column ``out``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for batch in batches:
            for part in _parts(batch, batch.schema.get_field_index(ids)):
                lists = part.column(ids)
                at, values = lists.offsets.to_numpy().tolist(), lists.values.to_numpy()
                texts = [decoder.decode(values[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    return rows.mapInArrow(decode, StructType([*rows.schema, StructField(out, StringType())]))


def digests(rows: DataFrame, id: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        id, F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
