"""Token ids as length-delimited binary records with a separate offset index.

A data file is a sequence of frames, each

    length of the data   8 bytes, little-endian
    masked CRC of those  4 bytes
    data                 the ids, little-endian, 2 bytes each (4 where the vocabulary needs it)
    masked CRC of it     4 bytes

with CRC-32C, masked by a rotation and a constant so that a checksum stored inside data
does not look like one.  The index is a Parquet table with one row per record: its key,
file, offset and counts; shuffled or partial reads go through it.

Tasks write under names of their own and name their file in the index rows they return,
which Spark commits.  A lost executor's half-written file is therefore never read; such
files remain in the folder until ``drop_orphans``.

* Null text counts as empty; its record holds the end id alone.
* Records are in ascending id order (null ids last), repeated ids in the order of their text.
* An empty table gives an empty index; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

MASK_DELTA = 0xA282EAD8  # fixed by the frame format
POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected
BLOCK = 256              # bytes of a checksum lane
KEPT = 6_000_000         # characters of pieces whose ids a task remembers
ASKED = 20_000           # pieces asked for at once
CHUNK = 2 << 20          # bytes of text encoded, or of frames read, at once
FILE_BYTES = 64 << 20    # bytes of text in one data file

INDEX = [
    "key", "file string", "part int", "nth long", "start long", "offset long", "length long", "n_tokens long", "width int",
]


# A word of a piece, with its newline, and punctuation behind it; most pieces are such.
USUAL = re.compile(r"((\n?)([A-Za-z]+))([.,;:!?]*)").fullmatch
BLANK = chr(256 + 32)  # the letter of a blank's byte
# Punctuation that may end a piece, and the first letter past those every library agrees on.
TAIL = ".,;:!?"
LATIN_END = "\u0250"


def _byte_letters() -> dict[int, int]:
    """The letter that stands for a byte in byte-level files: itself if it prints, else 256 and up."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: b for b in prints} | {b: 256 + i for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


class Crc32c:
    """CRC-32C of many byte strings at once: all blocks of BLOCK bytes advance in step.

    Leading zeros leave a zero state as it is, so every string is padded in front to
    whole blocks; the usual starting state is the same as inverting its first four
    bytes.  Blocks of a string are joined by the linear map "BLOCK zero bytes later".
    """

    def __init__(self) -> None:
        self.one = one = _byte_table()
        two = (one[np.arange(65536) & 255] >> 8) ^ one[(one[np.arange(65536) & 255] ^ (np.arange(65536) >> 8)) & 255]
        self.pairs = two.astype(np.uint32)
        state = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(BLOCK):
            state = (state >> np.uint32(8)) ^ one[state & np.uint32(255)]
        self.later = np.zeros((4, 256), np.uint32)
        for byte in range(4):
            for bit in range(8):
                self.later[byte] ^= np.where(np.arange(256) >> bit & 1, state[8 * byte + bit], 0).astype(np.uint32)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Checksums of ``data[starts[i]:ends[i]]``."""
        sizes = ends - starts
        short = np.flatnonzero(sizes < 4)
        if len(short):
            # Too short for the inverted head: a byte at a time.
            out = np.zeros(len(sizes), np.uint32)
            rest = np.flatnonzero(sizes >= 4)
            out[rest] = self(data, starts[rest], ends[rest])
            for i in short:
                state = 0xFFFFFFFF
                for byte in data[starts[i] : ends[i]].tolist():
                    state = (state >> 8) ^ int(self.one[(state ^ byte) & 255])
                out[i] = state ^ 0xFFFFFFFF
            return out
        blocks = -(-sizes // BLOCK)
        first = np.cumsum(blocks) - blocks
        room = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)
        heads = (first + blocks) * BLOCK - sizes
        for a, b, to in zip(starts.tolist(), ends.tolist(), heads.tolist()):
            room[to : to + b - a] = data[a:b]
        for i in range(4):
            room[heads + i] ^= 255
        lanes = np.ascontiguousarray(room.view("<u2").reshape(-1, BLOCK // 2).T)
        state = np.zeros(lanes.shape[1], np.uint32)
        for column in lanes:
            state = (state >> np.uint32(16)) ^ self.pairs[(state & np.uint32(0xFFFF)) ^ column]
        out = np.zeros(len(sizes), np.uint32)
        order = np.argsort(-blocks, kind="stable")
        falling = -blocks[order]
        for i in range(int(blocks.max(initial=0))):
            # The records that have an i-th block.
            on = order[: np.searchsorted(falling, -i)]
            x = out[on]
            moved = self.later[0][x & 255] ^ self.later[1][x >> 8 & 255] ^ self.later[2][x >> 16 & 255] ^ self.later[3][x >> 24]
            out[on] = moved ^ state[first[on] + i]
        return ~out

    def masked(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        crc = self(data, starts, ends)
        return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def frames(crc: Crc32c, data: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The records of ``sizes`` bytes that make up ``data``, framed; and each frame's offset."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    heads = sizes.astype("<u8").view(np.uint8)
    eight = np.arange(len(sizes)) * 8
    head_sums = crc.masked(heads, eight, eight + 8).astype("<u4")
    data_sums = crc.masked(data, starts, ends).astype("<u4")
    parts, view, head, tail = [], memoryview(data), memoryview(heads), memoryview(data_sums.view(np.uint8))
    middle = memoryview(head_sums.view(np.uint8))
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        parts += [head[8 * i : 8 * i + 8], middle[4 * i : 4 * i + 4], view[a:b], tail[4 * i : 4 * i + 4]]
    offsets = starts + 16 * np.arange(len(sizes))
    return b"".join(parts), offsets


def unframed(crc: Crc32c, buffer: bytes, offsets: np.ndarray, lengths: np.ndarray) -> list[memoryview]:
    """The data of the frames at ``offsets``; raises where a length or a checksum does not fit."""
    raw = np.frombuffer(buffer, np.uint8)
    take = lambda at, n: np.stack([raw[at + i] for i in range(n)], axis=1)
    said = np.ascontiguousarray(take(offsets, 8)).view("<u8").ravel()
    heads = np.ascontiguousarray(take(offsets + 8, 4)).view("<u4").ravel()
    tails = np.ascontiguousarray(take(offsets + 12 + lengths, 4)).view("<u4").ravel()
    ok = (said == lengths) & (heads == crc.masked(raw, offsets, offsets + 8))
    ok &= tails == crc.masked(raw, offsets + 12, offsets + 12 + lengths)
    if not ok.all():
        raise ValueError(f"damaged record at offset {int(offsets[~ok][0])}")
    view = memoryview(buffer)
    return [view[a : a + n] for a, n in zip((offsets + 12).tolist(), lengths.tolist())]


def _open(path: str):
    """The file system of a folder's address and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


class WordIds:
    """Ids of whole texts by the tokenizers library, a piece at a time.

    The splitter of a byte-level file never joins what stands before a space or a newline
    with what follows it, unless white space meets white space.  Texts are cut there, each
    newline going with the piece it precedes; the library is asked once for pieces not seen
    before, many at a time, and KEPT characters of pieces are remembered.  Texts with runs
    of white space, and files of another kind, are asked for whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = [x["content"] for x in said["added_tokens"]]
        split = said["pre_tokenizer"] or {}
        newline = self._ids("\n")
        self.by_piece = (
            said["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(" " in x["content"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in said["added_tokens"])
            and len(newline) == 1
        )
        self.newline = newline[0] if newline else -1
        self.model, self.code = self.tokenizer.model, "H" if self.width == "<u2" else "I"
        self.line = np.array(newline, self.width).tobytes()
        self.tails = {"": b""}
        self.known: dict[str, bytes | None] = {}  # None: white space follows, not to be cut there
        self.kept = 0

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _whole(self, text: str) -> bytes:
        return np.array(self._ids(text), self.width).tobytes()

    def _word(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.encode().decode("latin-1").translate(BYTE_LETTERS))
        return array(self.code, [x.id for x in tokens]).tobytes()

    def _tail(self, run: str) -> bytes:
        if run not in self.tails:
            self.tails[run] = self._word(run)
        return self.tails[run]

    def _ascii_word(self, core: str) -> bytes:
        """As ``_word``, for letters whose bytes stand for themselves; a blank is its letter already."""
        return array(self.code, [x.id for x in self.model.tokenize(core)]).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Ids of " piece", or of "piece" where it starts with its newline."""
        self.kept += sum(map(len, pieces))
        plain, known, tails = [], self.known, self.tails
        for piece in pieces:
            usual = USUAL(piece)
            if usual:
                # A word that was seen with another ending is not encoded again.
                word, newline, core, tail = usual.groups()
                ids = known.get(word)
                if ids is None:
                    ids = self.line + self._ascii_word(core) if newline else self._ascii_word(BLANK + core)
                    known[word] = ids
                    self.kept += len(word) if tail else 0
                if tail:
                    known[piece] = ids + (tails[tail] if tail in tails else self._tail(tail))
                continue
            body = piece.removeprefix("\n")
            core = body.rstrip(TAIL)
            if not body or body[0].isspace():
                self.known[piece] = None
            elif core.isalpha() and max(core) < LATIN_END:
                # A word and a run of punctuation: one run of the merges each.
                head = self.line if piece[0] == "\n" else b""
                self.known[piece] = head + self._word(("" if head else " ") + core) + self._tail(body[len(core) :])
            elif any(x in piece for x in self.special):
                self.known[piece] = self._whole(piece if piece[0] == "\n" else " " + piece)
            else:
                plain.append(piece)
        for i in range(0, len(plain), ASKED):
            part = plain[i : i + ASKED]
            # Each piece on a line of its own: the newlines' ids tell the pieces apart.
            ids = np.array(self._ids("".join([x if x[0] == "\n" else "\n " + x for x in part])), self.width)
            cuts = np.append(np.flatnonzero(ids == self.newline), len(ids))
            if len(cuts) != len(part) + 1:
                self.known.update((x, self._whole(x if x[0] == "\n" else " " + x)) for x in part)
                continue
            data, step = ids.tobytes(), ids.itemsize
            for piece, a, b in zip(part, cuts[:-1].tolist(), cuts[1:].tolist()):
                self.known[piece] = data[a * step if piece[0] == "\n" else (a + 1) * step : b * step]

    def of(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, ``width`` bytes each."""
        if not self.by_piece:
            return [self._whole(x) for x in texts]
        if self.kept > KEPT:
            self.known, self.kept = {}, 0
        step = np.dtype(self.width).itemsize
        cut = [("\n" + text).replace("\n", " \n").split(" ")[1:] for text in texts]
        self._learn(list(set().union(*cut).difference(self.known)))
        get = self.known.__getitem__
        out = []
        for text, pieces in zip(texts, cut):
            try:
                out.append(b"".join(map(get, pieces))[step:])
            except TypeError:  # runs of white space
                out.append(self._whole(text))
        return out


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encodes, writes data files and the index under ``folder``; returns the index as stored.

    Index: key, file, part (files are in key order), nth and start (records and ids before it
    in the file), offset and length of the frame's data, n_tokens (with the end id).
    """
    spark = docs.sparkSession
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[id].alias("key"), F.xxhash64(body).alias("tie"), body.alias("body"))
    order = [F.col("key").asc_nulls_last(), F.col("tie")]
    # Files of a size, so that a task's tables and known pieces serve much text.
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    rows = rows.repartitionByRange(size // FILE_BYTES + 1, *order).sortWithinPartitions(*order).select("key", "body")
    kind = rows.schema["key"].dataType.simpleString()
    data_folder = posixpath.join(folder, "data")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, crc = WordIds(tokenizer), Crc32c()
        end, width = np.array([end_id], words.width).tobytes(), np.dtype(words.width).itemsize
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        files, place = _open(data_folder)
        files.create_dir(place, recursive=True)
        nth = offset = start = 0
        with files.open_output_stream(posixpath.join(place, name)) as out:
            for batch in batches:
                for keys, texts in _slices(batch):
                    ids = [x + end for x in words.of(texts)]
                    sizes = np.array([len(x) for x in ids], np.int64)
                    data, offsets = frames(crc, np.frombuffer(b"".join(ids), np.uint8), sizes)
                    out.write(data)
                    counts = sizes // width
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys, pa.array([name] * n), pa.array([part] * n, pa.int32()), pa.array(np.arange(nth, nth + n)),
                            pa.array(start + np.cumsum(counts) - counts), pa.array(offset + offsets), pa.array(sizes),
                            pa.array(counts), pa.array([width] * n, pa.int32()),
                        ],
                        names=[x.split()[0] for x in INDEX],
                    )
                    nth, offset, start = nth + n, offset + len(data), start + int(counts.sum())

    path = posixpath.join(folder, "index")
    rows.mapInArrow(write, ", ".join([f"key {kind}", *INDEX[1:]])).write.parquet(path)
    return spark.read.parquet(path)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of a batch, some CHUNK bytes of text at a time, whole texts always."""
    texts = batch.column(1)
    sizes = np.cumsum([len(x.as_buffer() or b"") if x.is_valid else 0 for x in texts])
    begin = 0
    while begin < len(texts):
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + CHUNK)))
        yield batch.column(0).slice(begin, end - begin), texts.slice(begin, end - begin).to_pylist()
        begin = end


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The index's rows, in any order or choice, with ``ids`` (bytes as stored), checksums verified."""
    data_folder = posixpath.join(folder, "data")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = Crc32c()
        files, place = _open(data_folder)
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by([("file", "ascending"), ("offset", "ascending")])
            names = table["file"].to_pylist()
            offsets, lengths = table["offset"].to_numpy(), table["length"].to_numpy()
            begin = 0
            while begin < len(names):
                # Frames that follow each other are one read.
                end = begin + 1
                stop = offsets[begin] + lengths[begin] + 16
                while (
                    end < len(names) and names[end] == names[begin] and offsets[end] == stop
                    and stop - offsets[begin] < CHUNK
                ):
                    stop += lengths[end] + 16
                    end += 1
                with files.open_input_file(posixpath.join(place, names[begin])) as source:
                    buffer = source.read_at(int(stop - offsets[begin]), int(offsets[begin]))
                data = unframed(crc, buffer, offsets[begin:end] - offsets[begin], lengths[begin:end])
                out = table.slice(begin, end - begin).combine_chunks()
                for part in out.append_column("ids", pa.array([bytes(x) for x in data], pa.binary())).to_batches():
                    yield part
                begin = end

    kinds = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in index.schema)
    return index.mapInArrow(read, f"{kinds}, ids binary")


def record_digests(index: DataFrame, folder: str, id: str = "doc_id") -> DataFrame:
    """Per record as read back: id, start (ids before it in all files), n_tokens, ids_crc32."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = [
                zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())
                for ids, width in zip(batch["ids"].to_pylist(), batch["width"].to_pylist())
            ]
            count = [len(x) // w for x, w in zip(batch["ids"].to_pylist(), batch["width"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["part"], batch["start"], pa.array(count, pa.int64()), pa.array(wide, pa.int64())],
                names=["key", "part", "own", "n_tokens", "ids_crc32"],
            )

    kind = index.schema["key"].dataType.simpleString()
    found = read_records(index, folder).mapInArrow(
        digest, f"key {kind}, part int, own long, n_tokens long, ids_crc32 long"
    )
    # One row per file, of some hundred MB each.
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    return found.join(F.broadcast(files), "part").select(
        F.col("key").alias(id), (F.col("before") + F.col("own")).alias("start"), "n_tokens", "ids_crc32"
    )


def drop_orphans(index: DataFrame, folder: str) -> int:
    """Removes data files that no index row names, left by lost tasks; returns their number."""
    from pyarrow import fs

    files, place = _open(posixpath.join(folder, "data"))
    named = {x.file for x in index.select("file").distinct().toLocalIterator()}
    lost = [x.path for x in files.get_file_info(fs.FileSelector(place)) if posixpath.basename(x.path) not in named]
    for path in lost:
        files.delete_file(path)
    return len(lost)
