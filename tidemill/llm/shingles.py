"""Word n-grams of many texts as 64-bit hashes, computed with numpy inside tasks.

Two texts share a hash when they share the n-gram; different n-grams collide with
probability 2^-64.  All hashes are fixed functions of the bytes, so retries and
different machines agree.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

# Base of the rolling word hash; odd, so powers can be inverted modulo 2^64.
BASE = 0x9E3779B97F4A7C15
SLICE = 1 << 20  # bytes hashed at once

_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NOT_WORD = np.zeros(256, bool)
_NOT_WORD[:128] = [not chr(c).isalnum() for c in range(128)]
SEPARATORS = {"space": _ASCII_SPACE, "punctuation": _NOT_WORD}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """Hashes the words of byte buffers; keeps the tables of powers."""

    def __init__(self, separators: str = "space") -> None:
        self.separators = SEPARATORS[separators]
        self.up = _powers(BASE, SLICE + 1)
        self.down = _powers(pow(BASE, -1, 1 << 64), SLICE + 1)

    def _tables(self, n: int) -> None:
        if len(self.up) <= n:
            self.up, self.down = _powers(BASE, n + 1), _powers(pow(BASE, -1, 1 << 64), n + 1)

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of ``data`` (A-Z lower-cased) and the byte at which each word starts.

        Long buffers are cut at separators, so memory is bounded by the slice and
        the longest word.
        """
        raw = np.frombuffer(data, np.uint8)
        if len(raw) <= SLICE:
            return self._slice(raw)
        gaps = np.flatnonzero(self.separators[raw])
        hashes, starts, begin = [], [], 0
        while begin < len(raw):
            at = np.searchsorted(gaps, begin + SLICE)
            at = at - 1 if at and gaps[at - 1] > begin else at
            end = int(gaps[at]) if at < len(gaps) else len(raw)
            h, s = self._slice(raw[begin:end])
            hashes.append(h)
            starts.append(s + begin)
            begin = max(end, begin + 1)
        return np.concatenate(hashes), np.concatenate(starts)

    def _slice(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word = ~self.separators[raw]
        edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        self._tables(len(raw))
        low = raw | (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(low * self.up[: len(raw)], out=total[1:])
        hashes = (total[ends] - total[starts]) * self.down[starts]
        return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of one text's words; fewer than n words make one, no word none."""
    k = len(words)
    if not k:
        return words
    width = min(n, k)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    out = np.zeros(k - width + 1, np.uint64)
    for i in range(width):
        out += words[i : k - width + 1 + i] * factors[i]
    return mix(out + np.uint64(width))


def text_words(hasher: Words, texts: Iterable[str | None]) -> list[np.ndarray]:
    """Word hashes of each text; null is empty.  Texts are hashed a slice of them at a time."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not part:
            return
        hashes, starts = hasher.of(b"\n".join(part))
        ends = np.cumsum([len(x) + 1 for x in part])
        out.extend(np.split(hashes, np.searchsorted(starts, ends[:-1])))
        part.clear()
        size = 0

    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if size + len(data) >= SLICE:
            flush()
        part.append(data)
        size += len(data) + 1
    flush()
    return out


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct n-gram hashes in ascending order."""
    return np.unique(ngram_hashes(words, n))
