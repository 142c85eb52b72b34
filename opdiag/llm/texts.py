"""Vectorised helpers on Arrow text columns, run inside Spark's tasks.

Three word forms are used. ``blank_words`` are runs of anything but ASCII white space. ``plain
words`` are runs of ASCII letters, digits and non-ASCII characters, ASCII letters in lower case;
shingles are made of these. Both work on UTF-8 bytes and never look at a whole batch at once, so a
task holds a few arrays over ``PIECE`` bytes besides its batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
SHINGLE_WORDS = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _plain_table() -> np.ndarray:
    """Byte to word byte: ASCII letters in lower case; 0 where a word ends."""
    table = np.zeros(256, np.uint8)
    for byte in range(256):
        char = chr(byte)
        if byte >= 128:
            table[byte] = byte
        elif char.isalnum():
            table[byte] = ord(char.lower())
    return table


PLAIN = _plain_table()
#: Non-zero outside of ASCII white space.
BLANK = np.maximum(np.arange(256), 1).astype(np.uint8)
BLANK[[9, 10, 11, 12, 13, 32]] = 0


def powers(base: np.uint64, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), modulo 2 ** 64."""
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values = values * np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and its offsets; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each text as bytes, one at a time; nulls are empty."""
    raw, offsets = utf8(column)
    view = memoryview(raw)
    for at in range(len(offsets) - 1):
        yield bytes(view[offsets[at] : offsets[at + 1]])


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Cuts a text after white space into pieces of about ``size`` bytes; words stay whole."""
    if len(text) <= size:
        yield text
        return
    start = 0
    while start < len(text):
        end = min(start + size, len(text))
        while end < len(text) and BLANK[text[end]]:
            end += 1
        yield text[start:end]
        start = end


_POWERS: dict[str, np.ndarray] = {}


def _power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < count:
        room = max(count, PIECE + 4096)
        tables = powers(_BASE, room), powers(_BASE_INVERSE, room)
        if room > 4 * PIECE:  # a single huge word: not kept
            return tables
        _POWERS["up"], _POWERS["down"] = tables
    return _POWERS["up"], _POWERS["down"]


class Words:
    """Words of consecutive texts in one buffer.

    ``hashes``, ``owner`` (number of the text), ``begin`` and ``end`` (places in the buffer) have
    an entry per word. ``table`` maps a byte to its word byte, or to 0 outside of words.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.raw, self.low = raw, int(offsets[0])
        code = table[raw[self.low : int(offsets[-1])]]
        inside = code != 0
        starts_of = offsets[:-1] - self.low
        first, last = np.empty(len(code), bool), np.empty(len(code), bool)
        if len(code):
            first[0] = last[-1] = True
            first[1:], last[:-1] = ~inside[:-1], ~inside[1:]
            first[starts_of[starts_of < len(code)]] = True
            last[starts_of[(starts_of > 0) & (starts_of < len(code))] - 1] = True
        begin = np.flatnonzero(first & inside)
        end = np.flatnonzero(last & inside) + 1
        up, self._down = _power_tables(len(code))
        self._sums = np.empty(len(code) + 1, np.uint64)
        self._sums[0] = 0
        np.cumsum((code.astype(np.uint64) + np.uint64(1)) * up[: len(code)], out=self._sums[1:])
        self.begin, self.end = begin + self.low, end + self.low
        self.owner = np.searchsorted(starts_of, begin, side="right") - 1
        self.hashes = self.heads(None)

    def heads(self, length: int | None) -> np.ndarray:
        """Hashes of the first ``length`` bytes of every word, or of all of them."""
        begin, end = self.begin - self.low, self.end - self.low
        if length is not None:
            end = np.minimum(end, begin + length)
        total = (self._sums[end] - self._sums[begin]) * self._down[begin]
        return mix(total + (end - begin).astype(np.uint64))


def text_words(column: pa.Array, table: np.ndarray) -> Iterator[tuple[int, Words]]:
    """Words of a text column in runs of texts, with the number of the first text of a run.

    A text over ``PIECE`` bytes comes in several runs, cut between words.
    """
    raw, offsets = utf8(column)
    for start, stop in text_groups(offsets):
        low, high = int(offsets[start]), int(offsets[stop])
        if stop - start > 1 or high - low <= PIECE:
            yield start, Words(raw, offsets[start : stop + 1], table)
            continue
        while low < high:
            end = min(low + PIECE, high)
            while end < high and table[raw[end]]:
                end += 1
            yield start, Words(raw, np.array([low, end]), table)
            low = end


def text_groups(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes; a longer text is a run of its own."""
    start, count = 0, len(offsets) - 1
    while start < count:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), count)
        yield start, stop
        start = stop


def shingle_hashes(
    words: np.ndarray, owner: np.ndarray, size: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of one text, and their text numbers."""
    if len(words) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(words) - size + 1
    total = words[:count].copy()
    for at in range(1, size):
        total *= _STEP
        total += words[at : at + count]
    whole = owner[:count] == owner[size - 1 :]
    return mix(total[whole]), owner[:count][whole]


def text_windows(
    column: pa.Array, sizes: Sequence[int]
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: number of the first one, hashes of windows of some sizes, their text.

    Four arrays follow the number: hash, text within the run and size of each window, and the words
    of each text.
    """
    raw, offsets = utf8(column)
    for start, stop in text_groups(offsets):
        words, owner, totals = _words_of(column, raw, offsets, start, stop)
        found = [shingle_hashes(words, owner, size) for size in sizes]
        size_of = np.repeat(np.array(sizes, np.int32), [len(hashes) for hashes, _ in found])
        yield (start, np.concatenate([hashes for hashes, _ in found]),
               np.concatenate([at for _, at in found]), size_of, totals)


def _words_of(
    column: pa.Array, raw: np.ndarray, offsets: np.ndarray, start: int, stop: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a run of texts, their text within the run, and words per text."""
    count = stop - start
    if count == 1 and offsets[stop] - offsets[start] > PIECE:
        parts = text_words(column.slice(start, 1), PLAIN)
        words = np.concatenate([part.hashes for _, part in parts])
        owner = np.zeros(len(words), np.int64)
    else:
        found = Words(raw, offsets[start : stop + 1], PLAIN)
        words, owner = found.hashes, found.owner
    return words, owner, np.bincount(owner, minlength=count)


def text_shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: number of the first one, shingle hashes, their text, words per text.

    Texts are numbered within their run. Hashes have 64 bits, so that two different shingles of a
    comparison agree with a probability of 2 ** -64. A text of one to four words has one shingle of
    all its words, a text without words none.
    """
    raw, offsets = utf8(column)
    for start, stop in text_groups(offsets):
        words, owner, totals = _words_of(column, raw, offsets, start, stop)
        hashes, at = shingle_hashes(words, owner)
        few = np.flatnonzero((totals > 0) & (totals < SHINGLE_WORDS))
        if len(few):
            begins = np.concatenate(([0], np.cumsum(totals)))
            short = []
            for text in few:
                total = np.uint64(totals[text])
                for word in words[begins[text] : begins[text + 1]]:
                    total = np.uint64((int(total) * int(_STEP) + int(word)) % (1 << 64))
                short.append(total)
            hashes = np.concatenate((hashes, mix(np.array(short, np.uint64))))
            at = np.concatenate((at, few))
            order = np.argsort(at, kind="stable")
            hashes, at = hashes[order], at[order]
        yield start, hashes, at, totals


def distinct_by_text(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs, sorted."""
    order = np.lexsort((hashes, at))
    hashes, at = hashes[order], at[order]
    if not len(hashes):
        return hashes, at
    fresh = np.empty(len(hashes), bool)
    fresh[0] = True
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (at[1:] != at[:-1])
    return hashes[fresh], at[fresh]
