"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with failure links. A link leaves a node with the longest pieces that the
characters read so far are known to begin with already taken off; the number of these pieces is
computed beforehand and kept beside the link. Counting follows one edge or link per step, so a word
takes time in proportion to its length, and no piece is ever built.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from opdiag.llm.shipping import released, ship
from opdiag.llm.texts import pieces, text_bytes

REMEMBERED = 400_000
REMEMBERED_BYTES = 48

COUNTED = "struct<n_words:bigint,n_tokens:bigint>"


class Automaton:
    """Counts the pieces of words; ``first`` may begin a word, ``later`` continue one.

    A word that no sequence of greedy longest pieces covers counts as one unknown token.
    """

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes]):
        #: Edge from node and byte, as node * 256 + byte.
        self.edges: dict[int, int] = {}
        self.link: list[int] = []
        self.popped: list[int] = []
        ends = set()
        self.start, self.middle = self._node(), self._node()
        for root, words in ((self.start, first), (self.middle, later)):
            for word in words:
                if word:
                    node = root
                    for byte in word:
                        key = (node << 8) | byte
                        if key not in self.edges:
                            self.edges[key] = self._node()
                        node = self.edges[key]
                    ends.add(node)
        self._connect(ends)
        self.known: dict[bytes, int] = {}

    def _node(self) -> int:
        self.link.append(-1)
        self.popped.append(0)
        return len(self.link) - 1

    def _connect(self, ends: set[int]) -> None:
        children: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.edges.items():
            children.setdefault(key >> 8, []).append((key & 255, node))
        waiting = deque((self.start, self.middle))
        while waiting:
            parent = waiting.popleft()
            for byte, node in children.get(parent, ()):
                waiting.append(node)
                if node in ends:
                    self.link[node], self.popped[node] = self.middle, 1
                    continue
                pieces_off, at = self.popped[parent], self.link[parent]
                while at >= 0 and (at << 8) | byte not in self.edges:
                    pieces_off += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node] = self.edges[(at << 8) | byte]
                    self.popped[node] = pieces_off

    def count(self, word: bytes) -> int:
        """Number of pieces of one word."""
        edges, link, popped = self.edges, self.link, self.popped
        node, total = self.start, 0
        for byte in word:
            following = edges.get((node << 8) | byte)
            while following is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1
                following = edges.get((node << 8) | byte)
            node = following
        while node != self.middle:
            if link[node] < 0:
                return 1
            total += popped[node]
            node = link[node]
        return total

    def _remember(self, word: bytes, mark: bytes) -> int:
        total = self.count(mark + word)
        if len(word) <= REMEMBERED_BYTES:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = total
        return total

    def text(self, text: bytes, mark: bytes) -> tuple[int, int]:
        """Words and pieces of a text, which is read in parts of bounded size."""
        words = total = 0
        known, remember = self.known, self._remember
        for part in pieces(text):
            found = part.split()
            words += len(found)
            total += sum([known.get(word) or remember(word, mark) for word in found])
        return words, total


def rank_file_pieces(content: bytes) -> tuple[list[bytes], list[bytes]]:
    """Pieces of a rank file: those with a leading space begin a word, the others continue one."""
    tokens = [base64.b64decode(line.split()[0]) for line in content.splitlines() if line.strip()]
    return [t for t in tokens if t[:1] == b" "], [t for t in tokens if t[:1] != b" "]


def word_piece_list(content: bytes) -> tuple[list[bytes], list[bytes]]:
    """Pieces of a vocabulary with one piece per line, continuing ones marked by ``##``."""
    lines = [line.rstrip(b"\r") for line in content.split(b"\n")]
    return [x for x in lines if not x.startswith(b"##")], [x[2:] for x in lines if x[:2] == b"##"]


@lru_cache(maxsize=2)
def _automaton(content: bytes, ranks: bool) -> Automaton:
    return Automaton(*(rank_file_pieces(content) if ranks else word_piece_list(content)))


def counter(spark: SparkSession, path: str, ranks: bool = True):
    """Function from a text column to a column of ``COUNTED``.

    ``path`` is read by the driver; its content, a fixed vocabulary, is broadcast. Words are runs
    of anything but ASCII white space. In a rank file the mark of a word's beginning is a space,
    in a word-piece list there is none. Null and empty texts have no words and no tokens.
    """
    with open(path, "rb") as file:
        shared = ship(spark).sparkContext.broadcast(file.read())
    mark = b" " if ranks else b""

    @F.arrow_udf(COUNTED)
    @released
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton(shared.value, ranks)
        for batch in batches:
            rows = [automaton.text(text, mark) for text in text_bytes(batch)]
            words, tokens = zip(*rows) if rows else ((), ())
            yield pa.StructArray.from_arrays(
                [pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["n_words", "n_tokens"],
            )

    return count
