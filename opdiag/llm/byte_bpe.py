"""Byte-level BPE encoding and decoding with a rank file.

A text is split by a pattern; each match is merged on its own. The pairs of a match wait in a rank
queue: one bucket per merge rank holds positions of the linked list of symbols, and a two-level
bitmap over the ranks finds the lowest bucket in use by find-first-set. Entries whose pair has
changed meanwhile are skipped when they come up. Positions of one rank come up from the left, as a
heap, so a merge takes constant time but for runs of equal pairs, where it takes the logarithm of
their number: a match of millions of bytes takes time about in proportion to its length. Short
matches are remembered in a table of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from opdiag.llm.shipping import released, ship

REMEMBERED = 400_000
REMEMBERED_CHARS = 48
AT_ONCE = 1 << 16
WORD = 8  # ranks are split into a word number and WORD bits within it
MASK = (1 << WORD) - 1

DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"
ENCODED = "struct<ids:array<int>,n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


LATIN = 0x180  # texts below this code point take the standard library's pattern engine
OTHER = re.compile(f"[^\\x00-{chr(LATIN - 1)}]")


def _latin_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern with its Unicode classes spelled out below ``LATIN``.

    None if a class other than letters, numbers and white space is used.
    """
    spelled = pattern
    white = "".join(re.escape(chr(at)) for at in range(LATIN) if regex.match(r"\s", chr(at)))
    spelled = re.sub(r"\[\^\\s", lambda _: f"[^{white}", spelled)
    for name in ("L", "N"):
        chars = [at for at in range(LATIN) if regex.match(rf"\p{{{name}}}", chr(at))]
        inner = "".join(re.escape(chr(at)) for at in chars)
        spelled = re.sub(
            rf"(\[[^\]]*)\\p\{{{name}\}}", lambda found: found[1] + inner, spelled  # noqa: B023
        )
        spelled = spelled.replace(rf"\p{{{name}}}", f"[{inner}]")
    spelled = spelled.replace(r"\s", f"[{white}]").replace(r"\S", f"[^{white}]")
    return None if re.search(r"\\[pPwWdDbB]", spelled) else re.compile(spelled)


class Vocabulary:
    """Token bytes and merge ranks of one rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        lines = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ids = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ids.items()}
        self.pattern = regex.compile(pattern)
        self.latin = _latin_pattern(pattern)
        self.size = max(self.tokens, default=0) + 1
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, int] = {}
        self.byte_ids = [self.ids.get(bytes([byte]), -1) for byte in range(256)]
        self.byte_pairs = [
            [self.ids.get(bytes([left, right]), -1) for right in range(256)] for left in range(256)
        ]
        #: Lower level of the bitmap over ranks; all zero between two calls of ``merge``.
        self.used = [0] * ((self.size >> WORD) + 1)

    def _pair_rank(self, key: int, left: int, right: int) -> int:
        rank = self.ids.get(self.tokens[left] + self.tokens[right], -1)
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        self.pairs[key] = rank
        return rank

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pattern match.

        ``buckets`` has the positions that wait under a rank, as a heap; ``waiting`` the rank that
        counts for a position, so that an entry under another rank is stale. ``used`` has a bit per
        rank with a bucket, ``top`` a bit per word of ``used`` that is not zero.
        """
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        count = len(word)
        byte_ids, byte_pairs, used = self.byte_ids, self.byte_pairs, self.used
        pairs, pair_rank, size = self.pairs, self._pair_rank, self.size
        symbols = [byte_ids[byte] for byte in word]
        waiting = [byte_pairs[left][right] for left, right in zip(word, word[1:])]
        waiting.append(-1)
        after = list(range(1, count + 1))
        before = list(range(-1, count - 1))
        buckets: dict[int, list[int]] = {}
        top = 0
        for at, rank in enumerate(waiting):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(at)
                else:
                    buckets[rank] = [at]
                    high = rank >> WORD
                    used[high] |= 1 << (rank & MASK)
                    top |= 1 << high
        while top:
            high = (top & -top).bit_length() - 1
            bits = used[high]
            lowest = bits & -bits
            rank = (high << WORD) + lowest.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                at = heappop(bucket)
            else:
                at = bucket[0]
                del buckets[rank]
                bits ^= lowest
                used[high] = bits
                if not bits:
                    top &= top - 1
            if waiting[at] != rank:
                continue
            gone = after[at]
            symbols[at] = rank
            symbols[gone] = waiting[gone] = -1
            follows = after[at] = after[gone]
            if follows < count:
                before[follows] = at
                key = rank * size + symbols[follows]
                new = pairs.get(key)
                if new is None:
                    new = pair_rank(key, rank, symbols[follows])
                waiting[at] = new
                if new >= 0:
                    if new in buckets:
                        heappush(buckets[new], at)
                    else:
                        buckets[new] = [at]
                        high = new >> WORD
                        used[high] |= 1 << (new & MASK)
                        top |= 1 << high
            else:
                waiting[at] = -1
            left = before[at]
            if left >= 0:
                key = symbols[left] * size + rank
                new = pairs.get(key)
                if new is None:
                    new = pair_rank(key, symbols[left], rank)
                waiting[left] = new
                if new >= 0:
                    if new in buckets:
                        heappush(buckets[new], left)
                    else:
                        buckets[new] = [left]
                        high = new >> WORD
                        used[high] |= 1 << (new & MASK)
                        top |= 1 << high
        return [symbol for symbol in symbols if symbol >= 0]

    def _packed(self, word: str) -> bytes:
        ids = self.merge(word.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = packed
        return packed

    def encode_packed(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, in parts of bounded size."""
        known, packed = self.known, self._packed
        pattern = self.pattern if self.latin is None or OTHER.search(text) else self.latin
        if len(text) <= AT_ONCE:
            words = pattern.findall(text)
            yield b"".join([known.get(word) or packed(word) for word in words])
            return
        matches = (match.group() for match in pattern.finditer(text))
        while words := list(islice(matches, AT_ONCE)):
            yield b"".join([known.get(word) or packed(word) for word in words])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.encode_packed(text)), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest(self, text: str | None, kept: list[bytes] | None = None) -> tuple[int, str, str]:
        """Token count, SHA-256 of the packed ids, SHA-256 of what the ids decode to.

        The packed ids are added to ``kept``, if given.
        """
        count, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        for part in self.encode_packed(text or ""):
            of_ids.update(part)
            count += len(part) // 4
            of_text.update(self.decode(np.frombuffer(part, "<u4").tolist()))
            if kept is not None:
                kept.append(part)
        return count, of_ids.hexdigest(), of_text.hexdigest()


@lru_cache(maxsize=2)
def _vocabulary(rank_file: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(rank_file, pattern)


def encoder(spark: SparkSession, path: str, pattern: str, with_ids: bool = False):
    """Function from a text column to a column of ``DIGESTS``, or ``ENCODED`` with the ids.

    ``path`` is a rank file that the driver reads; its content, a fixed vocabulary, is broadcast.
    A null text is encoded like an empty one: no tokens, digests of no bytes.
    """
    with open(path, "rb") as file:
        shared = ship(spark).sparkContext.broadcast(file.read())

    @F.arrow_udf(ENCODED if with_ids else DIGESTS)
    @released
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _vocabulary(shared.value, pattern)
        for batch in batches:
            kept = [] if with_ids else None
            rows = [vocabulary.digest(text.as_py(), kept) for text in batch]
            counts, ids, decoded = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                       pa.array(decoded, pa.string())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                values = np.frombuffer(b"".join(kept), "<i4")
                columns.insert(0, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
                names.insert(0, "ids")
            yield pa.StructArray.from_arrays(columns, names)

    return encode


def decoded(spark: SparkSession, path: str, pattern: str):
    """Function from a column of ids back to the bytes of the text; null ids give no bytes."""
    with open(path, "rb") as file:
        shared = ship(spark).sparkContext.broadcast(file.read())

    @F.arrow_udf("binary")
    @released
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _vocabulary(shared.value, pattern)
        for batch in batches:
            yield pa.array([vocabulary.decode(ids.as_py() or []) for ids in batch], pa.binary())

    return decode
