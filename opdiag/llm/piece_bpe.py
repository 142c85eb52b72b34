"""SentencePiece encoding and decoding with a BPE model, in vectorised merge rounds.

Texts of a batch lie in one flat array of symbols. They are cut into words wherever no piece of the
vocabulary holds the two neighbouring characters, so no merge can cross a cut and every distinct
word of the batch is merged once. A round looks at all words at once: each word's minimum pair rank
(a segmented minimum), its leftmost non-overlapping pairs of that rank merged together, and the
arrays compacted; words without a pair leave. Rounds end when no word is left.

Merging all pairs of one rank at once equals merging them one by one, from the left, unless a merge
makes a new pair of the same or a lower rank. ``_unsafe_ranks`` finds the ranks where the vocabulary
allows that (pieces of equal score, mostly runs of spaces). A word that has several pairs of
such a rank, and a word of more than ``LONG`` symbols, is finished one merge at a time with a queue.

Models with a dummy prefix, escaped white space, byte fallback and no other normalisation are
supported, others raise ``ValueError``. A null text counts as empty: no tokens, digests of nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from opdiag.llm.shipping import released, ship
from opdiag.llm.texts import mix, powers

DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"
ENCODED = "struct<ids:array<int>,n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"
SPACE = "▁"
NONE = np.iinfo(np.int64).max
CHARS = 1 << 19  # characters that are merged together; a longer text comes in several parts
LONG = 1 << 14
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # types in model files

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _read_model(content: bytes):
    """Pieces with score and type, from the bytes of a model file."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(content)
    rules, trained = model.normalizer_spec, model.trainer_spec
    if (
        trained.model_type != trained.BPE or not trained.byte_fallback
        or rules.precompiled_charsmap or not rules.add_dummy_prefix
        or rules.remove_extra_whitespaces or not rules.escape_whitespaces
        or trained.treat_whitespace_as_suffix
        or any(piece.type in (USER_DEFINED, UNUSED) for piece in model.pieces)
    ):
        raise ValueError("only BPE models with a dummy prefix and byte fallback are supported")
    return [(piece.piece, piece.score, piece.type) for piece in model.pieces]


class Vocabulary:
    """Lookup tables of one model.

    A symbol is the id of a piece, or ``size`` plus the code point of a character without one.
    """

    def __init__(self, content: bytes):
        pieces = _read_model(content)
        self.size = len(pieces)
        ids = {piece: at for at, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        scores = np.array([pieces[at][1] for at in ids.values()])
        dense = np.unique(-scores, return_inverse=True)[1]
        ranks = dict(zip(ids, dense.tolist()))
        self.byte_ids = [0] * 256
        self.shown: list[bytes] = []  # what a piece decodes to
        for at, (piece, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_ids[int(piece[1:-1], 16)] = at
                self.shown.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.shown.append(b"" if kind == CONTROL else piece.replace(SPACE, " ").encode())
        self.decimal = [str(at).encode() for at in range(self.size)]
        chars = sorted({char for piece in ids for char in piece})
        #: Number of a character among those of the vocabulary, 0 for any other; a space is SPACE.
        self.char_class = np.zeros(0x110000, np.uint16)
        self.char_class[[ord(char) for char in chars]] = np.arange(1, len(chars) + 1)
        self.char_class[ord(" ")] = self.char_class[ord(SPACE)]
        #: Symbol of each character class that is a piece itself.
        self.class_symbol = np.array([-1] + [ids.get(char, -1) for char in chars], np.int64)
        self.adjacent = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for piece in ids:
            classes = self.char_class[[ord(char) for char in piece]]
            self.adjacent[classes[:-1], classes[1:]] = True
        self.symbols = self.size + 0x110000
        pairs = {}
        for piece, at in ids.items():
            for cut in range(1, len(piece)):
                left, right = self._symbol(ids, piece[:cut]), self._symbol(ids, piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.symbols + right] = (ranks[piece], at)
        self.pair_keys = np.array(sorted(pairs), np.int64)
        found = np.array([pairs[key] for key in self.pair_keys.tolist()], np.int64).reshape(-1, 2)
        self.pair_ranks, self.pair_ids = found[:, 0].copy(), found[:, 1].copy()
        self.pairs = pairs
        self.unsafe = self._unsafe_ranks(ids, ranks)

    def _symbol(self, ids: dict[str, int], piece: str) -> int | None:
        at = ids.get(piece)
        return self.size + ord(piece) if at is None and len(piece) == 1 else at

    @staticmethod
    def _unsafe_ranks(ids: dict[str, int], ranks: dict[str, int]) -> np.ndarray:
        """Ranks of which two merges in one word may depend on each other.

        These are ranks of several pieces, and ranks of a piece ``ab`` which with a neighbour makes
        a piece of the same or a lower rank, although the neighbour did not merge with the nearer
        half of ``ab`` before.
        """
        count = np.bincount(list(ranks.values()), minlength=1)
        unsafe = count > 1
        last = len(count)
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                for near, middle, left in (
                    (piece[:cut], piece[cut:], True), (piece[cut:], piece[:cut], False)
                ):
                    own = ranks.get(middle, -1)
                    if len(middle) < 2 or own < rank or (len(near) > 1 and near not in ids):
                        continue
                    for at in range(1, len(middle)):
                        a, b = middle[:at], middle[at:]
                        if any(len(half) > 1 and half not in ids for half in (a, b)):
                            continue
                        if ranks.get(near + a if left else b + near, last) >= own:
                            unsafe[own] = True
        return unsafe

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols; the rank ``NONE`` where there is no such piece."""
        if not len(self.pair_keys):
            return np.full(len(left), NONE), np.zeros(len(left), np.int64)
        keys = left * self.symbols + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        found = self.pair_keys[at] == keys
        return np.where(found, self.pair_ranks[at], NONE), self.pair_ids[at]

    def one_by_one(self, symbols: list[int]) -> list[int]:
        """Merges the pair of the lowest rank, the leftmost of several, until none is left."""
        pairs, base, count = self.pairs, self.symbols, len(symbols)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        queue = []
        for at in range(count - 1):
            found = pairs.get(symbols[at] * base + symbols[at + 1])
            if found:
                queue.append((found[0], at, symbols[at], symbols[at + 1], found[1]))
        heapify(queue)
        while queue:
            _, at, left, right, merged = heappop(queue)
            gone = after[at]
            if symbols[at] != left or gone >= count or symbols[gone] != right:
                continue
            symbols[at], symbols[gone] = merged, -1
            follows = after[at] = after[gone]
            if follows < count:
                before[follows] = at
                found = pairs.get(merged * base + symbols[follows])
                if found:
                    heappush(queue, (found[0], at, merged, symbols[follows], found[1]))
            ahead = before[at]
            if ahead >= 0:
                found = pairs.get(symbols[ahead] * base + merged)
                if found:
                    heappush(queue, (found[0], ahead, symbols[ahead], merged, found[1]))
        return [symbol for symbol in symbols if symbol >= 0]

    def merged(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words after all merges, word by word, and how many each word has."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def leave(which: np.ndarray) -> None:
            done.append((word[which], symbols[which]))

        def alone(which: np.ndarray) -> None:
            """Finishes some words one merge at a time; ``which`` marks their symbols."""
            owner, own = word[which], symbols[which]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            for start, stop in zip(starts, np.append(starts[1:], len(owner))):
                out = self.one_by_one(own[start:stop].tolist())
                done.append((np.full(len(out), owner[start]), np.array(out, np.int64)))

        long = np.repeat(lengths > LONG, lengths)
        if long.any():
            alone(long)
            symbols, word = symbols[~long], word[~long]
        rank = np.full(len(symbols), NONE)
        piece = np.zeros(len(symbols), np.int64)
        fresh = np.arange(len(symbols))  # symbols whose pair with the next one is not looked up yet
        while len(symbols):
            within = fresh[fresh < len(symbols) - 1]
            rank[fresh] = NONE
            within = within[word[within] == word[within + 1]]
            rank[within], piece[within] = self.look_up(symbols[within], symbols[within + 1])
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, starts)
            size = np.diff(starts, append=len(word))
            ended = np.repeat(least == NONE, size)
            chosen = np.flatnonzero((rank == np.repeat(least, size)) & ~ended)
            # of pairs that overlap, every other one from the left
            run = np.diff(chosen, prepend=-2) != 1
            nth = np.arange(len(chosen))
            chosen = chosen[(nth - np.maximum.accumulate(np.where(run, nth, 0))) % 2 == 0]
            of = np.searchsorted(starts, chosen, side="right") - 1
            several = np.bincount(of, minlength=len(starts)) > 1
            risky = several & (least != NONE)
            risky[risky] = self.unsafe[least[risky]]
            if risky.any():
                chosen = chosen[~risky[of]]
                risky = np.repeat(risky, size)
                alone(risky)
                leave(ended)
                ended |= risky
            elif ended.any():
                leave(ended)
            symbols[chosen] = piece[chosen]
            keep = ~ended
            keep[chosen + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[chosen] = True
            symbols, word, changed = symbols[keep], word[keep], changed[keep]
            rank, piece = rank[keep], piece[keep]
            changed[:-1] |= changed[1:].copy()
            fresh = np.flatnonzero(changed)
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
        word = np.concatenate([own for own, _ in done])
        order = np.argsort(word, kind="stable")
        return (
            np.concatenate([out for _, out in done])[order],
            np.bincount(word, minlength=len(lengths)),
        )

    def _spelled(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids for symbols: characters without a piece become the ids of their bytes."""
        unknown = symbols >= self.size
        if not unknown.any():
            return symbols.astype(np.int32), counts
        codes, at = np.unique(symbols[unknown] - self.size, return_inverse=True)
        spelled = [[self.byte_ids[byte] for byte in chr(code).encode()] for code in codes.tolist()]
        width = np.ones(len(symbols), np.int64)
        width[unknown] = np.array([len(ids) for ids in spelled])[at]
        ids = np.repeat(symbols, width)
        first = np.concatenate(([0], np.cumsum(width)[:-1]))
        flat = np.concatenate([np.array(ids_, np.int64) for ids_ in spelled])
        begin = np.concatenate(([0], np.cumsum([len(ids_) for ids_ in spelled])[:-1]))
        place = np.repeat(unknown, width)
        offset = np.arange(len(ids)) - np.repeat(first, width)
        source = np.zeros(len(symbols), np.int64)
        source[unknown] = begin[at]
        ids[place] = flat[(np.repeat(source, width) + offset)[place]]
        owner = np.repeat(np.repeat(np.arange(len(counts)), counts), width)
        return ids.astype(np.int32), np.bincount(owner, minlength=len(counts))

    def _classes(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return codes, self.char_class[codes]

    def encode_parts(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of texts, or of parts of texts, that have their dummy prefix already."""
        codes, classes = self._classes("".join(parts))
        sizes = np.array([len(part) for part in parts], np.int64)
        if not len(codes):
            return [np.zeros(0, np.int32) for _ in parts]
        cut = np.empty(len(codes), bool)
        cut[0] = True
        cut[1:] = ~self.adjacent[classes[:-1], classes[1:]]
        begins = np.cumsum(sizes) - sizes
        cut[begins[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        lengths = np.diff(starts, append=len(codes))
        symbols = self.class_symbol[classes]
        symbols = np.where(symbols < 0, codes.astype(np.int64) + self.size, symbols)
        first, same = self._distinct(symbols, starts, lengths)
        place = np.repeat(starts[first] - np.cumsum(lengths[first]) + lengths[first], lengths[first])
        ids, counts = self._spelled(
            *self.merged(symbols[place + np.arange(len(place))], lengths[first])
        )
        # every place of a word takes the ids of its first one
        begin = (np.cumsum(counts) - counts)[same]
        width = counts[same]
        at = np.repeat(begin - np.cumsum(width) + width, width)
        flat = ids[at + np.arange(len(at))]
        of = np.searchsorted(begins, starts, side="right") - 1
        total = np.bincount(of, weights=width, minlength=len(parts)).astype(np.int64)
        return np.split(flat, np.cumsum(total)[:-1])

    @staticmethod
    def _distinct(
        symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the first word of each kind, and the kind of every word.

        Words are grouped by a hash and then compared; should two different words agree in it, all
        words count as distinct.
        """
        count = len(symbols)
        sums = np.zeros(count + 1, np.uint64)
        np.cumsum((symbols + 1).astype(np.uint64) * powers(_BASE, count), out=sums[1:])
        hashes = mix((sums[starts + lengths] - sums[starts]) * powers(_INVERSE, count)[starts])
        hashes += mix(lengths.astype(np.uint64))
        _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
        model = first[same]
        if (lengths[model] == lengths).all():
            shift = np.repeat(starts[model] - starts, lengths)
            if (symbols[np.arange(count) + shift] == symbols).all():
                return first, same
        every = np.arange(len(starts))
        return every, every

    def parts(self, text: str) -> Iterator[str]:
        """A text with its dummy prefix in parts of about ``CHARS`` characters, cut between words."""
        if not text:
            return
        text, start = SPACE + text, 0
        while start < len(text):
            size = CHARS
            while start + size < len(text):
                _, classes = self._classes(text[start : start + size])
                cuts = np.flatnonzero(~self.adjacent[classes[:-1], classes[1:]])
                if len(cuts):
                    size = int(cuts[-1]) + 1
                    break
                size *= 2
            yield text[start : start + size]
            start += size

    def encode_all(self, texts: list[str | None]) -> Iterator[Iterator[np.ndarray]]:
        """For every text the arrays of its ids, one after the other."""
        waiting: list[str] = []
        room = 0
        for text in texts:
            text = text or ""
            if len(text) < CHARS:
                waiting.append(SPACE + text if text else "")
                room += len(text)
            if len(text) >= CHARS or room >= CHARS:
                yield from ([ids] for ids in self.encode_parts(waiting))
                waiting, room = [], 0
            if len(text) >= CHARS:
                yield (self.encode_parts([part])[0] for part in self.parts(text))
        if waiting:
            yield from ([ids] for ids in self.encode_parts(waiting))

    def encode(self, text: str) -> list[int]:
        return [at for ids in next(iter(self.encode_all([text]))) for at in ids.tolist()]

    def decode(self, ids: list[int]) -> bytes:
        """The text of ids that ``encode`` made, without its dummy prefix, in UTF-8."""
        shown = b"".join(map(self.shown.__getitem__, ids))
        return shown[1:] if shown.startswith(b" ") else shown

    def digest(self, arrays: Iterator[np.ndarray], kept: list[np.ndarray] | None):
        """Token count, SHA-256 of the ids in decimal, SHA-256 of what they decode to."""
        count, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        decimal, shown = self.decimal.__getitem__, self.shown.__getitem__
        for ids in arrays:
            if not len(ids):
                continue
            numbers = ids.tolist()
            text = b"".join(map(shown, numbers))
            of_text.update(text[1:] if not count and text.startswith(b" ") else text)
            of_ids.update((b"," if count else b"") + b",".join(map(decimal, numbers)))
            count += len(numbers)
            if kept is not None:
                kept.append(ids)
        return count, of_ids.hexdigest(), of_text.hexdigest()


@lru_cache(maxsize=1)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoder(spark: SparkSession, path: str, with_ids: bool = False):
    """Function from a text column to a column of ``DIGESTS``, or ``ENCODED`` with the ids.

    ``path`` is a model file that the driver reads; its content, a fixed vocabulary, is broadcast.
    """
    shared = ship(spark).sparkContext.broadcast(_content(path))

    @F.arrow_udf(ENCODED if with_ids else DIGESTS)
    @released
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _vocabulary(shared.value)
        for batch in batches:
            kept = [] if with_ids else None
            texts = (text.as_py() for text in batch)
            rows = [vocabulary.digest(ids, kept) for ids in vocabulary.encode_all(texts)]
            counts, ids, decoded = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                       pa.array(decoded, pa.string())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.int32), *kept])
                columns.insert(0, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
                names.insert(0, "ids")
            yield pa.StructArray.from_arrays(columns, names)

    return encode


def decoder(spark: SparkSession, path: str):
    """Function from a column of ids back to the text; null ids give an empty text."""
    shared = ship(spark).sparkContext.broadcast(_content(path))

    @F.arrow_udf("string")
    @released
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _vocabulary(shared.value)
        for batch in batches:
            texts = [vocabulary.decode(ids.as_py() or []).decode() for ids in batch]
            yield pa.array(texts, pa.string())

    return decode
