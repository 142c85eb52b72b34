"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over windows of fixed length, each keeps its
largest answer in a window, and a softmax layer names the language. The network is trained by numpy
on windows of a bounded sample of labelled texts. A text is named by the mean log-probability over
all of its windows; windows are scored in batches, so memory does not depend on a text's length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opdiag.llm.samples import Adam, bounded_sample
from opdiag.llm.shipping import released, ship
from opdiag.llm.texts import utf8

WINDOW = 256
EMBEDDING = 8
WIDTHS = (2, 3, 4)
FILTERS = 16
BATCH = 256
#: Labelled texts per language on average, and windows of each that are drawn by their hash.
SAMPLE_PER_LANGUAGE = 1000
WINDOWS_PER_TEXT = 3
EPOCHS = 4
UNDETERMINED = "und"

NAMED = "struct<lang_pred:string,score:double>"


@dataclass
class Network:
    """Embedding, a filter bank and bias per width, and the softmax layer."""

    languages: tuple[str, ...]
    parameters: list[np.ndarray]

    @classmethod
    def fresh(cls, languages: tuple[str, ...], seed: int = 11) -> Network:
        draw = np.random.default_rng(seed)
        parameters = [draw.normal(0, 0.5, (256, EMBEDDING))]
        for width in WIDTHS:
            parameters.append(draw.normal(0, 1 / np.sqrt(width * EMBEDDING), (width * EMBEDDING, FILTERS)))
            parameters.append(np.zeros(FILTERS))
        parameters.append(draw.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))))
        parameters.append(np.zeros(len(languages)))
        return cls(languages, [x.astype(np.float32) for x in parameters])

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest answer of every filter in every window, and where it is."""
        embedded = self.parameters[0][windows]
        values, places = [], []
        for at, width in enumerate(WIDTHS):
            count = windows.shape[1] - width + 1
            patches = np.concatenate([embedded[:, step : step + count] for step in range(width)], axis=2)
            answers = patches @ self.parameters[1 + 2 * at]
            place = answers.argmax(axis=1)
            best = np.take_along_axis(answers, place[:, None, :], axis=1)[:, 0]
            values.append(best + self.parameters[2 + 2 * at])
            places.append(place)
        return np.concatenate(values, axis=1), places

    def largest(self, windows: np.ndarray) -> np.ndarray:
        """Like ``pooled`` without the places."""
        embedded = self.parameters[0][windows]
        values = []
        for at, width in enumerate(WIDTHS):
            count = windows.shape[1] - width + 1
            patches = np.concatenate([embedded[:, step : step + count] for step in range(width)], axis=2)
            answers = patches @ self.parameters[1 + 2 * at]
            values.append(answers.max(axis=1) + self.parameters[2 + 2 * at])
        return np.concatenate(values, axis=1)

    def log_probabilities(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled, 0) @ self.parameters[-2] + self.parameters[-1]
        logits = logits - logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy; only the pooled places pass it back."""
        pooled, places = self.pooled(windows)
        error = np.exp(self.log_probabilities(pooled))
        error[np.arange(len(target)), target] -= 1
        error /= len(target)
        active = np.maximum(pooled, 0)
        back = (error @ self.parameters[-2].T) * (pooled > 0)
        found = [np.zeros_like(self.parameters[0])]
        for at, width in enumerate(WIDTHS):
            of_filter = back[:, at * FILTERS : (at + 1) * FILTERS]
            bytes_at = np.stack(
                [np.take_along_axis(windows, places[at] + step, axis=1) for step in range(width)], axis=2
            )
            patches = self.parameters[0][bytes_at].reshape(len(windows), FILTERS, width * EMBEDDING)
            bank = self.parameters[1 + 2 * at]
            found += [np.einsum("bfk,bf->kf", patches, of_filter), of_filter.sum(axis=0)]
            of_patches = (of_filter[:, :, None] * bank.T[None]).reshape(-1, EMBEDDING)
            np.add.at(found[0], bytes_at.reshape(-1), of_patches)
        found[0][0] = 0
        return [*found, active.T @ error, error.sum(axis=0)]


def window_rows(raw: np.ndarray, low: int, high: int) -> np.ndarray:
    """Windows of one text, the last one filled up with zeros."""
    count = max(1, -(-(high - low) // WINDOW))
    out = np.zeros(count * WINDOW, np.uint8)
    out[: high - low] = raw[low:high]
    return out.reshape(count, WINDOW)


def hash_of(place: int, window: np.ndarray) -> int:
    """Number by which windows of a text are drawn, wherever in the text they stand."""
    return zlib.crc32(window.tobytes(), place)


def fit(windows: np.ndarray, target: np.ndarray, languages: tuple[str, ...]) -> Network:
    """Minimises the cross-entropy in shuffled batches."""
    network = Network.fresh(languages)
    adam, draw = Adam(network.parameters, 0.01), np.random.default_rng(3)
    for _ in range(EPOCHS if len(languages) > 1 else 0):
        order = draw.permutation(len(windows))
        for start in range(0, len(order), 64):
            part = order[start : start + 64]
            adam.step(network.gradients(windows[part], target[part]))
    return network


def train(
    docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE,
) -> Network:
    """Trains on a bounded sample of the rows that ``learnable`` holds for.

    Rows with a null language or a null or empty text are not used. Without labelled rows the
    network knows no language and names every text undetermined.
    """
    spark = ship(docs.sparkSession)
    text, lang = F.col(text_col), F.col(lang_col)
    known = docs.filter(learnable & lang.isNotNull() & (F.length(text) > 0)).select(
        lang.alias("lang"), text.alias("text"), F.col(id_col).alias("id")
    )
    sample = bounded_sample(known, "lang", per_language, "id", "text").select("lang", "text")

    @released
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            langs, found = [], []
            for at, name in enumerate(batch.column(0).to_pylist()):
                rows = window_rows(raw, int(offsets[at]), int(offsets[at + 1]))
                drawn = [hash_of(at, row) for at, row in enumerate(rows)]
                picked = np.argsort(drawn, kind="stable")[:WINDOWS_PER_TEXT]
                langs += [name] * len(picked)
                found += [rows[one].tobytes() for one in picked]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "bytes"]
            )

    table = sample.mapInArrow(cut, "lang string, bytes binary").orderBy("bytes", "lang").toArrow()
    names = table.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    windows = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    target = np.array([languages.index(name) for name in names], np.int64)
    return fit(windows.reshape(-1, WINDOW), target, languages)


def _text_scores(network: Network, column: pa.Array) -> np.ndarray:
    """Mean log-probability and mean probability of each language, per text."""
    raw, offsets = utf8(column)
    counts = np.maximum(1, -(-np.diff(offsets) // WINDOW))
    totals = np.zeros((2, len(counts), len(network.languages)))
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[:-1][owner] + within * WINDOW
    end = np.minimum(begin + WINDOW, offsets[1:][owner])
    places = np.arange(WINDOW)
    for start in range(0, len(owner), BATCH):
        part = slice(start, start + BATCH)
        at = begin[part, None] + places
        inside = at < end[part, None]
        windows = np.where(inside, raw[np.minimum(at, len(raw) - 1)], 0) if len(raw) else np.zeros(
            inside.shape, np.uint8
        )
        logs = network.log_probabilities(network.largest(windows))
        for row, values in enumerate((logs, np.exp(logs))):
            np.add.at(totals[row], owner[part], values)
    return totals / counts[None, :, None]


def namer(spark, network: Network):
    """Function from a text column to a column of ``NAMED``.

    A null text or one without a letter is ``und`` with score 0. The score of another text is the
    mean probability of its language over the windows. Equally likely languages: the first by name.
    """
    shared = ship(spark).sparkContext.broadcast(network)

    @F.arrow_udf(NAMED)
    @released
    def name(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            lettered = pc.fill_null(pc.match_substring_regex(batch, r"\p{L}"), False)
            if own.languages:
                logs, chances = _text_scores(own, batch)
                best = logs.argmax(axis=1)
                names = pa.array(np.array(own.languages, object)[best], pa.string())
                scores = pa.array(chances[np.arange(len(best)), best].clip(0, 1))
                names = pc.if_else(lettered, names, UNDETERMINED)
                scores = pc.if_else(lettered, scores, 0.0)
            else:
                names = pa.array([UNDETERMINED] * len(batch), pa.string())
                scores = pa.array(np.zeros(len(batch)))
            yield pa.StructArray.from_arrays([names, scores], ["lang_pred", "score"])

    return name
