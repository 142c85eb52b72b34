"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a text's standing, and ordered thresholds cut the
line into grades: P(grade > k) = sigmoid(w.x - t_k) with t_0 < t_1 < ... The model is fitted by numpy
on a bounded sample of rated rows; scoring reads every whole text in pieces.

Features of a text are the means over its words of: the word, its shape (which kinds of characters,
how long, which end) and whether it repeats the word before; and one for the length of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.llm.samples import Adam, Sparse, bounded_sample, one_text_per_id, sigmoid
from opdiag.llm.shipping import released, ship
from opdiag.llm.texts import BLANK, mix, text_words

#: Rated rows that are fitted, per grade on average; all grades and the whole texts of these rows.
SAMPLE_PER_GRADE = 1500
WORD_BITS = 14
SHAPE_BITS = 12
_SHAPES = 1 << WORD_BITS
_REPEAT = _SHAPES + (1 << SHAPE_BITS)
_LENGTHS = _REPEAT + 1
SIZE = _LENGTHS + 40
SCALE = 20.0
STEPS = 250
PENALTY = 1e-4

FEATURES = "grade int, indices array<int>, weights array<float>"
SCORED = "struct<expected_grade:double,tail:double>"


def _kinds() -> np.ndarray:
    """Character kinds of a byte as bits."""
    kinds = np.zeros(256, np.uint8)
    for byte in range(33, 256):
        char = chr(byte)
        if byte >= 128:
            kinds[byte] = 1
        elif char.isupper():
            kinds[byte] = 2
        elif char.islower():
            kinds[byte] = 4
        elif char.isdigit():
            kinds[byte] = 8
        elif char in ".,;:!?'\"()-":
            kinds[byte] = 16
        else:
            kinds[byte] = 32
    return kinds


KINDS = _kinds()


def _word_features(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket, shape bucket and repetition of every word."""
    count = len(words.hashes)
    raw = words.raw[words.low : int(words.end[-1])]
    kinds = np.bitwise_or.reduceat(KINDS[raw], words.begin - words.low).astype(np.uint64)
    length = np.minimum(words.end - words.begin, 40).astype(np.uint64)
    last = words.raw[words.end - 1]
    ending = np.where(KINDS[last] & 0b00001111, 0, last).astype(np.uint64)
    shape = mix(kinds + (length << np.uint64(8)) + (ending << np.uint64(16)))
    again = np.zeros(count, bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.owner[1:] == words.owner[:-1])
    return (
        (words.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64),
        _SHAPES + (shape >> np.uint64(64 - SHAPE_BITS)).astype(np.int64), again,
    )


def _length_feature(counts: np.ndarray) -> np.ndarray:
    return _LENGTHS + np.floor(2 * np.log2(counts + 1)).astype(np.int64).clip(0, 39)


def _sparse_rows(column: pa.Array) -> Iterator[tuple[list[int], list[float]]]:
    """Indices and values of every text, in order."""
    found: list[list[np.ndarray]] = [[] for _ in range(len(column))]
    counts = np.zeros(len(column), np.int64)
    for start, words in text_words(column, BLANK):
        if not len(words.hashes):
            continue
        word, shape, again = _word_features(words)
        counts += np.bincount(words.owner + start, minlength=len(column))
        every = np.concatenate((word, shape, np.full(int(again.sum()), _REPEAT)))
        owner = np.concatenate((words.owner, words.owner, words.owner[again])) + start
        order = np.argsort(owner, kind="stable")
        every, owner = every[order], owner[order]
        cuts = np.searchsorted(owner, np.arange(start, owner[-1] + 2))
        for text in range(start, owner[-1] + 1):
            part = every[cuts[text - start] : cuts[text - start + 1]]
            if len(part):
                found[text].append(np.stack(np.unique(part, return_counts=True)))
    lengths = _length_feature(counts)
    for text, parts in enumerate(found):
        totals = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if parts:
            index, times = np.concatenate(parts, axis=1)
            index, place = np.unique(index, return_inverse=True)
            totals = index, np.bincount(place, times)
        values = totals[1] * (SCALE / max(1, counts[text]))
        yield [*totals[0].tolist(), int(lengths[text])], [*values.tolist(), 1.0]


@dataclass(frozen=True)
class OrdinalModel:
    grades: tuple[int, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def standing(self, column: pa.Array) -> np.ndarray:
        """w.x of every text."""
        sums, counts = np.zeros(len(column)), np.zeros(len(column), np.int64)
        for start, words in text_words(column, BLANK):
            if not len(words.hashes):
                continue
            word, shape, again = _word_features(words)
            value = self.weights[word] + self.weights[shape] + again * self.weights[_REPEAT]
            owner = words.owner + start
            sums += np.bincount(owner, value, minlength=len(column))
            counts += np.bincount(owner, minlength=len(column))
        return SCALE * sums / np.maximum(counts, 1) + self.weights[_length_feature(counts)]

    def tails(self, column: pa.Array) -> np.ndarray:
        """P(grade > k) for every text and every grade but the last."""
        return sigmoid(self.standing(column)[:, None] - self.thresholds[None, :])


def fit(rows: Sparse, grade: np.ndarray, grades: tuple[int, ...]) -> OrdinalModel:
    """Most likely weights and thresholds, with a penalty on squared weights.

    Thresholds are a first value and positive steps, so that they stay in order. Every grade counts
    alike, whatever its share of the sample. With fewer than two grades there is nothing to learn:
    the weights stay zero.
    """
    rank = np.searchsorted(np.array(grades), grade)
    weights, first = np.zeros(SIZE), np.zeros(1)
    steps = np.zeros(max(len(grades) - 2, 0))
    share = 1.0 / (np.bincount(rank, minlength=len(grades))[rank] * max(1, len(grades)))
    adam = Adam([weights, first, steps], 0.05)
    for _ in range(STEPS if len(grades) > 1 else 0):
        gaps = np.exp(steps)
        cuts = np.concatenate((first, first + np.cumsum(gaps)))
        above = sigmoid(rows.times(weights)[:, None] - cuts[None, :])
        ends = np.concatenate((np.ones((len(rank), 1)), above, np.zeros((len(rank), 1))), axis=1)
        at = np.arange(len(rank))
        upper, lower = ends[at, rank], ends[at, rank + 1]
        likely = np.maximum(upper - lower, 1e-9)
        slope = ends * (1 - ends)
        error = -share * (slope[at, rank] - slope[at, rank + 1]) / likely
        of_cuts = np.zeros(len(cuts))
        low, high = rank > 0, rank < len(grades) - 1
        np.add.at(of_cuts, rank[low] - 1, (share * slope[at, rank] / likely)[low])
        np.add.at(of_cuts, rank[high], -(share * slope[at, rank + 1] / likely)[high])
        tail_sums = np.cumsum(of_cuts[::-1])[::-1]
        adam.step([
            rows.transposed(error, SIZE) + PENALTY * weights, tail_sums[:1], tail_sums[1:] * gaps,
        ])
    cuts = np.concatenate((first, first + np.cumsum(np.exp(steps))))
    return OrdinalModel(grades, weights, cuts[: max(len(grades) - 1, 0)])


def train(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    grade_col: str = "grade", per_grade: int = SAMPLE_PER_GRADE,
) -> OrdinalModel:
    """Fits the model on a bounded sample of ``ratings`` (id, integer grade; the higher the better).

    Rows with a null grade or id are not used. An id that is rated several times counts once per
    grade; of several texts with one id one is used.
    """
    spark = ship(docs.sparkSession)
    known = ratings.select(
        F.col(id_col).alias("doc"), F.col(grade_col).cast("int").alias("grade")
    ).filter("doc is not null")
    sample = bounded_sample(known, "grade", per_grade, "doc")
    texts = one_text_per_id(docs, sample, id_col, text_col)
    chosen = texts.join(F.broadcast(sample), "doc").select("grade", "text")

    @released
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_sparse_rows(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in rows], pa.list_(pa.int32())),
                 pa.array([x for _, x in rows], pa.list_(pa.float32()))],
                ["grade", "indices", "weights"],
            )

    table = chosen.mapInArrow(describe, FEATURES).orderBy("grade", F.xxhash64("indices")).toArrow()
    grade = table.column("grade").to_numpy()
    return fit(Sparse(table), grade, tuple(np.unique(grade).tolist()))


def scorer(spark, model: OrdinalModel, selected_from: int):
    """Function from a text column to a column of ``SCORED``.

    ``tail`` is the probability of at least the grade ``selected_from``. Null texts are scored like
    empty ones. A model of a single grade expects that grade; one of no grade gives nulls.
    """
    shared = ship(spark).sparkContext.broadcast(model)

    @F.arrow_udf(SCORED)
    @released
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        grades = np.array(own.grades, np.float64)
        for batch in batches:
            if len(grades):
                tails = own.tails(batch)
                expected = grades[0] + tails @ np.diff(grades)
                below = int((grades < selected_from).sum())
                tail = tails[:, below - 1] if 0 < below < len(grades) else np.full(
                    len(batch), float(below == 0)
                )
                columns = [pa.array(expected), pa.array(tail)]
            else:
                columns = [pa.nulls(len(batch), pa.float64())] * 2
            yield pa.StructArray.from_arrays(columns, ["expected_grade", "tail"])

    return score
