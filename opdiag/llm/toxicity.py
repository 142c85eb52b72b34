"""Toxicity: a counterfactual-regularised linear classifier on hashed words.

Logistic regression on the means of word and word-beginning features. In labelled sentences that
name a group, the group's term is swapped for the other terms of its list; the squared change of the
score is added to the loss. So the terms themselves, which labels often go along with, get little
weight, and neutral mentions of a group are not marked. The model is fitted by numpy on a bounded
sample of labelled rows; scoring reads every whole text in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.llm.samples import Sparse, bounded_sample, one_text_per_id, sigmoid
from opdiag.llm.shipping import released, ship
from opdiag.llm.texts import PLAIN, text_words

# Terms that may stand for one another, in lower case.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("ausländer", "flüchtlinge"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"), ("étrangers", "réfugiés"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"), ("extranjeros", "refugiados"),
)

#: Labelled rows that are fitted, per class on average.
SAMPLE_PER_CLASS = 2500
FAIRNESS = 1.0
WORD_BITS = 17
HEADS = (4, 6)
HEAD_BITS = 16
SIZE = (1 << WORD_BITS) + len(HEADS) * (1 << HEAD_BITS)
SCALE = 50.0
STEPS = 200
PENALTY = 1e-3
SMOOTHING = 3.0

FEATURES = "label int, swapped boolean, indices array<int>, weights array<float>"


def _buckets(words) -> list[np.ndarray]:
    """Feature numbers of every word: the word and its beginnings."""
    found = [(words.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
    base = 1 << WORD_BITS
    for length in HEADS:
        head = words.heads(length) >> np.uint64(64 - HEAD_BITS)
        found.append(base + head.astype(np.int64))
        base += 1 << HEAD_BITS
    return found


def _sparse_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices and values of every text, in order."""
    found: list[list[np.ndarray]] = [[] for _ in range(len(column))]
    counts = np.zeros(len(column), np.int64)
    for start, words in text_words(column, PLAIN):
        if not len(words.hashes):
            continue
        buckets = _buckets(words)
        counts += np.bincount(words.owner + start, minlength=len(column))
        every, owner = np.concatenate(buckets), np.tile(words.owner, len(buckets))
        order = np.argsort(owner, kind="stable")
        every, owner = every[order], owner[order]
        for text in np.unique(owner):
            low, high = np.searchsorted(owner, [text, text + 1])
            found[start + text].append(np.stack(np.unique(every[low:high], return_counts=True)))
    for text, parts in enumerate(found):
        if not parts:
            yield np.zeros(0, np.int64), np.zeros(0)
            continue
        index, times = np.concatenate(parts, axis=1)
        index, place = np.unique(index, return_inverse=True)
        yield index, np.bincount(place, times) * (SCALE / counts[text])


def swapped_sentences(
    text: str, groups: Sequence[Sequence[str]]
) -> Iterator[tuple[str, str, str, str]]:
    """Every mention of a group's term with every other term of its list.

    Yields the term, the other one, the sentence and the sentence with the other term in its place.
    """
    others = {term: [x for x in group if x != term] for group in groups for term in group}
    pattern = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, others))})(?!\w)", re.IGNORECASE)
    for sentence in re.split(r"(?<=[.!?\n])", text):
        for found in pattern.finditer(sentence):
            term = found.group().lower()
            for other in others[term]:
                yield term, other, sentence, sentence[: found.start()] + other + sentence[found.end() :]


def swap_changes(
    text: str, groups: Sequence[Sequence[str]], at_once: int = 256
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Change of the features per pair of terms, the mean over all mentions in a text.

    There are as many changes as pairs of terms at most, however long the text is; the sentences are
    taken up in parts.
    """
    totals: dict[tuple[str, str], list] = {}
    swaps = swapped_sentences(text, groups)
    while part := list(islice(swaps, at_once)):
        before = _sparse_rows(pa.array([x[2] for x in part], pa.string()))
        after = _sparse_rows(pa.array([x[3] for x in part], pa.string()))
        for (term, other, *_), (index, value), (changed, new) in zip(part, before, after):
            total = totals.setdefault((term, other), [np.zeros(0, np.int64), np.zeros(0), 0])
            every = np.concatenate((total[0], index, changed))
            total[0], place = np.unique(every, return_inverse=True)
            total[1] = np.bincount(place, np.concatenate((total[1], -value, new)))
            total[2] += 1
    # features that a swap leaves as they are cancel out
    return [
        (index[value != 0], value[value != 0] / count) for index, value, count in totals.values()
    ]


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        sums, counts = np.zeros(len(column)), np.zeros(len(column), np.int64)
        for start, words in text_words(column, PLAIN):
            if not len(words.hashes):
                continue
            owner = words.owner + start
            value = sum(self.weights[bucket] for bucket in _buckets(words))
            sums += np.bincount(owner, value, minlength=len(column))
            counts += np.bincount(owner, minlength=len(column))
        return sigmoid(SCALE * sums / np.maximum(counts, 1) + self.bias)


def _leaning(rows: Sparse, label: np.ndarray) -> np.ndarray:
    """How much more often a feature occurs in toxic rows than in others, as a smoothed log ratio."""
    present = label[rows.row] == 1
    toxic = np.bincount(rows.index[present], minlength=SIZE).astype(float)
    other = np.bincount(rows.index[~present], minlength=SIZE).astype(float)
    counts = np.bincount(label, minlength=2)
    return np.log((toxic + SMOOTHING) / (other * counts[1] / counts[0] + SMOOTHING))


def fit(
    rows: Sparse, label: np.ndarray, swaps: Sparse, fairness: float = FAIRNESS
) -> ToxicityModel:
    """Weights that minimise the logistic loss of balanced classes plus the penalties.

    Features are scaled by their leaning first, so that what many rows of a class share is learned
    and what single rows happen to hold is not. ``swaps`` has the change of the features that each
    swap makes. Without rows of both classes the weights stay zero and the bias is far below or
    above zero for the class that there is; without any row all texts score below 0.5.
    """
    counts = np.bincount(label, minlength=2)
    if not counts.all():
        return ToxicityModel(np.zeros(SIZE), 4.0 if counts[1] else -4.0)
    leaning = _leaning(rows, label)
    share = 0.5 / counts[label]
    weights, bias = np.zeros(SIZE), 0.0
    speed, bias_speed = np.zeros(SIZE), 0.0
    lengths = np.bincount(rows.row, (rows.value * leaning[rows.index]) ** 2, minlength=len(rows))
    bound = 0.25 * (share @ lengths) + 0.25
    if len(swaps):
        lengths = np.bincount(swaps.row, (swaps.value * leaning[swaps.index]) ** 2)
        bound += 2 * fairness * lengths.mean()
    for _ in range(STEPS):
        error = share * (sigmoid(rows.times(weights * leaning) + bias) - label)
        gradient = rows.transposed(error, SIZE) * leaning + PENALTY * weights
        if len(swaps):
            change = 2 * fairness / len(swaps) * swaps.times(weights * leaning)
            gradient += swaps.transposed(change, SIZE) * leaning
        speed = 0.9 * speed - gradient / bound
        bias_speed = 0.9 * bias_speed - error.sum() / bound
        weights, bias = weights + speed, bias + bias_speed
    return ToxicityModel(weights * leaning, float(bias))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS,
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS, fairness: float = FAIRNESS,
) -> ToxicityModel:
    """Fits the model on a bounded sample of ``labels`` (id, 1 for toxic and 0 for not).

    Rows with a null label or id are not used. An id that is labelled several times counts once per
    label; of several texts with one id one is used.
    """
    spark = ship(docs.sparkSession)
    known = labels.select(
        F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("label")
    ).filter("doc is not null and label in (0, 1)")
    sample = bounded_sample(known, "label", per_class, "doc")
    texts = one_text_per_id(docs, sample, id_col, text_col)
    chosen = texts.join(F.broadcast(sample), "doc").select("label", "text")

    @released
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels_of, texts_of = batch.column(0).to_pylist(), batch.column(1)
            rows = [(label, False, *row) for label, row in zip(labels_of, _sparse_rows(texts_of))]
            for label, text in zip(labels_of, texts_of.to_pylist()):
                for index, value in swap_changes(text or "", groups):
                    rows.append((label, True, index, value))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.bool_()),
                 pa.array([x[2] for x in rows], pa.list_(pa.int32())),
                 pa.array([x[3] for x in rows], pa.list_(pa.float32()))],
                ["label", "swapped", "indices", "weights"],
            )

    found = chosen.mapInArrow(describe, FEATURES).orderBy("swapped", "label", F.xxhash64("indices")).toArrow()
    swapped = found.column("swapped")
    rows, swaps = found.filter(pa.compute.invert(swapped)), found.filter(swapped)
    return fit(Sparse(rows), rows.column("label").to_numpy(), Sparse(swaps), fairness)


def scorer(spark, model: ToxicityModel):
    """Function from a text column to a score from 0 to 1; null texts score like empty ones."""
    shared = ship(spark).sparkContext.broadcast(model)

    @F.arrow_udf("double")
    @released
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.score(batch))

    return score
