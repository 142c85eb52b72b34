"""Bounded samples of labelled rows, and linear models on hashed features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo a number; null for a row without id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def bounded_sample(rows: DataFrame, class_col: str, per_class: int, *keys: str) -> DataFrame:
    """About ``per_class`` different rows of each class, chosen by a hash of the keys.

    Rows that agree in all keys are one row. Every class keeps the share of its different rows that
    gives the wanted number on average, so that no class takes another's place, however many rows it
    has or repeats, and no group meets in one task. Rows with a null class are left out. The number
    of classes must be small: one row per class reaches the driver.
    """
    known = rows.filter(F.col(class_col).isNotNull())
    key = F.xxhash64(*keys, F.lit(5))
    counts = known.groupBy(class_col).agg(
        F.approx_count_distinct(key, 0.02).alias("n")
    ).collect()
    place = F.pmod(key, F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col(class_col) == row[0], min(1.0, per_class / row["n"])).otherwise(share)
    return known.filter(place < share).withColumn("__sample_key", key).dropDuplicates(
        [class_col, "__sample_key"]
    ).drop("__sample_key")


def one_text_per_id(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, text`` for sampled ids (``doc``): of an id's texts the first by hash.

    ``ids`` is a bounded sample. Texts meet per id after those of one task were reduced to one.
    """
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(ids.select("doc").distinct()), "doc")
    first = F.min_by(F.struct("text"), F.struct(F.xxhash64("text"), "text")).alias("one")
    return chosen.groupBy("doc").agg(first).select("doc", "one.text")


class Sparse:
    """Rows of hashed features, as collected from Spark."""

    def __init__(self, table: pa.Table):
        indices = table.column("indices").combine_chunks()
        values = table.column("weights").combine_chunks()
        self.lengths = np.diff(indices.offsets.to_numpy())
        self.index = indices.flatten().to_numpy()
        self.value = values.flatten().to_numpy().astype(np.float32)
        self.row = np.repeat(np.arange(len(self.lengths)), self.lengths)

    def __len__(self) -> int:
        return len(self.lengths)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.index] * self.value, minlength=len(self))

    def transposed(self, errors: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, self.value * errors[self.row], minlength=size)


class Adam:
    """Gradient descent with momentum and scaled steps, in place."""

    def __init__(self, parameters: list[np.ndarray], rate: float):
        self.parameters, self.rate, self.steps = parameters, rate, 0
        self.mean = [np.zeros_like(x) for x in parameters]
        self.square = [np.zeros_like(x) for x in parameters]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.steps += 1
        for x, g, m, v in zip(self.parameters, gradients, self.mean, self.square):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            scale = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            x -= scale * m / (np.sqrt(v) + 1e-8)


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -60, 60)))
