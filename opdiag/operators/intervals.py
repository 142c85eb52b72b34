"""Uncovered time: how much of a span none of its intervals covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLOT_MS = 3_600_000


def _islands(intervals: DataFrame, part: Sequence[str]) -> DataFrame:
    """Merges overlapping or touching ``start_ms``, ``end_ms`` intervals within each part."""
    ordered = Window.partitionBy(*part).orderBy("start_ms")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fresh = F.coalesce(F.col("start_ms") > F.max("end_ms").over(earlier), F.lit(True))
    return (
        intervals.withColumn("_fresh", fresh.cast("int"))
        .withColumn("_island", F.sum("_fresh").over(upto))
        .groupBy(*part, "_island")
        .agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))
        .drop("_island")
    )


def merged(intervals: DataFrame, keys: Sequence[str], slot_ms: int = SLOT_MS) -> DataFrame:
    """Union of the intervals of each key.

    Three steps keep a crowded key apart: intervals with one start time collapse before the
    shuffle, the rest is merged per key and start-time slot, and only the merged pieces of the
    slots meet in one place.
    """
    starts = intervals.groupBy(*keys, "start_ms").agg(F.max("end_ms").alias("end_ms"))
    slotted = starts.withColumn("_slot", F.floor(F.col("start_ms") / slot_ms))
    return _islands(_islands(slotted, [*keys, "_slot"]).drop("_slot"), keys)


def idle_time(spans: DataFrame, intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per span the time no interval of the same key covers, head and tail included.

    ``spans`` has ``span_start``, ``span_end`` rows; parts outside of a span do not count. A span
    listed twice is one span; a key may have several, such as the attempts of a stage.
    """
    keys = list(keys)
    span = [*keys, "span_start", "span_end"]
    spans = spans.select(*span).distinct()
    pieces = merged(intervals, keys).join(spans, keys)
    inside = F.least("end_ms", "span_end") - F.greatest("start_ms", "span_start")
    covered = pieces.groupBy(*span).agg(F.sum(F.greatest(inside, F.lit(0))).alias("covered_ms"))
    total = F.col("span_end") - F.col("span_start")
    return spans.join(covered, span, "left").select(
        *keys,
        total.alias("total_ms"),
        (total - F.coalesce("covered_ms", F.lit(0))).alias("idle_ms"),
    )
