"""Exact medians per group that never bring a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opdiag.functions.numbers import rank_bucket
from opdiag.operators.sized import cut

BUCKET_BITS = 8
PARTS = 4096
# Rows of one group that a task may rank.
BOUND = 200_000


def _middle(total: Column) -> tuple[Column, Column]:
    """Ranks of the lower and upper middle element."""
    half = F.floor((total + 1) / 2).cast("bigint")
    return half, total + 1 - half


def _holds(rank: Column, before: Column, weight: Column) -> Column:
    return (before < rank) & (rank <= before + weight)


def _between(low: Column, high: Column) -> Column:
    """Mean of the two middle elements; halved first, so that large ones do not overflow."""
    return low / 2 + high / 2


def group_median(
    rows: DataFrame, keys: Sequence[str], value: str, bound: int = BOUND
) -> DataFrame:
    """``keys``, ``median``, ``maximum`` and ``n`` of a bigint column; NULL values are left out.

    Counts per value bucket tell which bucket holds the middle, at most a few thousand buckets per
    group. While such a bucket has more than ``bound`` rows and more than one value, its range is
    divided into ``PARTS`` again. Only then are the remaining values counted and ranked, so no task
    ever ranks more than ``bound`` rows of a group, however close its values lie. All steps combine
    before their shuffle: one group holding a third of all rows is no hot spot.

    Every step but the last runs when this is called; its result, two rows per group at most, is
    written down.
    """
    keys = list(keys)
    names = [f"_k{at}" for at in range(len(keys))]
    valued = rows.where(F.col(value).isNotNull()).select(
        *[F.col(key).alias(name) for key, name in zip(keys, names)], F.col(value).alias("_v")
    )
    group = Window.partitionBy(*names)
    total = [F.sum("_n").over(group).alias("n"), F.max("_high").over(group).alias("maximum")]
    buckets = _tally(valued.withColumn("_b", rank_bucket(F.col("_v"), BUCKET_BITS)), [*names, "_b"])
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = _holding(
        buckets.select("*", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), *total), names
    )
    while middle.where((F.col("_n") > bound) & (F.col("_low") < F.col("_high"))).limit(1).count():
        step = F.floor((F.col("_high") - F.col("_low")) / PARTS) + 1
        part = F.floor((F.col("_v") - F.col("_low")) / step)
        within = _inside(valued, middle, names).withColumn("_b", part)
        parts = _tally(within, [*names, "_start", "n", "maximum", "_before", "_b"])
        upto = (
            Window.partitionBy(*names, "_start").orderBy("_b")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        placed = parts.withColumn("_before", F.col("_before") + F.sum("_n").over(upto) - F.col("_n"))
        middle = _holding(placed, names)
    values = (
        _inside(valued, middle, names)
        .groupBy(*names, "_start", "_v", "_before", "n", "maximum")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = (
        Window.partitionBy(*names, "_start").orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = values.withColumn("_before", F.col("_before") + F.sum("_n").over(ranked) - F.col("_n"))
    here = (F.col("_before"), F.col("_n"))
    low, high = _middle(F.col("n"))
    found = placed.groupBy(*names).agg(
        _between(
            F.max(F.when(_holds(low, *here), F.col("_v"))),
            F.max(F.when(_holds(high, *here), F.col("_v"))),
        ).alias("median"),
        F.max("maximum").alias("maximum"),
        F.max("n").alias("n"),
    )
    return found.withColumnsRenamed(dict(zip(names, keys)))


def _tally(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and range of values per bucket."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )


def _holding(placed: DataFrame, names: Sequence[str]) -> DataFrame:
    """The buckets that hold a middle element, written down; ``_start`` names them."""
    low, high = _middle(F.col("n"))
    here = (F.col("_before"), F.col("_n"))
    return cut(
        placed.where(_holds(low, *here) | _holds(high, *here)).select(
            *names, "_low", "_high", F.col("_low").alias("_start"), "_n", "_before", "n", "maximum"
        )
    )[0]


def _inside(valued: DataFrame, middle: DataFrame, names: Sequence[str]) -> DataFrame:
    """Values that lie in the middle buckets of their group."""
    ranges = middle.drop("_n").withColumnsRenamed({name: f"{name}m" for name in names})
    condition = F.col("_v").between(F.col("_low"), F.col("_high"))
    for name in names:
        condition = F.col(name).eqNullSafe(F.col(f"{name}m")) & condition
    return valued.join(ranges, condition).drop(*[f"{name}m" for name in names])
