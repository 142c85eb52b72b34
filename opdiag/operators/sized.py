"""Intermediate results: frames that are written down or dealt out anew, and skewed lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opdiag.session import scratch_path


def cut(frame: DataFrame) -> tuple[DataFrame, int]:
    """Writes a frame to the shared folder, reads it back, and counts its rows on the way.

    The files tell the optimizer the frame's size in bytes, so that it broadcasts it in a join
    exactly where its own limit allows.
    """
    spark = frame.sparkSession
    observed, path = Observation(), scratch_path(spark, "cut")
    frame.observe(observed, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), observed.get["rows"]


def written_parts(spark: SparkSession) -> int:
    """Parts that a shuffle writes at once, the configured number if it is lower.

    Up to a number of parts Spark writes every row to its part's file at once; beyond it, a task
    first collects and sorts all rows it read.
    """
    parts = min(
        int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
            or spark.conf.get("spark.sql.shuffle.partitions")),
        int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", None) or 200),
    )
    return max(1, parts)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out anew by the hash of keys, without being held in the task that deals them.

    A part that gets too large is split afterwards, and small ones are merged.
    """
    return rows.hint("rebalance", written_parts(rows.sparkSession), *keys)


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join with a frame of one row per key, in a form that run-time skew handling can split.

    A hot key is only split where both inputs are shuffled for the join itself. A lookup that was
    aggregated by the same keys would be reused as it is, so the keys' hash joins them as a
    further key, which neither input is partitioned by.
    """
    name = "_spread"
    while name in {*rows.columns, *lookup.columns}:
        name += "_"
    spread = F.xxhash64(*keys).alias(name)
    spread_lookup = lookup.select("*", spread)
    return rows.select("*", spread).join(spread_lookup, [*keys, name], how).drop(name)
