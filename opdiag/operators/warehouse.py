"""Tablet, partition and load diagnoses of an analytical store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.defaults import Ours


def tablet_size_anomaly(
    tablets: DataFrame,
    min_bytes: int = Ours.TABLET_MIN_BYTES,
    max_bytes: int = Ours.TABLET_MAX_BYTES,
) -> DataFrame:
    """Tablets that are too small or too large."""
    size = F.col("bytes")
    verdict = F.when(size < min_bytes, "small").when(size > max_bytes, "large")
    return tablets.where((size < min_bytes) | (size > max_bytes)).select(
        "table_name", "partition_name", "tablet_id", "bytes", verdict.alias("verdict")
    )


def partition_size_anomaly(
    tablets: DataFrame,
    min_bytes: int = Ours.PARTITION_MIN_BYTES,
    max_bytes: int = Ours.PARTITION_MAX_BYTES,
) -> DataFrame:
    """Partitions that are empty, too small or too large."""
    size = F.col("bytes")
    return (
        tablets.groupBy("table_name", "partition_name")
        .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("tablets"))
        .withColumn(
            "verdict",
            F.when(size == 0, "empty")
            .when(size < min_bytes, "small")
            .when(size > max_bytes, "large"),
        )
        .where(F.col("verdict").isNotNull())
    )


def load_profile(loads: DataFrame) -> DataFrame:
    """Loads and bytes per table and clock hour."""
    return (
        loads.groupBy(
            "table_name",
            F.date_trunc("hour", "load_time").cast("timestamp_ntz").alias("load_hour"),
        )
        .agg(F.count(F.lit(1)).alias("loads"), F.sum("bytes").alias("bytes"))
    )
