"""Partition retention by day or month, full-history export and key upsert, as queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opdiag.defaults import Fixed
from opdiag.functions.classes import as_date


def oldest_kept(as_of: str | dt.date, days: int = Fixed.RETENTION_DAYS) -> Column:
    """The first ``yyyyMMdd`` key that is kept."""
    return F.date_format(F.date_sub(as_date(as_of), days), "yyyyMMdd")


def expired_partitions(
    partitions: DataFrame, as_of: str | dt.date, days: int = Fixed.RETENTION_DAYS
) -> DataFrame:
    """Distinct (table, partition) pairs whose key is past retention."""
    return (
        partitions.where(F.col("partition_key") < oldest_kept(as_of, days))
        .select("table_name", "partition_key")
        .distinct()
    )


def retained(
    rows: DataFrame, as_of: str | dt.date, days: int = Fixed.RETENTION_DAYS
) -> DataFrame:
    """Rows of the partitions that retention keeps."""
    return rows.where(F.col("partition_key") >= oldest_kept(as_of, days))


def month_shifted(as_of: str | dt.date, months: int) -> Column:
    """The ``yyyyMM`` key ``months`` after the month of ``as_of``."""
    return F.date_format(F.add_months(as_date(as_of), months), "yyyyMM")


def month_partition(rows: DataFrame, date_column: str = "dt") -> DataFrame:
    """Adds the ``yyyyMM`` key of monthly partitions."""
    return rows.withColumn("month", F.date_format(date_column, "yyyyMM"))


def retained_months(
    rows: DataFrame,
    as_of: str | dt.date,
    months: int = Fixed.MONTHS_KEPT_REPORT,
    ahead: int = Fixed.MONTHS_AHEAD,
) -> DataFrame:
    """Rows of the sliding month range around ``as_of``."""
    return rows.where(
        F.col("month").between(month_shifted(as_of, -months), month_shifted(as_of, ahead))
    )


def export_history(report: DataFrame) -> DataFrame:
    """All partitions of a report; the partition key takes the place of the run date."""
    return report.drop("etl_dt").withColumnRenamed("partition_key", "etl_dt")


def upsert_latest(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], version: str = "insert_time"
) -> DataFrame:
    """One row per key: the highest ``version``; on a tie a change replaces the current row.

    The latest row is an aggregate rather than a window, so that copies of one key already
    collapse before the shuffle.
    """
    columns = current.columns
    rest = [name for name in columns if name not in {*keys, version}]
    both = current.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    latest = F.max(F.struct(version, "_new", *rest)).alias("_latest")
    return (
        both.groupBy(*keys)
        .agg(latest)
        .select(*keys, *[F.col(f"_latest.{name}") for name in (version, *rest)])
        .select(*columns)
    )


def month_plan(
    partitions: DataFrame,
    as_of: str | dt.date,
    months: int = Fixed.MONTHS_KEPT_REPORT,
    ahead: int = Fixed.MONTHS_AHEAD,
) -> DataFrame:
    """What the sliding month range around ``as_of`` needs: ``table_name, month, action``.

    The range that is wanted is held against the partitions that exist (table_name, month): those
    missing are to be added, ahead of their time too, those before the range dropped; months after
    it are kept.
    """
    first = F.add_months(F.trunc(as_date(as_of), "month"), -months)
    last = F.add_months(F.trunc(as_date(as_of), "month"), ahead)
    every = F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("_month")
    exists = partitions.select("table_name", "month").distinct().withColumn("_there", F.lit(True))
    wanted = exists.select("table_name").distinct().select("table_name", every).select(
        "table_name", F.date_format("_month", "yyyyMM").alias("month"), F.lit(True).alias("_wanted")
    )
    action = (
        F.when(F.col("_there").isNull(), "add")
        .when(F.col("month") < month_shifted(as_of, -months), "drop").otherwise("keep")
    )
    return wanted.join(exists, ["table_name", "month"], "full").select(
        "table_name", "month", action.alias("action")
    )
