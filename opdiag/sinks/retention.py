"""Dropping old partitions from tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from opdiag.defaults import Fixed
from opdiag.operators.retention import month_plan, month_shifted, oldest_kept


def _drop_before(spark: SparkSession, table: str, key: str, oldest: Column) -> list[str]:
    """Drops partitions with a key below ``oldest``.

    The keys come from the catalog; a range cannot be dropped in one statement, but a list can.
    """
    listed = spark.sql(f"show partitions {table}").select(
        F.regexp_extract("partition", f"{key}=([^/]+)", 1).alias("value")
    )
    old = [row.value for row in listed.where(F.col("value") < oldest).distinct().collect()]
    if old:
        each = ", ".join(f"partition ({key}='{value}')" for value in old)
        spark.sql(f"alter table {table} drop if exists {each}")
    return sorted(old)


def drop_expired(
    spark: SparkSession,
    tables: Iterable[str],
    as_of: str | dt.date,
    days: int = Fixed.RETENTION_DAYS,
    key: str = "partition_key",
) -> dict[str, list[str]]:
    """Drops daily partitions from before ``as_of`` minus ``days``, and says which."""
    return {table: _drop_before(spark, table, key, oldest_kept(as_of, days)) for table in tables}


def drop_expired_months(
    spark: SparkSession,
    tables: Iterable[str],
    as_of: str | dt.date,
    months: int = Fixed.MONTHS_KEPT_REPORT,
    key: str = "month",
) -> dict[str, list[str]]:
    """Drops monthly partitions from before ``as_of`` minus ``months``, and says which."""
    return {table: _drop_before(spark, table, key, month_shifted(as_of, -months)) for table in tables}


def maintain_months(
    spark: SparkSession,
    tables: Iterable[str],
    as_of: str | dt.date,
    months: int = Fixed.MONTHS_KEPT_REPORT,
    ahead: int = Fixed.MONTHS_AHEAD,
    key: str = "month",
) -> dict[str, dict[str, list[str]]]:
    """Brings monthly partitions in line with the sliding range; says what was added and dropped.

    The months that exist come from the catalog. Months of the range that are missing are added, so
    that next month's partition is there before its first row.
    """
    done = {}
    for table in tables:
        listed = spark.sql(f"show partitions {table}").select(
            F.lit(table).alias("table_name"),
            F.regexp_extract("partition", f"{key}=([^/]+)", 1).alias("month"),
        )
        none = spark.createDataFrame([(table, None)], "table_name string, month string")
        # a table without partitions still needs its range
        plan = month_plan(listed.unionByName(none), as_of, months, ahead).where("month is not null")
        changes: dict[str, list[str]] = {"add": [], "drop": []}
        for row in plan.where("action <> 'keep'").orderBy("month").collect():
            changes[row.action].append(row.month)
        if changes["add"]:
            each = " ".join(f"partition ({key}='{month}')" for month in changes["add"])
            spark.sql(f"alter table {table} add if not exists {each}")
        if changes["drop"]:
            each = ", ".join(f"partition ({key}='{month}')" for month in changes["drop"])
            spark.sql(f"alter table {table} drop if exists {each}")
        done[table] = changes
    return done
