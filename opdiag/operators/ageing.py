"""Old warehouse files: untouched ones, and old partitions that are still in use."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opdiag.defaults import Fixed
from opdiag.functions.classes import as_date
from opdiag.functions.paths import (
    in_warehouse,
    partition_date_text,
    partition_value,
    warehouse_db,
    warehouse_table,
)
from opdiag.functions.times import parsed, years_before

_FILE = ["path", "username", "groupname", "filesize", "accesstime", "modificationtime"]


def _accessed_files(flat: DataFrame, never_accessed: str) -> DataFrame:
    """Non-empty warehouse files with a real access time."""
    never = F.lit(never_accessed).cast("timestamp_ntz")
    accessed = F.col("accesstime").isNotNull() & ~parsed(F.col("accesstime")).eqNullSafe(never)
    return flat.where(in_warehouse(F.col("p3")) & accessed & (F.col("filesize") > 0))


def _either_time(test) -> Column:
    times = [parsed(F.col(name)) for name in ("accesstime", "modificationtime")]
    return F.coalesce(test(times[0]), F.lit(False)) | F.coalesce(test(times[1]), F.lit(False))


def stale_warehouse_files(
    flat: DataFrame,
    as_of: str | dt.date,
    years: int = Fixed.STALE_YEARS,
    never_accessed: str = Fixed.NEVER_ACCESSED,
) -> DataFrame:
    """Warehouse files last accessed or last modified more than ``years`` years ago, sorted.

    ``never_accessed`` is how the listing's time zone prints the time of a file never read.
    """
    limit = years_before(as_date(as_of), years).cast("timestamp_ntz")
    return (
        _accessed_files(flat, never_accessed)
        .where(_either_time(lambda time: time < limit))
        .select(
            *_FILE,
            "permission",
            warehouse_db(F.col("p5")).alias("db"),
            warehouse_table(F.col("p5")).alias("tbl"),
        )
        # the path only breaks ties, so that equal keys still spread over the sort's ranges
        .orderBy("db", "tbl", "accesstime", "path")
    )


def old_partition_touched(
    flat: DataFrame,
    as_of: str | dt.date,
    years: int = Fixed.STALE_YEARS,
    days: int = Fixed.TOUCHED_DAYS,
    never_accessed: str = Fixed.NEVER_ACCESSED,
) -> DataFrame:
    """Files of partitions dated over ``years`` years ago that were used in the last ``days`` days.

    Only partition values that begin with 2 count; an impossible date excludes the file.
    """
    today = as_date(as_of)
    recent = F.date_sub(today, days).cast("timestamp_ntz")
    return (
        _accessed_files(flat, never_accessed)
        .where(partition_value(F.col("p6"), "2") != "")
        .where(_either_time(lambda time: time > recent))
        .select(
            *_FILE,
            partition_value(F.col("p6")).alias("partition_key"),
            partition_date_text(F.col("p6")).alias("partition_date"),
        )
        .where(F.col("partition_date").try_cast("date") < years_before(today, years))
    )
