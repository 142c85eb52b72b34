"""Scan nodes in the plan text of audited queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opdiag.defaults import Fixed
from opdiag.functions.numbers import ratio
from opdiag.functions.paths import split_at

_MARK = "ScanNode"
_AUDIT = [
    "query_id", "start_time", "end_time", "user", "time_used", "state", "error_message", "sql",
    "database",
]


def _line_value(text: Column, label: str) -> Column:
    """Rest of the first line that holds ``label``; an empty string when there is none."""
    return F.regexp_extract(text, f"{label}(.*?)\n", 1)


def plan_scan_cardinality(
    records: DataFrame,
    start: str,
    end: str,
    min_cardinality: int = Fixed.MIN_CARDINALITY,
    require_table: bool = False,
) -> DataFrame:
    """Scan nodes with at least ``min_cardinality`` rows, of queries started within the window.

    The window includes both ends. Text before the first scan node can carry a join's cardinality;
    such rows have an empty table name and stay unless ``require_table`` is set.
    """
    scans = (
        records.where(F.col("start_time").between(F.lit(start).cast("timestamp_ntz"),
                                                  F.lit(end).cast("timestamp_ntz")))
        .where(F.col("plan").contains("cardinality"))
        .select(*_AUDIT, F.explode(F.split("plan", _MARK)).alias("scan"))
        .where(F.col("scan").contains("cardinality"))
        .select(
            _line_value(F.col("scan"), "TABLE: ").alias("table_name"),
            _line_value(F.col("scan"), "partitions=").alias("partitions"),
            _line_value(F.col("scan"), "cardinality=").alias("cardinality"),
            "*",
        )
        .where(F.col("cardinality").try_cast("bigint") >= min_cardinality)
    )
    if require_table:
        scans = scans.where(F.col("table_name") != "")
    chosen, available = (split_at(F.col("partitions"), "/", k).try_cast("double") for k in (0, 1))
    return scans.select(
        "table_name",
        "partitions",
        ratio(chosen, available).alias("partitions_ratio"),
        "cardinality",
        *_AUDIT,
        "scan",
    )


def query_frequency(records: DataFrame) -> DataFrame:
    """Tables ranked by the number of queries that scan them.

    A plan names a table once per scan; repeats are removed within the row, so only one count per
    table leaves each task.
    """
    nodes = F.split("plan", _MARK)
    named = F.transform(F.slice(nodes, 2, F.size(nodes)), lambda node: _line_value(node, "TABLE: "))
    return (
        records.where(F.col("plan").contains(_MARK))
        .select(F.explode(F.array_distinct(named)).alias("table_name"))
        .where(F.col("table_name") != "")
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("query_count"))
        .orderBy(F.desc("query_count"), "table_name")
    )
