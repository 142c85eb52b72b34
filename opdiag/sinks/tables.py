"""Partitioned table writes, exports, appends and key upserts."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opdiag.operators.retention import export_history, upsert_latest

def compacted(rows: DataFrame, *by: str) -> DataFrame:
    """Even output files: small partitions are merged and large ones split at run time."""
    return rows.hint("rebalance", *by)


def _located(writer: DataFrameWriter, location: str | None) -> DataFrameWriter:
    writer = writer.format("parquet")
    return writer if location is None else writer.option("path", location)


def partition_values(spark: SparkSession, table: str, key: str) -> list[str]:
    """Values of a table's partition column, from the catalog; none if there is no table."""
    if not spark.catalog.tableExists(table):
        return []
    listed = spark.sql(f"show partitions {table}")
    value = F.regexp_extract("partition", f"{key}=([^/]+)", 1)
    return sorted(row[0] for row in listed.select(value).distinct().collect())


@contextmanager
def _dynamic_partitions(spark: SparkSession):
    """Inserts into a catalog table follow the session's setting, not a writer option."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def overwrite_partitions(
    rows: DataFrame,
    table: str,
    partition_by: Sequence[str] = ("partition_key",),
    compact: bool = True,
    location: str | None = None,
) -> None:
    """Replaces the partitions that occur in ``rows`` and keeps the others.

    Columns go by position into an existing table, as ``insert`` does; partition columns last.
    ``compact`` shuffles once more to even out file sizes; leave it off for one large partition
    whose rows come from a scan or a shuffle, which are already of even size. A new table lies at
    ``location``, by default in the warehouse.
    """
    partition_by = list(partition_by)
    spark = rows.sparkSession
    ordered = rows.select(*[c for c in rows.columns if c not in partition_by], *partition_by)
    if compact:
        ordered = compacted(ordered, *partition_by)
    if not spark.catalog.tableExists(table):
        _located(ordered.write.partitionBy(*partition_by), location).saveAsTable(table)
        return
    with _dynamic_partitions(spark):
        ordered.write.insertInto(table, overwrite=True)


def replace_table(rows: DataFrame, table: str, location: str | None = None) -> None:
    """Drops and creates a table from a query."""
    _located(compacted(rows).write.mode("overwrite"), location).saveAsTable(table)


def publish_export(
    spark: SparkSession, report_table: str, export_table: str, location: str | None = None
) -> None:
    """Writes all partitions of a report as an export table."""
    replace_table(export_history(spark.table(report_table)), export_table, location)


def append(rows: DataFrame, table: str, schema: StructType, location: str | None = None) -> None:
    """Appends rows by column name, cast to the table's schema."""
    shaped = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    _located(shaped.write.mode("append"), location).saveAsTable(table)


def _of_partitions(current: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the touched partitions; the scan leaves out all others.

    The names of the touched partitions, one small row each, reach the driver, where the write
    keeps them anyway. They are compared as one JSON value, in which a NULL is a value like others.
    """
    name = F.to_json(F.struct(*touched.columns), {"ignoreNullFields": "false"})
    return current.where(name.isin([row[0] for row in touched.select(name).collect()]))


def upsert(
    changes: DataFrame,
    table: str,
    keys: Sequence[str],
    version: str = "insert_time",
    partition_by: Sequence[str] = ("dt",),
) -> None:
    """Writes the latest row per key; only the partitions that change are read and rewritten.

    The partition columns must be part of the key. The merged rows are checkpointed first, because
    the table is overwritten while it is also the input.
    """
    from opdiag.session import shared_dir

    spark, partition_by = changes.sparkSession, list(partition_by)
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must belong to the key")
    if not spark.catalog.tableExists(table):
        first = upsert_latest(changes.limit(0), changes, keys, version)
        overwrite_partitions(first, table, partition_by)
        return
    shared_dir(spark)
    current = spark.table(table)
    affected = _of_partitions(current, changes.select(*partition_by).distinct())
    merged = upsert_latest(affected, changes.select(*current.columns), keys, version)
    overwrite_partitions(merged.checkpoint(), table, partition_by)
