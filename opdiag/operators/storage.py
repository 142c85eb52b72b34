"""File-listing diagnoses: flattening, directory and warehouse reports, class shares, users."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opdiag.defaults import GIB, MIB, TIB, Fixed
from opdiag.functions.classes import ACCESS_CLASSES, SIZE_CLASSES, access_class, as_date, size_class
from opdiag.functions.numbers import share
from opdiag.functions.paths import DEPTH, in_warehouse, path_parts, path_prefixes
from opdiag.schemas import FSIMAGE_FILE

FLAT_COLUMNS = [
    "path", *[f"p{k}" for k in range(1, DEPTH + 1)], "blockscount", "filesize_total",
    "accesstime", "filesize", "replication", "modificationtime", "preferredblocksize",
    "nsquota", "dsquota", "permission", "username", "groupname", "partition_key",
]


def flatten_listing(listing: DataFrame, partition_key: str) -> DataFrame:
    """One row per distinct file record of a snapshot, with path prefixes and replicated size.

    Equal records collapse; where the replication factor is unusable their plain sizes add up.
    The prefixes are computed after the shuffle, so only the listing's own columns travel.
    """
    snapshot = listing.where(
        (F.col("partition_key") == partition_key) & (F.col("path") != Fixed.HEADER_PATH)
    )
    records = snapshot.groupBy(*FSIMAGE_FILE.names).agg(F.sum("filesize").alias("plain_size"))
    replication = F.col("replication")
    unusable = replication.isNull() | replication.isin(0, Fixed.UNREPLICATED)
    return records.withColumn("_parts", path_parts(F.col("path"))).select(
        "*",
        *path_prefixes(F.col("_parts")),
        F.when(unusable, F.col("plain_size"))
        .otherwise(replication.cast("bigint") * F.col("filesize"))
        .alias("filesize_total"),
        F.lit(partition_key).alias("partition_key"),
    ).select(*FLAT_COLUMNS)


def _classified(flat: DataFrame, as_of: str | dt.date) -> DataFrame:
    return flat.withColumns(
        {
            "file_ide": size_class(F.col("filesize")),
            "data_ide": access_class(F.col("accesstime"), as_of),
        }
    )


def _class_counts() -> list[Column]:
    sizes = [F.count(F.when(F.col("file_ide") == name, 1)).alias(name) for name in SIZE_CLASSES]
    ages = [F.count(F.when(F.col("data_ide") == name, 1)).alias(name) for name in ACCESS_CLASSES]
    return sizes + ages


def file_class_by_dir(flat: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Files and MiB per top-level directory, size class and temperature; the root is left out."""
    return (
        _classified(flat.where(F.col("p1") != "/"), as_of)
        .groupBy("p1", "file_ide", "data_ide")
        .agg(
            F.count(F.lit(1)).alias("num"),
            (F.sum("filesize_total") / MIB).alias("filesize_total"),
        )
    )


def _both_classes_known(counts: DataFrame) -> DataFrame:
    """Keep groups with at least one size class and at least one temperature."""
    sizes = sum((F.col(name) for name in SIZE_CLASSES), F.lit(0))
    ages = sum((F.col(name) for name in ACCESS_CLASSES), F.lit(0))
    return counts.where((sizes > 0) & (ages > 0))


def dir_storage_report(flat: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Per top-level directory: size in TiB, file count and the eight class counts.

    The ``_pro`` columns hold counts, as in the published report; shares are ``class_share``.
    """
    report = (
        _classified(flat.where(F.col("p1") != "/"), as_of)
        .groupBy("p1")
        .agg(
            (F.sum("filesize_total") / TIB).alias("storage_measure"),
            F.count(F.lit(1)).alias("dir_size"),
            *_class_counts(),
        )
    )
    return _both_classes_known(report).select(
        F.col("p1").alias("dir_name"),
        F.lit(Fixed.TOP_LEVEL).alias("dir_level"),
        "storage_measure", "dir_size", *SIZE_CLASSES, *ACCESS_CLASSES,
        F.date_format(as_date(as_of), "yyyyMMdd").alias("etl_dt"),
    )


def warehouse_storage_report(
    flat: DataFrame, as_of: str | dt.date, only_db_suffix: bool = False
) -> DataFrame:
    """Databases, tables, GiB, files and class counts of the warehouse directory.

    Files are first counted per table, so the distinct counts run over tables, not files.
    ``only_db_suffix`` leaves out tables of the default database.
    """
    files = flat.where(in_warehouse(F.col("p3")))
    if only_db_suffix:
        files = files.where(F.col("p4").endswith(".db"))
    tables = (
        _classified(files, as_of)
        .groupBy("p3", "p4", "p5")
        .agg(
            F.sum("filesize_total").alias("bytes"),
            F.count(F.lit(1)).alias("dir_size"),
            *_class_counts(),
        )
    )
    report = tables.groupBy("p3").agg(
        F.countDistinct("p4").alias("db_count"),
        F.countDistinct("p5").alias("table_count"),
        (F.sum("bytes") / GIB).alias("storage_measure"),
        *[F.sum(name).alias(name) for name in ("dir_size", *SIZE_CLASSES, *ACCESS_CLASSES)],
    )
    return _both_classes_known(report).select(
        "db_count", "table_count", "storage_measure", "dir_size", *SIZE_CLASSES, *ACCESS_CLASSES,
        F.date_format(as_date(as_of), "yyyyMMdd").alias("etl_dt"),
    )


def _class_share(
    flat: DataFrame, as_of: str | dt.date, by: Sequence[str], classes: Sequence[str]
) -> DataFrame:
    counts = (
        _classified(flat.where(F.col("p1") != "/"), as_of)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("file_cun"), *_class_counts())
    )
    known = sum((F.col(name) for name in classes), F.lit(0))
    return counts.where(known > 0).select(
        *by, "file_cun", *[share(F.col(name), F.col("file_cun")).alias(name) for name in classes]
    )


def small_file_ratio(
    flat: DataFrame, as_of: str | dt.date, by: Sequence[str] = ("p1",)
) -> DataFrame:
    """Share of each size class among the files of a directory or, by p4 and p5, of a table."""
    return _class_share(flat, as_of, by, SIZE_CLASSES)


def cold_data_ratio(
    flat: DataFrame, as_of: str | dt.date, by: Sequence[str] = ("p1",)
) -> DataFrame:
    """Share of each temperature among the files of a directory or table."""
    return _class_share(flat, as_of, by, ACCESS_CLASSES)


def user_storage_share(flat: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Share of bytes and files of each directory below ``/user``, by plain file size.

    The total is a one-row scalar subquery over the per-user sums.
    """
    users = (
        flat.where((F.col("p1") == "/user") & F.col("p2").isNotNull())
        .groupBy("p2")
        .agg(F.sum("filesize").alias("user_sto"), F.count(F.lit(1)).alias("user_num"))
    )
    total = users.agg(
        F.struct(F.sum("user_sto").alias("sto"), F.sum("user_num").alias("num")).alias("total")
    ).scalar()
    return users.withColumn("total", total).select(
        F.col("p2").alias("user_name"),
        share(F.col("user_sto"), F.col("total.sto")).alias("user_storage_pro"),
        share(F.col("user_num"), F.col("total.num")).alias("user_dir_pro"),
        F.date_format(as_date(as_of), "yyyyMMdd").alias("etl_dt"),
    )
