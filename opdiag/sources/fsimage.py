"""Delimited file listings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.defaults import Fixed
from opdiag.schemas import FSIMAGE_FILE

def read_listing(
    spark: SparkSession, path: str, partition_key: str, delimiter: str = ","
) -> DataFrame:
    """A listing file as a snapshot partition, one row per line but the header.

    The last eleven columns are taken from the right, so a path may hold the delimiter. A line with
    fewer columns is read from the left and the others are NULL, and so is a value that is not of
    its column's type. Which columns a query selects makes no difference to its rows.
    """
    names = FSIMAGE_FILE.names
    parts = F.split("value", re.escape(delimiter), -1)
    lines = spark.read.text(path).select(parts.alias("parts"))
    spare = F.size("parts") - len(names)
    whole = F.concat_ws(delimiter, F.slice("parts", F.lit(1), F.greatest(spare, F.lit(0)) + 1))
    values = [whole] + [
        F.get("parts", F.greatest(spare, F.lit(0)) + at) for at in range(1, len(names))
    ]
    columns = [
        F.nullif(value, F.lit("")).try_cast(field.dataType).alias(field.name)
        for value, field in zip(values, FSIMAGE_FILE.fields)
    ]
    return (
        lines.select(*columns)
        .where(~F.col("path").eqNullSafe(Fixed.HEADER_PATH))
        .withColumn("partition_key", F.lit(partition_key))
    )


def snapshot(rows: DataFrame, partition_key: str) -> DataFrame:
    """One day's partition."""
    return rows.where(F.col("partition_key") == partition_key)


def latest_partition(spark: SparkSession, table: str) -> str | None:
    """Newest partition key of a partitioned table, from the catalog alone."""
    keys = spark.sql(f"show partitions {table}").select(
        F.regexp_extract("partition", "partition_key=([^/]+)", 1).alias("key")
    )
    return keys.agg(F.max("key")).first()[0]


def newest_file(spark: SparkSession, folder: str, name_glob: str = "*") -> str | None:
    """Path of the last changed listing; only the folder is listed, no content is read.

    A listing is a file in the folder, or a folder of part files in it, as parallel writers leave
    them; the newest of its part files tells when it has changed.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(folder)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    parts = F.split(F.substr("path", F.lit(len(whole.rstrip("/")) + 2)), "/")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("modificationTime", parts.alias("parts"))
        .where(F.size("parts") <= 2)
        .where(F.get("parts", F.lit(0)).rlike(f"^(?:{hadoop.GlobPattern(name_glob).compiled().pattern()})$"))
        .select("modificationTime", F.concat(F.lit(whole.rstrip("/") + "/"), F.get("parts", F.lit(0))).alias("listing"))
    )
    return files.agg(F.max_by("listing", F.struct("modificationTime", "listing"))).first()[0]
