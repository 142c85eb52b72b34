"""Log lines of resource and node managers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Parts of the log file names.
NODE_MANAGER, RESOURCE_MANAGER = "yarn-NODEMANAGER", "yarn-RESOURCEMANAGER"
HOST_IN_NAME = r"yarn-(?:NODEMANAGER|RESOURCEMANAGER)-(.+?)\.log"


def with_host(lines: DataFrame, pattern: str = HOST_IN_NAME) -> DataFrame:
    """Tags each line with the host found in its file's name."""
    return lines.select(
        "value", F.regexp_extract("_metadata.file_name", pattern, 1).alias("server_ip")
    )


def read_lines(
    spark: SparkSession,
    folder: str,
    kind: str,
    modified_after: str | None = None,
    server_ip: str | None = None,
) -> DataFrame:
    """Lines of the files whose name contains ``kind``, changed since ``modified_after``.

    ``modified_after`` is ``yyyy-MM-ddTHH:mm:ss`` in the session time zone. Without ``server_ip``
    the host comes from the file name.
    """
    reader = spark.read.option("pathGlobFilter", f"*{kind}*")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    lines = reader.text(folder)
    if server_ip is not None:
        return lines.withColumn("server_ip", F.lit(server_ip))
    return with_host(lines)


def lines_of_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines of the given files, with their host and their file."""
    return spark.read.text(files).select(
        "value", F.regexp_extract("_metadata.file_name", HOST_IN_NAME, 1).alias("server_ip"),
        F.col("_metadata.file_path").alias("file"),
    )
