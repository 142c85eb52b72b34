"""Scheduler metadata and other relational inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from opdiag import schemas

TABLES: dict[str, StructType] = {
    "process_definition": schemas.PROCESS_DEFINITION,
    "project": schemas.PROJECT,
    "task_instance": schemas.TASK_INSTANCE,
    "monitored_task": schemas.MONITORED_TASK,
    "query_record": schemas.QUERY_RECORD,
    "workflow_run": schemas.WORKFLOW_RUN,
    "tablet": schemas.TABLET,
    "load_job": schemas.LOAD_JOB,
    "mr_task_attempt": schemas.MR_TASK_ATTEMPT,
}


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A known relation stored as parquet."""
    return spark.read.schema(TABLES[name]).parquet(path)


def read_jdbc(spark: SparkSession, name: str, url: str, dbtable: str, **options: str) -> DataFrame:
    """A known relation from the scheduler's database; columns are matched by name.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read a large
    table in parallel. The driver's jar and the credentials come with ``options``.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable)
    frame = reader.options(**options).load()
    return frame.select(*[frame[f.name].cast(f.dataType) for f in TABLES[name].fields])


def read_relation(
    spark: SparkSession, path: str, schema: StructType, delimiter: str = ","
) -> DataFrame:
    """A delimited relation with a header line."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", delimiter)
        .csv(path)
    )


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Task-attempt counters of MapReduce jobs, as JSON lines."""
    return spark.read.schema(schemas.MR_TASK_ATTEMPT).json(path)
