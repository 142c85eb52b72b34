"""Spark event logs as task, stage, job, executor, plan, memory and broadcast tables.

A log line is one JSON event. Each table reads only the lines of its event kinds, with a
schema of the fields it needs; fields a version does not write are NULL. ``land`` sorts all lines into
partitions by kind in one pass, for when several tables are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.defaults import Ours
from opdiag.operators.sized import dealt
from opdiag.schemas import (
    APP_BROADCAST,
    APP_EXECUTOR,
    APP_FAILURE,
    APP_JOB,
    APP_MEMORY,
    APP_PLAN,
    APP_STAGE,
    JOB_TASK,
)
from opdiag.sinks import ledger

# How application ids look in the names of logs or, for rolling logs, their folders.
APP_IN_NAME = r"(application_\d+_\d+|app-\d+-\d+|local-\d+)"

_TASK_END = """
`Stage ID` int, `Task Type` string,
`Task End Reason` struct<`Reason`: string, `Class Name`: string, `Description`: string, `Message`: string,
  `Loss Reason`: string, `Kill Reason`: string>,
`Task Info` struct<`Launch Time`: bigint, `Finish Time`: bigint, `Executor ID`: string, `Speculative`: boolean>,
`Task Executor Metrics` struct<`JVMHeapMemory`: bigint>,
`Task Metrics` struct<`Executor CPU Time`: bigint, `JVM GC Time`: bigint, `Peak Execution Memory`: bigint,
  `Shuffle Read Metrics`: struct<`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
  `Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>>
"""
_STAGE_DONE = """
`Stage Info` struct<`Stage ID`: int, `Stage Attempt ID`: int, `Submission Time`: bigint, `Completion Time`: bigint>
"""
_JOB_START = "`Job ID` int, `Submission Time` bigint, `Stage IDs` array<int>, `Properties` map<string, string>"
_JOB_END = """
`Job ID` int, `Completion Time` bigint,
`Job Result` struct<`Result`: string, `Exception`: struct<`Message`: string>>
"""
_SQL_END = "executionId bigint, `time` bigint, errorMessage string"
_EXECUTOR_ADDED = "`Timestamp` bigint, `Executor ID` string, `Executor Info` struct<`Total Cores`: int>"
_EXECUTOR_REMOVED = "`Timestamp` bigint, `Executor ID` string, `Removed Reason` string"
_APP_START = "`Timestamp` bigint"
_APP_END = "`Timestamp` bigint"
_ENVIRONMENT = "`Spark Properties` map<string, string>"
_PLAN = "executionId bigint, physicalPlanDescription string"
_ACCUMULATED = "executionId bigint, accumUpdates array<array<bigint>>"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Event lines with the application id found at the end of the file's path."""
    return _read(spark, path).drop("file")


def _read(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # searched from the end of the name, which is looked at for every line
    found = F.regexp_extract("_metadata.file_path", f"(?s).*{APP_IN_NAME}", 1)
    return spark.read.option("recursiveFileLookup", True).text(path).select(
        "value", F.nullif(found, F.lit("")).alias("app_id"),
        F.col("_metadata.file_path").alias("file"),
    )


# Kinds of events that the tables below are made of.
KINDS = (
    "SparkListenerTaskEnd", "SparkListenerStageCompleted", "SparkListenerJobStart",
    "SparkListenerJobEnd", "SparkListenerExecutorAdded", "SparkListenerExecutorRemoved",
    "SparkListenerApplicationStart", "SparkListenerApplicationEnd",
    "SparkListenerEnvironmentUpdate", "SparkListenerSQLExecutionStart",
    "SparkListenerSQLAdaptiveExecutionUpdate", "SparkListenerSQLExecutionEnd",
    "SparkListenerDriverAccumUpdates",
)


def land(lines: DataFrame, folder: str, day: str) -> None:
    """Writes the lines of the known kinds once, partitioned by day and kind.

    Every table then reads the partitions of its kinds only, in place of all text. The day is that
    of the collection; landing a day again replaces it.
    """
    (
        _by_kind(lines).withColumn("day", F.lit(day)).hint("rebalance", "kind")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "kind").parquet(folder)
    )


def _by_kind(lines: DataFrame) -> DataFrame:
    """Lines of the known kinds."""
    # an event's name ends at the fourth quote: the pattern needs no more of a line, however long it is
    head = F.substring_index("value", '"', 5)
    kind = F.regexp_extract(head, r'^\{"Event":"[A-Za-z.]*?(SparkListener[A-Za-z]+)"', 1)
    return lines.withColumn("kind", kind).where(F.col("kind").isin(*KINDS))


_LISTING_TASKS = 100
_OPEN_COST = 2**20  # bytes that opening a log counts as
_SHUFFLED = 8  # how many times smaller lines are while they are shuffled


def land_new(
    spark: SparkSession, logs: str, target: str, file_bytes: int = Ours.FILE_BYTES
) -> int:
    """Lands files of a log folder that are new or have grown, each version once.

    Lines are brought together by kind, in partitions of about ``file_bytes`` before compression, so
    the number of files written does not depend on how many applications there are. Returns the
    number of files read.
    """
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(max(1, file_bytes // _SHUFFLED)),
        # very many logs would otherwise be listed and read by as many tasks
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(_LISTING_TASKS),
        "spark.sql.files.openCostInBytes": str(_OPEN_COST),
        # the files of all kinds may be open at once, in place of a sort of all lines
        "spark.sql.maxConcurrentOutputFileWriters": str(len(KINDS)),
    }
    before = {key: spark.conf.get(key) for key in settings}

    def read(files: list[str]) -> DataFrame:
        return dealt(_by_kind(_read(spark, files)).withColumn("part", F.lit("")), "kind")

    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return ledger.load_new(
            spark, ledger.listed(spark, logs), read, target, partition_by=["kind"], folder=logs
        )
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def landed_new(spark: SparkSession, target: str) -> DataFrame:
    """Lines of the newest version of every landed file, for the tables below."""
    return ledger.loaded(spark, target, "app_id string, value string, kind string").drop("part", "file")


def landed(spark: SparkSession, folder: str, day: str) -> DataFrame:
    """Lines that were landed on a day, for the tables below."""
    shape = "app_id string, value string, day string, kind string"
    return spark.read.schema(shape).parquet(folder).where(F.col("day") == day)


def of_kind(lines: DataFrame, *kinds: str) -> DataFrame:
    """Lines of some kinds: by partition if they have landed, else by the head of each line."""
    if "kind" in lines.columns:
        return lines.where(F.col("kind").isin(*kinds))
    return lines.where(F.col("value").rlike(f'^\\{{"Event":"[A-Za-z.]*({"|".join(kinds)})"'))


def parsed(lines: DataFrame, kind: str | tuple[str, ...], schema: str) -> DataFrame:
    chosen = of_kind(lines, *([kind] if isinstance(kind, str) else kind))
    # from a generator: tests on fields, those of joins included, would otherwise read the text again
    return chosen.select("app_id", F.inline(F.array(F.from_json("value", schema))))


def _bytes(size: Column) -> Column:
    """Bytes of a setting such as ``8g``; a bare number counts MiB."""
    number = F.regexp_extract(size, r"^(\d+)", 1).try_cast("bigint")
    unit = F.lower(F.regexp_extract(size, r"^\d+([kmgtKMGT]?)", 1))
    shift = (
        F.when(unit == "k", 10).when(unit == "g", 30).when(unit == "t", 40).otherwise(20)
    )
    return number * F.pow(F.lit(2.0), shift).cast("bigint")


def memory(lines: DataFrame) -> DataFrame:
    """Driver and executor memory of each application; 1 GiB where it is not set."""
    settings = F.col("Spark Properties")
    sizes = [
        _bytes(F.coalesce(F.try_element_at(settings, F.lit(f"spark.{role}.memory")), F.lit("1g")))
        .alias(f"{role}_memory")
        for role in ("driver", "executor")
    ]
    return (
        parsed(lines, "SparkListenerEnvironmentUpdate", _ENVIRONMENT)
        .select("app_id", *sizes)
        .groupBy("app_id")
        .agg(*[F.max(name).alias(name) for name in ("driver_memory", "executor_memory")])
        .select(*APP_MEMORY.names)
    )


def tasks(lines: DataFrame) -> DataFrame:
    """One row per finished task attempt."""
    info, metrics = F.col("Task Info"), F.col("Task Metrics")
    reason, shuffled = F.col("Task End Reason"), metrics["Shuffle Read Metrics"]
    parts = [metrics["Input Metrics"]["Bytes Read"], shuffled["Remote Bytes Read"],
             shuffled["Local Bytes Read"]]
    known = parts[0].isNotNull() | parts[1].isNotNull() | parts[2].isNotNull()
    read = [F.coalesce(part, F.lit(0)) for part in parts]
    detail = F.concat_ws(": ", reason["Reason"], reason["Class Name"], F.coalesce(
        reason["Description"], reason["Message"], reason["Loss Reason"], reason["Kill Reason"]
    ))
    ended = parsed(lines, "SparkListenerTaskEnd", _TASK_END).select(
        "app_id",
        F.col("Stage ID").alias("stage_id"),
        F.col("Task Type").alias("kind"),
        info["Executor ID"].alias("executor_id"),
        info["Launch Time"].alias("launch_ms"),
        (info["Finish Time"] - info["Launch Time"]).alias("duration_ms"),
        F.when(known, read[0] + read[1] + read[2]).alias("input_bytes"),
        metrics["Input Metrics"]["Records Read"].alias("input_records"),
        info["Speculative"].alias("speculative"),
        metrics["JVM GC Time"].alias("gc_ms"),
        F.floor(metrics["Executor CPU Time"] / 1_000_000).alias("cpu_ms"),
        F.greatest(F.col("Task Executor Metrics")["JVMHeapMemory"],
                   metrics["Peak Execution Memory"]).alias("peak_memory"),
        F.when(reason["Reason"] != "Success", detail).alias("failure_reason"),
    )
    given = memory(lines).select(
        "app_id", "driver_memory", F.col("executor_memory").alias("allocated_memory")
    )
    # one row per application: the optimizer broadcasts it where its size allows
    return (
        ended.join(given, "app_id", "left")
        .withColumn(
            "allocated_memory",
            F.when(F.col("executor_id") == "driver", F.col("driver_memory"))
            .otherwise(F.col("allocated_memory")),
        )
        .select(*JOB_TASK.names)
    )


def _job_starts(lines: DataFrame) -> DataFrame:
    execution = F.try_element_at("Properties", F.lit("spark.sql.execution.id"))
    return parsed(lines, "SparkListenerJobStart", _JOB_START).select(
        "app_id",
        F.col("Job ID").alias("job_id"),
        execution.try_cast("bigint").alias("execution_id"),
        F.col("Submission Time").alias("submit_ms"),
        F.col("Stage IDs").alias("stage_ids"),
    )


def jobs(lines: DataFrame) -> DataFrame:
    """Finished jobs and their times."""
    ends = parsed(lines, "SparkListenerJobEnd", _JOB_END).select(
        "app_id", F.col("Job ID").alias("job_id"), F.col("Completion Time").alias("end_ms")
    )
    return _job_starts(lines).join(ends, ["app_id", "job_id"]).select(*APP_JOB.names)


def job_failures(lines: DataFrame) -> DataFrame:
    """Jobs that did not succeed, with the first line of their reason: ``APP_FAILURE``."""
    result = F.col("Job Result")
    return parsed(lines, "SparkListenerJobEnd", _JOB_END).where(
        result["Result"] != "JobSucceeded"
    ).select(
        "app_id", F.concat(F.lit("job "), F.col("Job ID")).alias("unit"),
        F.col("Completion Time").alias("end_ms"),
        F.coalesce(result["Exception"]["Message"], result["Result"]).alias("failure_reason"),
    ).select(*APP_FAILURE.names)


def sql_execution_failures(lines: DataFrame) -> DataFrame:
    """SQL executions that ended with an error, analysis errors included: ``APP_FAILURE``."""
    return parsed(lines, "SparkListenerSQLExecutionEnd", _SQL_END).where(
        F.length("errorMessage") > 0
    ).select(
        "app_id", F.concat(F.lit("execution "), F.col("executionId")).alias("unit"),
        F.col("time").alias("end_ms"), F.col("errorMessage").alias("failure_reason"),
    ).select(*APP_FAILURE.names)


def executor_losses(lines: DataFrame) -> DataFrame:
    """Executors that were removed, with the reason: ``APP_FAILURE``."""
    return parsed(lines, "SparkListenerExecutorRemoved", _EXECUTOR_REMOVED).select(
        "app_id", F.concat(F.lit("executor "), F.col("Executor ID")).alias("unit"),
        F.col("Timestamp").alias("end_ms"), F.col("Removed Reason").alias("failure_reason"),
    ).select(*APP_FAILURE.names)


def stage_jobs(lines: DataFrame) -> DataFrame:
    """Every job that a stage belongs to, with its SQL execution."""
    return _job_starts(lines).select(
        "app_id", "job_id", "execution_id", F.explode("stage_ids").alias("stage_id")
    ).distinct()


def stages(lines: DataFrame) -> DataFrame:
    """Completed stage attempts, one row each, with the first job that lists the stage.

    ``stage_jobs`` has the other jobs of a shared stage.
    """
    done = F.col("Stage Info")
    completed = parsed(lines, "SparkListenerStageCompleted", _STAGE_DONE).select(
        "app_id",
        done["Stage ID"].alias("stage_id"),
        F.coalesce(done["Stage Attempt ID"], F.lit(0)).alias("stage_attempt"),
        done["Submission Time"].alias("submit_ms"),
        done["Completion Time"].alias("end_ms"),
    ).distinct()
    owner = stage_jobs(lines).groupBy("app_id", "stage_id").agg(
        F.min(F.struct("job_id", "execution_id")).alias("job")
    )
    return completed.join(owner, ["app_id", "stage_id"], "left").select(
        "*", "job.job_id", "job.execution_id"
    ).select(*APP_STAGE.names)


def executors(lines: DataFrame) -> DataFrame:
    """Executors with their cores and the time they lived.

    Only in local mode an executor is named driver. Elsewhere the driver gets a row of its own:
    the cores it was given, one by default, for the time of the application.
    """
    added = parsed(lines, "SparkListenerExecutorAdded", _EXECUTOR_ADDED).select(
        "app_id",
        F.col("Executor ID").alias("executor_id"),
        F.col("Executor Info")["Total Cores"].alias("cores"),
        F.col("Timestamp").alias("start_ms"),
    )
    removed = parsed(lines, "SparkListenerExecutorRemoved", _EXECUTOR_REMOVED).select(
        "app_id", F.col("Executor ID").alias("executor_id"), F.col("Timestamp").alias("removed_ms")
    )
    ended = parsed(lines, "SparkListenerApplicationEnd", _APP_END).select(
        "app_id", F.col("Timestamp").alias("app_end_ms")
    )
    settings = parsed(lines, "SparkListenerEnvironmentUpdate", _ENVIRONMENT).select(
        "app_id",
        F.try_element_at("Spark Properties", F.lit("spark.driver.cores")).try_cast("int").alias("set"),
    ).groupBy("app_id").agg(F.max("set").alias("set"))
    begun = parsed(lines, "SparkListenerApplicationStart", _APP_START).select(
        "app_id", F.col("Timestamp").alias("start_ms")
    )
    drivers = (
        begun.join(settings, "app_id", "left")
        .join(added.where("executor_id = 'driver'"), "app_id", "left_anti")
        .select("app_id", F.lit("driver").alias("executor_id"),
                F.coalesce("set", F.lit(1)).alias("cores"), "start_ms")
    )
    return (
        added.unionByName(drivers).join(removed, ["app_id", "executor_id"], "left")
        .join(ended, "app_id", "left")
        .withColumn("end_ms", F.coalesce("removed_ms", "app_end_ms"))
        .select(*APP_EXECUTOR.names)
    )


# Both events carry a plan.
PLANNED = ("SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate")


def plans(lines: DataFrame) -> DataFrame:
    """Plan text of SQL executions; re-planned versions are rows of their own.

    A line that is no readable event has none.
    """
    return parsed(lines, PLANNED, _PLAN).where("executionId is not null").select(
        "app_id",
        F.col("executionId").alias("execution_id"),
        F.col("physicalPlanDescription").alias("plan"),
    ).select(*APP_PLAN.names)


def broadcasts(lines: DataFrame) -> DataFrame:
    """Broadcast bytes per SQL execution.

    Plans name the accumulator of each exchange's data size; the driver reports values only for
    broadcasts, so the accumulators it reports under those names are the broadcast sizes.
    """
    named = F.regexp_extract_all(
        "value", F.lit(r'"name":"data size","accumulatorId":(\d+)'), F.lit(1)
    )
    sizes = (
        of_kind(lines, *PLANNED)
        .select("app_id", F.explode(named).alias("id"))
        .select("app_id", F.col("id").cast("bigint").alias("accumulator"))
        .distinct()
    )
    reported = (
        parsed(lines, "SparkListenerDriverAccumUpdates", _ACCUMULATED)
        .select("app_id", "executionId", F.explode("accumUpdates").alias("u"))
        .select(
            "app_id",
            F.col("executionId").alias("execution_id"),
            F.col("u")[0].alias("accumulator"),
            F.col("u")[1].alias("bytes"),
        )
    )
    return reported.join(sizes, ["app_id", "accumulator"], "left_semi").select(*APP_BROADCAST.names)
