"""MapReduce job history as it is written: a sequence of events, rebuilt into task attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.schemas import MR_TASK_ATTEMPT

# Kinds of events, and names of counters.
STARTED = ("MAP_ATTEMPT_STARTED", "REDUCE_ATTEMPT_STARTED")
ENDED = (
    "MAP_ATTEMPT_FINISHED", "REDUCE_ATTEMPT_FINISHED", "MAP_ATTEMPT_FAILED",
    "REDUCE_ATTEMPT_FAILED", "MAP_ATTEMPT_KILLED", "REDUCE_ATTEMPT_KILLED",
)
READ_BYTES = ("HDFS_BYTES_READ", "REDUCE_SHUFFLE_BYTES")
READ_RECORDS = ("MAP_INPUT_RECORDS", "REDUCE_INPUT_RECORDS")
GC, CPU = "GC_TIME_MILLIS", "CPU_MILLISECONDS"
PEAK, ALLOCATED = "PHYSICAL_MEMORY_BYTES", "COMMITTED_HEAP_BYTES"
JOB_IN_ATTEMPT = r"^attempt_(\d+_\d+)_"

# The event itself lies below the name of its class.
_EVENT = """
type string, event map<string, struct<attemptId: string, taskType: string, startTime: bigint,
  finishTime: bigint, trackerName: string, avataar: string, status: string, taskStatus: string, error: string,
  counters: struct<groups: array<struct<name: string, counts: array<struct<name: string, value: bigint>>>>>>>
"""


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Lines of history files below a folder."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def _counter(*names: str) -> Column:
    """Sum of the counters of these names over all groups; null if there is none."""
    counts = F.filter(F.col("counts"), lambda count: count["name"].isin(*names))
    total = F.aggregate(
        counts, F.lit(0).cast("bigint"), lambda sum_, count: sum_ + F.coalesce(count["value"], F.lit(0))
    )
    return F.when(F.size(counts) > 0, total)


def attempts(lines: DataFrame) -> DataFrame:
    """``MR_TASK_ATTEMPT`` with ``state``: one row per attempt, from all its events in one pass.

    ``state`` is SUCCEEDED, FAILED, KILLED, or RUNNING for attempts that never finish; these have no
    duration and no counters. Of repeated events the one with the least start and the greatest end
    counts. Lines that are no event, such as the head of a file, are left out, and so are ends of
    attempts whose start is not there.
    """
    event = F.from_json("value", _EVENT)
    parsed = lines.where(F.col("value").contains("_ATTEMPT_")).select(event.alias("e")).select(
        F.col("e.type").alias("type"), F.try_element_at(F.map_values("e.event"), F.lit(1)).alias("v")
    ).where(F.col("type").isin(*STARTED, *ENDED) & F.col("v.attemptId").isNotNull())
    shaped = parsed.select(
        "type", "v.*", F.flatten(F.col("v.counters.groups.counts")).alias("counts")
    )
    ended = F.when(F.col("type").isin(*ENDED), F.struct(
        F.col("finishTime").alias("end_ms"),
        F.coalesce("status", "taskStatus").alias("state"), "error",
        _counter(*READ_BYTES).alias("input_bytes"), _counter(*READ_RECORDS).alias("input_records"),
        _counter(GC).alias("gc_ms"), _counter(CPU).alias("cpu_ms"), _counter(PEAK).alias("peak_memory"),
        _counter(ALLOCATED).alias("allocated_memory"),
    ))
    started = F.when(F.col("type").isin(*STARTED), F.struct(
        F.col("startTime").alias("launch_ms"), F.col("taskType").alias("kind"),
        F.col("trackerName").alias("executor_id"),
        (F.coalesce("avataar", F.lit("")) == "SPECULATIVE").alias("speculative"),
    ))
    # The events of an attempt are brought together as they are: the aggregate below sorts its input,
    # and before the shuffle it would sort all events only to merge two at a time.
    events = shaped.select("attemptId", started.alias("s"), ended.alias("f")).repartition("attemptId")
    whole = events.groupBy("attemptId").agg(F.min("s").alias("s"), F.max("f").alias("f"))
    return whole.where("s is not null").select(
        F.concat(F.lit("job_"), F.regexp_extract("attemptId", JOB_IN_ATTEMPT, 1)).alias("app_id"),
        F.when(F.col("s.kind") == "MAP", 0).otherwise(1).alias("stage_id"),
        F.col("s.kind").alias("kind"), F.col("s.executor_id").alias("executor_id"),
        F.col("s.launch_ms").alias("launch_ms"),
        (F.col("f.end_ms") - F.col("s.launch_ms")).alias("duration_ms"),
        "f.input_bytes", "f.input_records", F.col("s.speculative").alias("speculative"),
        "f.gc_ms", "f.cpu_ms", "f.peak_memory", "f.allocated_memory",
        F.col("f.error").alias("failure_reason"),
        F.coalesce("f.state", F.lit("RUNNING")).alias("state"),
        F.col("attemptId").alias("attempt_id"),
    ).select(*MR_TASK_ATTEMPT.names, "state", "attempt_id")
