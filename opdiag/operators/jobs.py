"""Engine diagnoses over task, stage, job, plan and memory metrics of Spark and MapReduce jobs.

``STAGE`` keys give the Spark form of a diagnosis, ``KIND`` keys the MapReduce form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.defaults import Ours
from opdiag.functions.numbers import ratio
from opdiag.operators.intervals import idle_time
from opdiag.operators.medians import group_median
from opdiag.operators.sized import cut, join_lookup

APP = ("app_id",)
STAGE = ("app_id", "stage_id")
KIND = ("app_id", "kind")


def _far_above_median(
    tasks: DataFrame, keys: Sequence[str], value: str, threshold: float
) -> DataFrame:
    return (
        group_median(tasks, keys, value)
        .where(F.col("maximum") > threshold * F.col("median"))
        .select(
            *keys,
            F.col("n").alias("tasks"),
            F.col("maximum").alias(f"max_{value}"),
            F.col("median").alias(f"median_{value}"),
        )
    )


def data_skew(
    tasks: DataFrame, keys: Sequence[str] = STAGE, threshold: float = Ours.SKEW_RATIO
) -> DataFrame:
    """Groups whose largest task input is far above the median."""
    return _far_above_median(tasks, keys, "input_bytes", threshold)


def task_tail(
    tasks: DataFrame, keys: Sequence[str] = STAGE, threshold: float = Ours.TAIL_RATIO
) -> DataFrame:
    """Groups whose longest task runs far above the median."""
    return _far_above_median(tasks, keys, "duration_ms", threshold)


def hdfs_stall(tasks: DataFrame, threshold: float = Ours.STALL_SHARE) -> DataFrame:
    """Tasks that read far more slowly, in bytes per second, than the median of their stage.

    Tasks that read nothing, or whose input is not known, are no readers and do not count.
    """
    rate = F.floor(F.try_divide(F.col("input_bytes") * 1000, F.col("duration_ms"))).cast("bigint")
    rated = tasks.where(F.col("input_bytes") > 0).withColumn("rate", rate)
    medians, _ = cut(
        group_median(rated, STAGE, "rate").select(*STAGE, F.col("median").alias("median_rate"))
    )
    return (
        join_lookup(rated, medians, STAGE)
        .where(F.col("rate") < threshold * F.col("median_rate"))
        .select(*STAGE, "launch_ms", "duration_ms", "input_bytes", "rate", "median_rate")
    )


def speculation(
    tasks: DataFrame, keys: Sequence[str] = STAGE, threshold: float = Ours.SPECULATION_SHARE
) -> DataFrame:
    """Groups with too large a share of speculative attempts."""
    return (
        tasks.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("tasks"),
            F.count(F.when(F.col("speculative"), 1)).alias("speculative_tasks"),
        )
        .withColumn("speculative_share", ratio(F.col("speculative_tasks"), F.col("tasks")))
        .where(F.col("speculative_share") > threshold)
    )


def gc_anomaly(tasks: DataFrame, threshold: float = Ours.GC_SHARE) -> DataFrame:
    """Applications that spend too much time collecting garbage, relative to CPU time."""
    return (
        tasks.groupBy(*APP)
        .agg(F.sum("gc_ms").alias("gc_ms"), F.sum("cpu_ms").alias("cpu_ms"))
        .withColumn("gc_share", ratio(F.col("gc_ms"), F.col("cpu_ms")))
        .where(F.col("gc_share") > threshold)
    )


def memory_waste(tasks: DataFrame, threshold: float = Ours.MEMORY_USED_MIN) -> DataFrame:
    """Applications whose peak memory stays far below what they were given."""
    return (
        tasks.groupBy(*APP)
        .agg(
            F.max("peak_memory").alias("peak_memory"),
            F.max("allocated_memory").alias("allocated_memory"),
        )
        .withColumn("used_share", ratio(F.col("peak_memory"), F.col("allocated_memory")))
        .where(F.col("used_share") < threshold)
    )


def _role():
    return F.when(F.col("executor_id") == "driver", "driver").otherwise("executor").alias("role")


def cpu_waste(
    tasks: DataFrame, executors: DataFrame, threshold: float = Ours.CPU_USED_MIN
) -> DataFrame:
    """Applications whose cores mostly idle, for driver and executors apart.

    Both sides are summed per application and role before they meet.
    """
    busy = tasks.groupBy("app_id", _role()).agg(F.sum("duration_ms").alias("busy_ms"))
    offered = executors.groupBy("app_id", _role()).agg(
        F.sum(F.col("cores") * (F.col("end_ms") - F.col("start_ms"))).alias("core_ms")
    )
    return (
        offered.join(busy, ["app_id", "role"], "left")
        .withColumn("busy_ms", F.coalesce("busy_ms", F.lit(0).cast("bigint")))
        .withColumn("busy_share", ratio(F.col("busy_ms"), F.col("core_ms")))
        .where(F.col("busy_share") < threshold)
    )


def _executions(plans: DataFrame, pattern: str) -> DataFrame:
    """Executions with a plan line that matches."""
    return plans.where(F.col("plan").rlike(pattern)).select("app_id", "execution_id").distinct()


# How plan text prints an unrestricted scan and a global sort. The one-line form names
# empty partition filters; the formatted form leaves their line out of the scan's block.
OPEN_SCAN = (
    r"PartitionFilters: \[\]"
    r"|\([0-9]+\) Scan (?:parquet|orc|csv|json|text|hive)[^\n]*\n(?:(?!PartitionFilters)[^\n]+\n)*+\n"
)
GLOBAL_SORT = r"\[[^\n]*(?:ASC|DESC)[^\n]*\], true, [0-9]+"


def large_scan(
    tasks: DataFrame,
    stages: DataFrame,
    plans: DataFrame,
    min_rows: int = Ours.LARGE_SCAN_ROWS,
) -> DataFrame:
    """Stages that read too many rows for a plan with a scan without partition filter."""
    read = (
        tasks.groupBy(*STAGE)
        .agg(F.sum("input_records").alias("rows_read"))
        .where(F.col("rows_read") > min_rows)
    )
    open_stages = stages.join(
        _executions(plans, OPEN_SCAN), ["app_id", "execution_id"], "left_semi"
    ).select(*STAGE, "execution_id")
    return read.join(open_stages, list(STAGE))


def open_scans(stage_nodes: DataFrame, min_rows: int = Ours.LARGE_SCAN_ROWS) -> DataFrame:
    """Scans without a partition filter that put out too many rows, with the stage that ran them.

    ``stage_nodes`` ties plan nodes to stages (``sources.plangraph``), so that a pruned scan or
    another stage of the same execution is not blamed.
    """
    unlimited = F.coalesce(
        F.col("partition_filters") == "[]", F.col("detail").contains("PartitionFilters: []")
    )
    return stage_nodes.where(
        F.col("node").startswith("Scan ") & unlimited & (F.col("rows_out") > min_rows)
    ).select(*STAGE, "stage_attempt", "execution_id", "path", F.col("node").alias("scan"), "rows_out")


def sorting_stages(
    stage_nodes: DataFrame, stages: DataFrame, min_ms: int = Ours.SORT_STAGE_MS
) -> DataFrame:
    """Long stage attempts that ran a global sort themselves."""
    sorts = stage_nodes.where(
        (F.col("node") == "Sort") & F.col("detail").rlike(GLOBAL_SORT)
    ).select(*STAGE, "stage_attempt").distinct()
    return (
        stages.withColumn("duration_ms", F.col("end_ms") - F.col("submit_ms"))
        .where(F.col("duration_ms") > min_ms)
        .join(sorts, [*STAGE, "stage_attempt"], "left_semi")
        .select(*STAGE, "stage_attempt", "execution_id", "duration_ms")
    )


def mr_large_scan(tasks: DataFrame, min_rows: int = Ours.LARGE_SCAN_ROWS) -> DataFrame:
    """Jobs that read too many rows."""
    return (
        tasks.groupBy(*APP)
        .agg(F.sum("input_records").alias("rows_read"))
        .where(F.col("rows_read") > min_rows)
    )


def broadcast_oom_risk(
    broadcasts: DataFrame, memory: DataFrame, threshold: float = Ours.BROADCAST_SHARE
) -> DataFrame:
    """Applications whose broadcasts add up to much of the smaller of driver and executor memory."""
    total = broadcasts.groupBy("app_id").agg(F.sum("bytes").alias("broadcast_bytes"))
    return (
        total.join(memory, "app_id")
        .withColumn("memory", F.least("driver_memory", "executor_memory"))
        .withColumn("broadcast_share", ratio(F.col("broadcast_bytes"), F.col("memory")))
        .where(F.col("broadcast_share") > threshold)
        .select("app_id", "broadcast_bytes", "memory", "broadcast_share")
    )


def global_sort(
    stages: DataFrame, plans: DataFrame, min_ms: int = Ours.SORT_STAGE_MS
) -> DataFrame:
    """Long stages of executions whose plan sorts globally."""
    return (
        stages.withColumn("duration_ms", F.col("end_ms") - F.col("submit_ms"))
        .where(F.col("duration_ms") > min_ms)
        .join(_executions(plans, GLOBAL_SORT), ["app_id", "execution_id"], "left_semi")
        .select("app_id", "stage_id", "execution_id", "duration_ms")
    )


def _idle(
    spans: DataFrame, intervals: DataFrame, keys: Sequence[str], threshold: float
) -> DataFrame:
    return (
        idle_time(spans, intervals, keys)
        .withColumn("idle_share", ratio(F.col("idle_ms"), F.col("total_ms")))
        .where(F.col("idle_share") > threshold)
    )


def _span(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.select(
        *keys, F.col("submit_ms").alias("span_start"), F.col("end_ms").alias("span_end")
    )


def job_idle(
    jobs: DataFrame, stages: DataFrame, threshold: float = Ours.IDLE_SHARE
) -> DataFrame:
    """Jobs during much of whose time no stage was running."""
    keys = ["app_id", "job_id"]
    running = stages.select(*keys, F.col("submit_ms").alias("start_ms"), "end_ms")
    return _idle(_span(jobs, keys), running, keys, threshold)


def stage_idle(
    stages: DataFrame, tasks: DataFrame, threshold: float = Ours.IDLE_SHARE
) -> DataFrame:
    """Stages during much of whose time no task was running."""
    running = tasks.select(
        *STAGE,
        F.col("launch_ms").alias("start_ms"),
        (F.col("launch_ms") + F.col("duration_ms")).alias("end_ms"),
    )
    return _idle(_span(stages, STAGE), running, STAGE, threshold)


def failures(tasks: DataFrame, pattern: str) -> DataFrame:
    """Failed tasks per stage whose reason matches, with the earliest launch and one reason."""
    return (
        tasks.where(F.col("failure_reason").rlike(pattern))
        .groupBy(*STAGE)
        .agg(
            F.count(F.lit(1)).alias("failed_tasks"),
            F.min("launch_ms").alias("first_launch_ms"),
            F.min("failure_reason").alias("failure_reason"),
        )
    )


def sql_failures(tasks: DataFrame, pattern: str = Ours.SQL_FAILURE) -> DataFrame:
    return failures(tasks, pattern)


def unit_failures(failed: DataFrame, pattern: str) -> DataFrame:
    """Jobs, SQL executions and executors (``APP_FAILURE``) whose reason matches."""
    return failed.where(F.col("failure_reason").rlike(pattern))


def shuffle_failures(tasks: DataFrame, pattern: str = Ours.SHUFFLE_FAILURE) -> DataFrame:
    return failures(tasks, pattern)


def oom_failures(tasks: DataFrame, pattern: str = Ours.OOM_FAILURE) -> DataFrame:
    return failures(tasks, pattern)
