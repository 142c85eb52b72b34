"""The daily and hourly jobs, from source to published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag import schemas
from opdiag.functions.classes import as_date
from opdiag.operators import baselines, closure, containers, lineage, runs, storage
from opdiag.operators.sized import cut
from opdiag.sinks import ledger, relations, tables
from opdiag.sources import fsimage, logs

REPORTS = {
    "hdfs_storage": storage.dir_storage_report,
    "hive_storage_dir": storage.warehouse_storage_report,
    "hdfs_storage_user": storage.user_storage_share,
}


def storage_day(
    spark: SparkSession, listing: str, day: str, as_of: str, database: str = "default"
) -> None:
    """Loads a listing, flattens it, and publishes the three reports and their exports.

    ``day`` is the snapshot's ``yyyyMMdd`` partition. The flattened table is written once; the
    reports read only its partition and the few columns they need.
    """
    ods, dwd = f"{database}.ods_fsimage", f"{database}.dwd_fsimage"
    tables.overwrite_partitions(fsimage.read_listing(spark, listing, day), ods, compact=False)
    flattened = storage.flatten_listing(spark.table(ods), day)
    tables.overwrite_partitions(flattened, dwd, compact=False)
    flat = fsimage.snapshot(spark.table(dwd), day)
    for name, report in REPORTS.items():
        table = f"{database}.{name}"
        tables.overwrite_partitions(
            report(flat, as_of).withColumn("partition_key", F.lit(day)), table
        )
        tables.publish_export(spark, table, f"{table}_export")


def lineage_day(
    definitions: DataFrame,
    projects: DataFrame,
    day: str,
    start_process: str,
    folder: str,
    task_table: str,
    resolve: str = "strict",
) -> None:
    """Writes the six lineage relations and upserts the tasks upstream of a process.

    The relations have every edge as defined, also of sub-process tasks and to tasks that do not
    exist; which ends exist is decided where they are loaded, as for the closure here.
    """
    released = lineage.released_definitions(definitions, projects, day)
    # both are read several times below, so they are written once
    tasks, _ = cut(lineage.workflow_tasks(released))
    edges, _ = cut(lineage.lineage_edges(released, resolve))
    raw = lineage.edge_dedupe(lineage.all_edges(released, "raw"))
    relations.write_relations(relations.lineage_relations(released, tasks, raw), folder)
    found = closure.upstream_closure(
        tasks.where(F.col("task_type") == lineage.SHELL), released, edges, start_process, day
    ).withColumn("insert_time", F.current_timestamp().cast("timestamp_ntz"))
    tables.upsert(found, task_table, ["dt", "project_id", "process_id", "task_id"])


def run_time_day(
    monitored: DataFrame,
    instances: DataFrame,
    definitions: DataFrame,
    projects: DataFrame,
    today: str,
    lastday: str,
    table: str,
) -> None:
    """Appends the day-over-day report of the monitored tasks."""
    report = runs.key_task_day_over_day(
        monitored, instances, definitions, projects, today, lastday
    )
    tables.append(report, table, schemas.DEPTASKS)


def baseline_day(
    runs: DataFrame,
    day: str,
    state_table: str,
    duration_table: str,
    end_time_table: str,
    folder: str | None = None,
) -> None:
    """Judges one day's runs against the state before it, and writes verdicts and the new state.

    ``runs`` is partitioned by ``dt``; only the day's partition and the newest earlier state are
    read. Without any state all earlier runs are folded into one first. Judging a day again gives
    the same rows, since every day's state has its own partition; days come in order of time. New
    tables lie below ``folder``, by default in the warehouse.
    """
    spark = runs.sparkSession
    earlier = [key for key in tables.partition_values(spark, state_table, "dt") if key < day]
    if earlier:
        state = spark.table(state_table).where(F.col("dt") == max(earlier)).drop("dt")
    else:
        state = baselines.state_of(runs.where(F.col("dt") < as_date(day)))
        state, _ = cut(state)
    today = runs.where(F.col("dt") == as_date(day))
    for table, judge in (
        (duration_table, baselines.day_duration_anomalies),
        (end_time_table, baselines.day_end_time_anomalies),
    ):
        verdicts = judge(state, today).withColumn("dt", F.lit(day))
        tables.overwrite_partitions(verdicts, table, ["dt"], location=_below(folder, table))
    new = baselines.next_state(state, today).withColumn("dt", F.lit(day))
    tables.overwrite_partitions(new, state_table, ["dt"], location=_below(folder, state_table))


def _below(folder: str | None, table: str) -> str | None:
    return None if folder is None else f"{folder}/{table}"


KINDS = {
    logs.NODE_MANAGER: containers.nm_container_transitions,
    logs.RESOURCE_MANAGER: containers.rm_container_transitions,
}
_CHANGE = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schemas.CONTAINER_STATE)


def log_hour(
    spark: SparkSession,
    folder: str,
    hour: str,
    target: str,
    zone: str = "UTC",
    all_files: bool = False,
) -> int:
    """Loads container state changes up to one clock hour; ``hour`` is ``yyyy-MM-dd HH``.

    Files that were loaded before and have not changed since are not read again, so an hour can be
    run any number of times; lines that arrive after their hour are loaded by the next run. Lines of
    later hours are left for theirs. Files that have not changed since the hour began, in the session
    time zone, hold none of its lines and are left out; ``all_files`` takes them too, after runs that
    were missed. Returns the number of files read; ``logged`` has the rows.
    """
    files, since = 0, None if all_files else hour.replace(" ", "T") + ":00:00"
    for kind, parse in KINDS.items():
        found = ledger.listed(spark, folder, f"*{kind}*", since)

        def read(names: list[str], parse=parse) -> DataFrame:
            lines = logs.lines_of_files(spark, names)
            return parse(lines, zone, keep=["file"]).withColumn(
                "part", F.left("change_time", F.lit(13))
            ).where(F.col("part") <= hour)

        files += ledger.load_new(spark, found, read, f"{target}/{kind}", hour)
    return files


def logged(
    spark: SparkSession, target: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Loaded container state changes, optionally of the hours from ``since`` to ``until``."""
    frames = []
    for kind in KINDS:
        rows = ledger.loaded(spark, f"{target}/{kind}", _CHANGE)
        if since is not None:
            rows = rows.where(F.col("part") >= since)
        if until is not None:
            rows = rows.where(F.col("part") <= until)
        frames.append(rows.select(*schemas.CONTAINER_STATE.names))
    return frames[0].unionByName(frames[1])
