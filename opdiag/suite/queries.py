"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag import flows, schemas
from opdiag.defaults import Ours
from opdiag.functions.paths import in_warehouse
from opdiag.operators import (
    ageing,
    closure,
    containers,
    jobs,
    lineage,
    retention,
    runs,
    storage,
    warehouse,
)
from opdiag.operators.sized import cut
from opdiag.plans import scans
from opdiag.session import scratch_path
from opdiag.sinks import compaction, keyed, relations, tables
from opdiag.sources import eventlog, fsimage, jobhistory, logs, plangraph, scheduler
from opdiag.streaming import containers as streams
from opdiag.suite import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.flatten_listing(fx.fsimage(spark, sf_dir), fx.PARTITION)


def _tables_only(flat: DataFrame) -> DataFrame:
    return flat.where(in_warehouse(F.col("p3")))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.dir_storage_report(_flat(spark, sf_dir), fx.AS_OF)


STORAGE: dict[str, Query] = {
    "fsimage_flatten": _flat,
    "file_class_by_dir": lambda s, d: storage.file_class_by_dir(_flat(s, d), fx.AS_OF),
    "dir_storage_report": _report,
    "warehouse_storage_report": lambda s, d: storage.warehouse_storage_report(
        _flat(s, d), fx.AS_OF
    ),
    "user_storage_share": lambda s, d: storage.user_storage_share(_flat(s, d), fx.AS_OF),
    "small_file_ratio": lambda s, d: storage.small_file_ratio(_flat(s, d), fx.AS_OF),
    "cold_data_ratio": lambda s, d: storage.cold_data_ratio(_flat(s, d), fx.AS_OF),
    "small_file_ratio_table": lambda s, d: storage.small_file_ratio(
        _tables_only(_flat(s, d)), fx.AS_OF, by=("p4", "p5")
    ),
    "cold_data_ratio_table": lambda s, d: storage.cold_data_ratio(
        _tables_only(_flat(s, d)), fx.AS_OF, by=("p4", "p5")
    ),
    "stale_warehouse_files": lambda s, d: ageing.stale_warehouse_files(_flat(s, d), fx.AS_OF),
    "old_partition_touched": lambda s, d: ageing.old_partition_touched(_flat(s, d), fx.AS_OF),
}

PLANS: dict[str, Query] = {
    "plan_scan_cardinality": lambda s, d: scans.plan_scan_cardinality(
        fx.query_record(s, d), "1990-01-01 00:00:00", "2010-12-31 23:59:59"
    ),
    "sr_query_frequency": lambda s, d: scans.query_frequency(fx.query_record(s, d)),
}


def _streamed(lines: Callable, parse: Callable) -> Query:
    """Log lines go through files, the stream and its sink, and come back as a table.

    The second half of the day arrives before the first one, in a run of its own.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark, "container-stream")
        early = F.substring("value", 12, 2) < "12"
        for part in (lines(spark, sf_dir).where(~early), lines(spark, sf_dir).where(early)):
            part.write.mode("append").partitionBy("server_ip").text(f"{folder}/lines")
            tagged = spark.readStream.schema("value string, server_ip string").text(f"{folder}/lines")
            streams.collect_changes(
                tagged, parse, f"{folder}/changes", f"{folder}/progress"
            ).awaitTermination()
        return streams.published(spark, f"{folder}/changes")

    return run


def _deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of the stream with state: the afternoons, the mornings, then all lines again."""
    folder = scratch_path(spark, "container-state")
    lines = fx.rm_log(spark, sf_dir)
    morning = F.substring("value", 12, 2) < "12"
    for part in (lines.where(~morning), lines.where(morning), lines):
        part.write.mode("append").partitionBy("server_ip").text(f"{folder}/lines")
        tagged = spark.readStream.schema("value string, server_ip string").text(f"{folder}/lines")
        streams.collect_distinct(
            tagged, containers.rm_container_transitions, f"{folder}/changes", f"{folder}/progress",
            part=F.right("container_id", F.lit(1)),
        ).awaitTermination()
    changes = f"{folder}/changes"
    return streams.on_time(spark, changes).withColumn("late", F.lit(False)).unionByName(
        streams.late_changes(spark, changes).withColumn("late", F.lit(True))
    )


LOGS: dict[str, Query] = {
    "rm_container_transitions": lambda s, d: containers.rm_container_transitions(fx.rm_log(s, d)),
    "nm_container_transitions": lambda s, d: containers.nm_container_transitions(fx.nm_log(s, d)),
    "rm_hour_transitions": lambda s, d: containers.rm_container_transitions(
        containers.of_hour(fx.rm_log(s, d), "2024-01-05 10")
    ),
    "rm_container_stream": _streamed(fx.rm_log, containers.rm_container_transitions),
    "nm_container_stream": _streamed(fx.nm_log, containers.nm_container_transitions),
    "rm_container_stream_state": _deduplicated,
}


def _closure(resolve: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        definitions = fx.released(spark, sf_dir)
        return closure.upstream_closure(
            lineage.workflow_tasks(definitions).where(F.col("task_type") == lineage.SHELL),
            definitions,
            lineage.lineage_edges(definitions, resolve),
            fx.START_PROCESS,
            fx.DEFINITIONS_DT,
        )

    return run


LINEAGE: dict[str, Query] = {
    "workflow_tasks": lambda s, d: lineage.workflow_tasks(fx.released(s, d)),
    "rejected_definitions": lambda s, d: lineage.rejected_definitions(_broken(s, d)).drop(
        "process_definition_json"
    ),
    "rejected_pre_tasks": lambda s, d: lineage.rejected_pre_tasks(fx.released(s, d)),
    "task_lineage_rows": lambda s, d: lineage.task_lineage_rows(
        fx.released(s, d), fx.DEFINITIONS_DT
    ),
    "lineage_edges": lambda s, d: lineage.lineage_edges(fx.released(s, d)),
    "lineage_edges_extended": lambda s, d: lineage.lineage_edges(fx.released(s, d), "extended"),
    "mutual_edges": lambda s, d: lineage.mutual_edges(
        lineage.lineage_edges(fx.released(s, d), "extended")
    ),
    "edge_dedupe": lambda s, d: lineage.edge_dedupe(
        lineage.all_edges(fx.released(s, d), "extended")
    ),
    "upstream_closure": _closure("strict"),
    "upstream_closure_extended": _closure("extended"),
}


def _day_over_day(match_project: bool) -> Query:
    return lambda s, d: runs.key_task_day_over_day(
        fx.monitored_task(s, d), fx.task_instance(s, d), fx.process_definition(s, d),
        fx.project(s, d), fx.TODAY, fx.LASTDAY, match_project,
    )


RUNS: dict[str, Query] = {
    "key_task_day_over_day": _day_over_day(False),
    "key_task_day_over_day_by_project": _day_over_day(True),
    "wf_final_failure": lambda s, d: runs.final_failures(fx.workflow_run(s, d)),
    "wf_first_failure": lambda s, d: runs.first_failures(fx.workflow_run(s, d)),
    "wf_long_failure": lambda s, d: runs.long_failures(fx.workflow_run(s, d), "2024-01-30"),
    "wf_end_time_anomaly": lambda s, d: runs.end_time_anomalies(fx.workflow_run(s, d)),
    "wf_duration_anomaly": lambda s, d: runs.duration_anomalies(fx.workflow_run(s, d)),
    "wf_long_running": lambda s, d: runs.long_running(fx.workflow_run(s, d)),
}

BASELINE_DAYS = ("2024-01-28", "2024-01-29", "2024-01-30")


_JUDGED: dict[tuple, str] = {}


def _daily(anomaly: str) -> Query:
    """Verdicts of three days, each judged from the state that the day before it left.

    Both verdicts come from the same updates, which run once per application.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _JUDGED:
            folder, mark = scratch_path(spark, "baselines"), uuid.uuid4().hex[:8]
            fx.workflow_run(spark, sf_dir).write.partitionBy("dt").parquet(f"{folder}/runs")
            stored = spark.read.schema(schemas.WORKFLOW_RUN).parquet(f"{folder}/runs")
            names = [f"{name}_{mark}" for name in ("run_state", "duration_anomaly", "end_time_anomaly")]
            for day in BASELINE_DAYS:
                flows.baseline_day(stored, day, *names, folder)
            _JUDGED[key] = mark
        verdicts = spark.table(f"{anomaly}_{_JUDGED[key]}")
        return verdicts.withColumn("dt", F.col("dt").cast("date"))

    return run


RUNS |= {
    "wf_end_time_anomaly_daily": _daily("end_time_anomaly"),
    "wf_duration_anomaly_daily": _daily("duration_anomaly"),
}

# The default of five would select nearly every stage of these inputs.
_FAR = 40

JOBS: dict[str, Query] = {
    "spark_sql_failure": lambda s, d: jobs.sql_failures(fx.job_task(s, d)),
    "spark_shuffle_failure": lambda s, d: jobs.shuffle_failures(fx.job_task(s, d)),
    "spark_oom": lambda s, d: jobs.oom_failures(fx.job_task(s, d)),
    "spark_memory_waste": lambda s, d: jobs.memory_waste(fx.job_task(s, d)),
    "spark_cpu_waste": lambda s, d: jobs.cpu_waste(fx.job_task(s, d), fx.app_executor(s, d)),
    "spark_large_scan": lambda s, d: jobs.large_scan(
        fx.job_task(s, d), fx.app_stage(s, d), fx.app_plan(s, d)
    ),
    "spark_broadcast_oom_risk": lambda s, d: jobs.broadcast_oom_risk(
        fx.app_broadcast(s, d), fx.app_memory(s, d)
    ),
    "spark_data_skew": lambda s, d: jobs.data_skew(fx.job_task(s, d), threshold=_FAR),
    "spark_job_idle": lambda s, d: jobs.job_idle(fx.app_job(s, d), fx.job_stage(s, d)),
    "spark_stage_idle": lambda s, d: jobs.stage_idle(fx.sparse_stage(s, d), fx.sparse_task(s, d)),
    "spark_task_tail": lambda s, d: jobs.task_tail(fx.job_task(s, d), threshold=_FAR),
    "spark_hdfs_stall": lambda s, d: jobs.hdfs_stall(fx.job_task(s, d)),
    "spark_speculation": lambda s, d: jobs.speculation(fx.job_task(s, d)),
    "spark_global_sort": lambda s, d: jobs.global_sort(fx.app_stage(s, d), fx.app_plan(s, d)),
    "mr_memory_waste": lambda s, d: jobs.memory_waste(_attempt_lines(s, d)),
    "mr_large_scan": lambda s, d: jobs.mr_large_scan(fx.job_task(s, d)),
    "mr_task_tail": lambda s, d: jobs.task_tail(fx.job_task(s, d), jobs.KIND, _FAR),
    "mr_data_skew": lambda s, d: jobs.data_skew(fx.job_task(s, d), jobs.KIND, _FAR),
    "mr_speculation": lambda s, d: jobs.speculation(fx.job_task(s, d), jobs.KIND),
    "mr_gc_anomaly": lambda s, d: jobs.gc_anomaly(fx.job_task(s, d)),
}

RETENTION_AS_OF = "2000-07-01"
MONTHS_AS_OF = "2001-08-15"  # in the last month of the given tables
TASK_KEY = ("dt", "project_id", "process_id", "task_id")

TABLES: dict[str, Query] = {
    "sr_bucket_size": lambda s, d: warehouse.tablet_size_anomaly(fx.tablet(s, d)),
    "sr_partition_size": lambda s, d: warehouse.partition_size_anomaly(fx.tablet(s, d)),
    "sr_load_profile": lambda s, d: warehouse.load_profile(fx.load_job(s, d)),
    "expired_partitions": lambda s, d: retention.expired_partitions(
        fx.partition_list(s, d), RETENTION_AS_OF
    ),
    "retained_partitions": lambda s, d: retention.retained(
        fx.partition_list(s, d), RETENTION_AS_OF
    ),
    "month_partition": lambda s, d: retention.retained_months(
        retention.month_partition(fx.partition_list(s, d)), RETENTION_AS_OF
    ),
    "month_partition_plan": lambda s, d: retention.month_plan(
        retention.month_partition(fx.partition_list(s, d)), MONTHS_AS_OF
    ),
    "export_history": lambda s, d: retention.export_history(
        _report(s, d).withColumn("partition_key", F.lit(fx.PARTITION))
    ),
    "upsert_latest": lambda s, d: retention.upsert_latest(
        fx.task_version(s, d, False), fx.task_version(s, d, True), TASK_KEY
    ),
}



def _listing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing goes through a delimited file, header lines included."""
    folder = scratch_path(spark, "listing")
    _listing_lines(fx.fsimage(spark, sf_dir)).write.text(folder)
    return storage.flatten_listing(
        fsimage.read_listing(spark, folder, fx.PARTITION), fx.PARTITION
    )


def _listing_lines(rows: DataFrame) -> DataFrame:
    """Lines as the listing tool prints them: no quotes, nothing for a missing value."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in schemas.FSIMAGE_FILE.names]
    return rows.select(F.concat_ws(",", *fields).alias("value"))


def _odd_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose path holds delimiters or whose size is no number, through a listing file."""
    folder = scratch_path(spark, "listing")
    odd = fx.fsimage(spark, sf_dir).withColumns({
        "path": F.concat("path", F.lit(",a,"), F.col("blockscount").cast("string")),
        "nsquota": F.when(F.col("blockscount") == 2, "none").otherwise(F.col("nsquota").cast("string")),
    })
    _listing_lines(odd).write.text(folder)
    return fsimage.read_listing(spark, folder, fx.PARTITION).drop("partition_key")


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions of which every ninth was cut off."""
    text = F.col("process_definition_json")
    cut_off = F.when(F.col("process_id") % 9 == 0, F.left(text, F.length(text) - 3)).otherwise(text)
    return fx.released(spark, sf_dir).withColumn("process_definition_json", cut_off)


def _relation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six relations go through their files; node relations give their id only."""
    folder = scratch_path(spark, "relations")
    definitions = fx.released(spark, sf_dir)
    edges, _ = cut(lineage.edge_dedupe(lineage.all_edges(definitions, "raw")))
    frames = relations.lineage_relations(definitions, lineage.workflow_tasks(definitions), edges)
    relations.write_relations(frames, folder)
    read = []
    for name, (delimiter, columns) in relations.RELATIONS.items():
        frame = scheduler.read_relation(
            spark, f"{folder}/{name}", relations.schema_of(name), delimiter
        )
        if len(columns) != 3:
            none = F.lit(None).cast("string")
            frame = frame.select(f"{name}_id", none.alias("label"), none.alias("dst_id"))
        read.append(frame.toDF("src_id", "label", "dst_id").withColumn("name", F.lit(name)))
    return reduce(DataFrame.unionByName, read)


# Lines of a written log, after which its next file begins: text is many times its compressed size.
_LOG_LINES = 1_000_000
_SORTED_BYTES = 2**24  # shuffled bytes that a task sorts
_LOG_LEVEL = 1  # of compression; higher ones take several times as long for little


def _write_lines(lines: DataFrame, folder: str, by: tuple[str, ...] = ()) -> None:
    """Compressed text files of bounded length."""
    (
        lines.write.partitionBy(*by).option("compression", "gzip")
        .option("maxRecordsPerFile", _LOG_LINES).text(folder)
    )


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task events go through log files named by application."""
    folder = scratch_path(spark, "events")
    # few applications: their files are open at once, in place of a sort of all lines
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "16")
    try:
        _write_lines(fx.task_end_events(spark, sf_dir), folder, ("app",))
    finally:
        spark.conf.set(key, before)
    return eventlog.tasks(eventlog.read_lines(spark, folder)).drop("allocated_memory")


def _write_logs(lines: DataFrame, folder: str) -> None:
    """Writes ``value`` to compressed logs in one folder, named by ``app``, one per application.

    An application's lines meet in one task. Spark's own writer would make a folder per application
    and set the rights of every folder and file, each in a process of its own on a local disk, which
    takes longer than all lines. Lines are written as the bytes that a batch holds them in. Tasks
    that are run again write the same files.
    """
    most, shared = _LOG_LINES, folder if "://" in folder or folder.startswith("file:/") else f"file://{folder}"

    def write(batches):
        from contextlib import ExitStack
        from gzip import GzipFile

        import numpy as np
        from pyarrow import RecordBatch, compute, fs, large_binary

        store, base = fs.FileSystem.from_uri(shared)
        open_app, log, n, number = None, None, 0, 0
        with ExitStack() as files:
            for batch in batches:
                lines = batch.column(0).cast(large_binary())
                _, offsets, text = lines.buffers()
                ends = np.frombuffer(offsets, np.int64)[lines.offset : lines.offset + len(lines) + 1]
                runs = compute.run_end_encode(batch.column(1))
                first = 0
                for end, app in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                    app = app or "__HIVE_DEFAULT_PARTITION__"
                    if app != open_app or n >= most:
                        files.close()
                        number = number + 1 if app == open_app else 0
                        open_app, n = app, 0
                        path = f"{base}/app={app}.{number}.gz"
                        raw = files.enter_context(store.open_output_stream(path, compression=None))
                        log = files.enter_context(GzipFile("", "wb", _LOG_LEVEL, raw, mtime=0))
                    log.write(memoryview(text)[ends[first] : ends[end]])
                    n, first = n + end - first, end
        yield RecordBatch.from_pydict({"done": [True]})

    spark = lines.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    line = F.concat(F.coalesce("value", F.lit("")), F.lit("\n")).alias("value")
    # a task sorts its part as text, which is several times as large as what is shuffled
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(_SORTED_BYTES))
    try:
        (
            lines.repartition("app").sortWithinPartitions("app").select(line, "app")
            .mapInArrow(write, "done boolean").agg(F.count(F.lit(1))).collect()
        )
    finally:
        spark.conf.set(key, before)


_LANDED: dict[tuple, str] = {}


def _landed(table: Callable[[DataFrame], DataFrame], events: Callable = fx.app_events) -> Query:
    """Events go through log files and the landed partitions.

    Rows over the same events share one landing per application: every further one finds that no
    log file is new.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, events.__name__)
        if key not in _LANDED:
            folder = scratch_path(spark, "events")
            _write_logs(events(spark, sf_dir), f"{folder}/logs")
            _LANDED[key] = folder
        folder = _LANDED[key]
        eventlog.land_new(spark, f"{folder}/logs", f"{folder}/landed")
        return table(eventlog.landed_new(spark, f"{folder}/landed"))

    return run


def _stage_nodes(lines: DataFrame) -> DataFrame:
    return plangraph.stage_nodes(plangraph.plan_nodes(lines), plangraph.stage_accumulators(lines))


def _planned(table: Callable[[DataFrame], DataFrame]) -> Query:
    return _landed(table, fx.plan_events)


def _by_name(spark: SparkSession, lines: DataFrame, folder: str) -> None:
    """Writes one log file per name (``host``), in a task of its own; it replaces an older one."""
    arrived = scratch_path(spark, "arrived")
    lines.repartition("host").write.partitionBy("host").text(arrived)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    files = paths(arrived).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(paths(folder))
    for status in files.globStatus(paths(f"{arrived}/host=*/part-*")):
        path = status.getPath()
        named = paths(f"{folder}/{path.getParent().getName().removeprefix('host=')}")
        files.delete(named, False)
        files.rename(path, named)


_ROLLED = 32  # files per host


def _host_files(spark: SparkSession, lines: DataFrame, kind: str, folder: str) -> None:
    """The log of a host is rolled: a line's file depends on the line alone, so files only grow."""
    rolled = (F.crc32("value") % _ROLLED).cast("string")
    host = F.concat(F.lit(f"{kind}-"), "server_ip", F.lit(".log."), rolled).alias("host")
    _by_name(spark, lines.select("value", host), folder)


def _files_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node-manager lines by file name; resource-manager files and one that is too old stay out."""
    folder = scratch_path(spark, "log-files")
    _host_files(spark, fx.nm_log(spark, sf_dir), logs.NODE_MANAGER, folder)
    _host_files(spark, fx.rm_log(spark, sf_dir), logs.RESOURCE_MANAGER, folder)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{logs.NODE_MANAGER}-nm-host-0.log.*")
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(old):
        files.setTimes(status.getPath(), 946684800000, -1)  # 2000
    lines = logs.read_lines(spark, folder, logs.NODE_MANAGER, "2020-01-01T00:00:00")
    return containers.nm_container_transitions(lines)


LOG_HOURS = ("2024-01-05 10", "2024-01-05 10", "2024-01-30 23", "2024-01-30 23")


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hour is loaded twice; then one host's file arrives late, another's has grown.

    The third run loads all hours that are left, the fourth finds nothing new.
    """
    folder = scratch_path(spark, "log-hours")
    parts = {
        logs.NODE_MANAGER: fx.nm_log(spark, sf_dir), logs.RESOURCE_MANAGER: fx.rm_log(spark, sf_dir)
    }
    first, second = F.col("server_ip").endswith("0"), F.col("server_ip").endswith("1")
    arrivals = {
        0: first | (second & (F.col("value") < "2024-01-04")),
        2: ~first,
    }
    for number, hour in enumerate(LOG_HOURS):
        if number in arrivals:
            for kind, lines in parts.items():
                _host_files(spark, lines.where(arrivals[number]), kind, f"{folder}/logs")
        flows.log_hour(spark, f"{folder}/logs", hour, f"{folder}/loaded")
    return flows.logged(spark, f"{folder}/loaded")


def _attempt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task attempts go through JSON lines."""
    folder = scratch_path(spark, "attempts")
    fx.job_task(spark, sf_dir).write.json(folder)
    return scheduler.read_attempts(spark, folder)


def _table_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:8]}"


def _overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of three partitions is written a second time."""
    name, place = _table_name("tablet"), scratch_path(spark, "tablet")
    rows = fx.tablet(spark, sf_dir).withColumn("pt", (F.col("tablet_id") % 3).cast("int"))
    tables.overwrite_partitions(rows, name, ["pt"], location=place)
    again = rows.where("pt = 1").withColumn("bytes", F.col("bytes") + 1)
    tables.overwrite_partitions(again, name, ["pt"], compact=False)
    return spark.table(name)


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's table gets a second day, and its export is made anew from both."""
    name, export, place = _table_name("report"), _table_name("export"), scratch_path(spark, "report")
    report, _ = cut(_report(spark, sf_dir))
    for day in (fx.PARTITION, "20111106"):
        rows = report.withColumn("partition_key", F.lit(day))
        tables.overwrite_partitions(rows, name, location=f"{place}/report")
        tables.publish_export(spark, name, export, location=f"{place}/export")
    return spark.table(export)


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, place = _table_name("loads"), scratch_path(spark, "loads")
    rows = fx.tablet(spark, sf_dir)
    for part in (rows.where("tablet_id % 2 = 0"), rows.where("tablet_id % 2 = 1")):
        tables.append(part, name, schemas.TABLET, location=place)
    return spark.table(name)


def _newest_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three listings of growing length arrive, in part files; the newest one is loaded."""
    folder = scratch_path(spark, "listings")
    whole = fx.fsimage(spark, sf_dir)
    for number, rows in enumerate((whole.where("blockscount = 1"), whole.where("blockscount < 3"), whole)):
        _listing_lines(rows).write.text(f"{folder}/fsimage_{number}.csv")
    newest = fsimage.newest_file(spark, folder, "fsimage_*")
    return fsimage.read_listing(spark, newest, fx.PARTITION).drop("partition_key")


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of many small files, and what it holds after they were merged."""
    folder = scratch_path(spark, "small-files")
    rows = fx.tablet(spark, sf_dir).withColumn("pt", (F.col("tablet_id") % 3).cast("int"))
    rows.repartition(40).write.partitionBy("pt").parquet(folder)
    compaction.compact(spark, folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three upserts with repeated keys, the last one with NULL days, and a fold before it."""
    first, second = fx.task_version(spark, sf_dir, False), fx.task_version(spark, sf_dir, True)
    hours = lambda n: F.timestamp_add("HOUR", F.lit(n), "insert_time")
    table = keyed.KeyedTable(
        spark, _table_name("task_version"), scratch_path(spark, "keyed"), TASK_KEY, buckets=16
    )
    table.create(first)
    table.upsert(second)
    table.upsert(first.where("task_id = '1'").withColumn("insert_time", hours(2)))
    table.fold()
    table.upsert(second.withColumn("dt", F.lit(None).cast("date")).withColumn("insert_time", hours(3)))
    return table.read()


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "history")
    _write_lines(fx.job_history(spark, sf_dir), folder)
    return jobhistory.attempts(jobhistory.read_history(spark, folder))


FILES: dict[str, Query] = {
    "table_partitions_overwritten": _overwritten,
    "table_exported": _exported,
    "table_appended": _appended,
    "newest_listing": _newest_listing,
    "files_compacted": _compacted,
    "keyed_table": _keyed,
    "mr_job_history": _history,
    "fsimage_csv_load": _listing_file,
    "listing_odd_paths": _odd_paths,
    "lineage_relation_files": _relation_files,
    "task_json_rows": lambda s, d: relations.json_rows(lineage.workflow_tasks(fx.released(s, d))),
    "event_log_tasks": _event_log,
    "event_log_stages": _landed(eventlog.stages),
    "event_log_stage_jobs": _landed(eventlog.stage_jobs),
    "event_log_jobs": _landed(eventlog.jobs),
    "event_log_executors": _landed(eventlog.executors),
    "event_log_memory": _landed(eventlog.memory),
    "job_failure": _landed(eventlog.job_failures),
    "sql_execution_failure": _landed(
        lambda lines: jobs.unit_failures(eventlog.sql_execution_failures(lines), Ours.SQL_FAILURE)
    ),
    "executor_oom": _landed(
        lambda lines: jobs.unit_failures(eventlog.executor_losses(lines), Ours.OOM_FAILURE)
    ),
    "mr_attempt_lines": _attempt_lines,
    "event_log_plan_nodes": _planned(plangraph.plan_nodes),
    "event_log_stage_nodes": _planned(_stage_nodes),
    "event_log_plans": _planned(eventlog.plans),
    "event_log_broadcasts": _planned(eventlog.broadcasts),
    "event_log_broadcast_risk": _planned(lambda lines: jobs.broadcast_oom_risk(
        eventlog.broadcasts(lines), eventlog.memory(lines)
    )),
    "spark_open_scan": _planned(lambda lines: jobs.open_scans(_stage_nodes(lines))),
    "spark_sorting_stage": _planned(
        lambda lines: jobs.sorting_stages(_stage_nodes(lines), eventlog.stages(lines))
    ),
    "log_hour_repeated": _hours,
    "log_files_by_name": _files_by_name,
}

QUERIES: dict[str, Query] = {**STORAGE, **PLANS, **LOGS, **LINEAGE, **RUNS, **JOBS, **TABLES, **FILES}
