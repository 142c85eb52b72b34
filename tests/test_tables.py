import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from conftest import ROOT, rows
from pyspark.sql import functions as F
from test_text import CID, NM, STORED
from test_workflow import definitions, depends, schedule, shell

from opdiag import flows, schemas
from opdiag.defaults import Ours
from opdiag.operators import jobs, lineage
from opdiag.operators.retention import export_history, month_partition
from opdiag.session import scratch_path, shared_dir
from opdiag.sinks import relations, retention, tables
from opdiag.sources import eventlog, fsimage, logs, scheduler

HEADER = "Path,Replication,ModificationTime,AccessTime,PreferredBlockSize,BlocksCount,FileSize,NSQUOTA,DSQUOTA,Permission,UserName,GroupName"


def line(path, size, time="2024-01-01 08:00"):
    return f"{path},3,{time},{time},134217728,1,{size},-1,-1,-rw-r--r--,u,g"


def test_listing_keeps_every_line(spark, tmp_path):
    file = tmp_path / "listing.csv"
    odd = line("/n", 4).replace(",4,", ",many,")
    texts = [HEADER, line("/a", 1), line("/b,c,,d", 2), odd, "cut,3"]
    file.write_text("\n".join(texts) + "\n")
    read = fsimage.read_listing(spark, str(file), "20240110")
    assert rows(read, "path", "filesize", "groupname") == sorted([
        ("/a", 1, "g"), ("/b,c,,d", 2, "g"), ("/n", None, "g"), ("cut", None, None),
    ], key=str)
    assert rows(read.where("path = 'cut'"), "replication", "modificationtime") == [(3, None)]
    # the same rows whatever is selected
    assert read.select("path").count() == read.select("filesize").count() == read.count() == 4
    assert read.where("filesize is null").count() == 2


def test_overwrite_keeps_other_partitions(spark, database):
    table = f"{database}.t"
    make = lambda *data: spark.createDataFrame(data, "partition_key string, v int")
    tables.overwrite_partitions(make(("1", 1), ("2", 2)), table)
    tables.overwrite_partitions(make(("2", 3), ("3", 4)), table)
    assert rows(spark.table(table), "partition_key", "v") == [("1", 1), ("2", 3), ("3", 4)]
    assert fsimage.latest_partition(spark, table) == "3"
    assert rows(fsimage.snapshot(spark.table(table), "2"), "v") == [(3,)]


def test_partitions_of_two_columns(spark):
    frame = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], "p string, q int, v int")
    touched = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3)], "p string, q int")
    assert rows(tables._of_partitions(frame, touched), "v") == [(2,), (3,)]


def test_retention_drops_partitions(spark, database):
    table, other = f"{database}.t", f"{database}.o"
    days = [("20231110",), ("20231111",), ("20240110",)]
    frame = spark.createDataFrame(days, "partition_key string").withColumn("v", F.lit(1))
    tables.overwrite_partitions(frame, table)
    tables.overwrite_partitions(frame.where("partition_key > '2024'"), other)
    assert retention.drop_expired(spark, [table, other], "2024-01-10") == {table: ["20231110"], other: []}
    assert rows(spark.table(table), "partition_key") == [("20231111",), ("20240110",)]


def test_month_retention_drops_partitions(spark, database):
    table = f"{database}.t"
    days = spark.createDataFrame([("2022-11-30",), ("2022-12-01",), ("2024-01-10",)], "d string")
    frame = month_partition(days.selectExpr("cast(d as date) as dt"))
    tables.overwrite_partitions(frame, table, ["month"])
    assert retention.drop_expired_months(spark, [table], "2024-01-10") == {table: ["202211"]}
    assert rows(spark.table(table), "month") == [("202212",), ("202401",)]


def test_newest_file(spark, tmp_path):
    for age, name in enumerate(("fsimage_01", "fsimage_03", "other")):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1000 - age, 1000 - age))
    assert fsimage.newest_file(spark, str(tmp_path), "*fsimage_0*").endswith("fsimage_01")
    assert fsimage.newest_file(spark, str(tmp_path), "none*") is None


def test_upsert_keeps_rows_without_a_partition_value(spark, database):
    table, keys = f"{database}.n", ["dt", "task_id"]
    shape = "dt date, task_id string, name string, insert_time timestamp_ntz"
    time = dt.datetime(2024, 1, 1)
    tables.upsert(spark.createDataFrame([(None, "a", "old", time), (None, "b", "kept", time)], shape), table, keys)
    newer = [(None, "a", "new", time + dt.timedelta(hours=1)), (dt.date(2024, 1, 2), "a", "dated", time)]
    tables.upsert(spark.createDataFrame(newer, shape), table, keys)
    assert sorted(r.name for r in spark.table(table).collect()) == ["dated", "kept", "new"]


def test_upsert_rewrites_only_what_changes(spark, database):
    table, keys = f"{database}.m", ["dt", "task_id"]
    shape = "dt date, task_id string, name string, insert_time timestamp_ntz"
    day = lambda d: dt.date(2024, 1, d)
    hour = lambda h: dt.datetime(2024, 1, 1, h)
    first = [(day(1), "a", "old", hour(1)), (day(1), "b", "kept", hour(1)), (day(2), "a", "other", hour(1))]
    tables.upsert(spark.createDataFrame(first, shape), table, keys)
    change = [(day(1), "a", "new", hour(2)), (day(1), "a", "newer", hour(3)), (day(3), "c", "added", hour(1))]
    tables.upsert(spark.createDataFrame(change, shape), table, keys)
    assert rows(spark.table(table), "dt", "task_id", "name") == [
        (day(1), "a", "newer"), (day(1), "b", "kept"), (day(2), "a", "other"), (day(3), "c", "added"),
    ]
    kept = tables._of_partitions(spark.table(table), spark.createDataFrame([(day(2),)], "dt date"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert rows(kept, "name") == [("other",)]
    # the test of the partition's name is one of the partition, so the scan leaves the others out
    assert "StructsToJson" in plan[plan.index("PartitionFilters: [") :].split("PushedFilters")[0]
    with pytest.raises(ValueError):
        tables.upsert(spark.createDataFrame(change, shape), table, ["task_id"])


def test_storage_day(spark, database, tmp_path):
    file = tmp_path / "listing.csv"
    paths = [line("/user/a/1", 100), line("/user/b/1", 300), line("/user/hive/warehouse/x.db/t/f", 2**31), line("/", 0)]
    file.write_text("\n".join([HEADER, *paths]) + "\n")
    for day in ("20240109", "20240110"):
        flows.storage_day(spark, str(file), day, "2024-01-10", database)
    flows.storage_day(spark, str(file), "20240110", "2024-01-10", database)
    report = spark.table(f"{database}.hdfs_storage")
    assert rows(report, "dir_name", "dir_size", "partition_key") == [
        ("/user", 3, "20240109"), ("/user", 3, "20240110"),
    ]
    assert spark.table(f"{database}.dwd_fsimage").count() == 8
    assert spark.table(f"{database}.hive_storage_dir").where("partition_key = '20240110'").first().table_count == 1
    exported = spark.table(f"{database}.hdfs_storage_user_export")
    assert exported.columns[-1] == "etl_dt" and "partition_key" not in exported.columns
    assert rows(exported) == rows(export_history(spark.table(f"{database}.hdfs_storage_user")))


def test_reports_read_one_partition_and_few_columns(spark, database):
    data = [("/a", 1, "2024-01-01", "20240110")]
    frame = spark.createDataFrame(data, "p1 string, filesize bigint, accesstime string, partition_key string")
    frame = frame.withColumns({"filesize_total": F.col("filesize"), "unused": F.lit("x")})
    tables.overwrite_partitions(frame, f"{database}.dwd")
    from opdiag.operators.storage import dir_storage_report

    report = dir_storage_report(fsimage.snapshot(spark.table(f"{database}.dwd"), "20240110"), "2024-01-10")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_key" in plan and "unused" not in plan
    assert "IsNotNull(p1)" in plan and plan.count("Exchange") == 1


def test_lineage_day_and_relations(spark, database, tmp_path):
    released = definitions(spark, (7, [shell("a"), shell("b", "a")]), (8, [
        depends("d", {"projectId": 100, "definitionId": 7, "depTasks": "b"}), shell("x", "d")]))
    raw = released.select(
        F.col("process_id").alias("id"), F.col("process_name").alias("name"), "project_id",
        F.lit(1).alias("release_state"), F.lit("2024-01-01").alias("update_time"), "process_definition_json",
    )
    projects = spark.createDataFrame([(100, "proj")], schemas.PROJECT)
    for _ in range(2):
        flows.lineage_day(raw, projects, "2024-01-10", "p8", str(tmp_path / "csv"), f"{database}.mon")
    assert rows(spark.table(f"{database}.mon"), "task_id") == [("7-a",), ("7-b",), ("8-x",)]
    read = lambda name: scheduler.read_relation(
        spark, str(tmp_path / "csv" / name), relations.schema_of(name), relations.RELATIONS[name][0]
    )
    assert rows(read("task"), "task_id", "task_type") == [("7-a", "SHELL"), ("7-b", "SHELL"), ("8-x", "SHELL")]
    assert rows(read("task_task"), "task_id", "pre_task_id") == [("7-b", "7-a"), ("8-x", "7-b")]
    assert rows(read("process_task"), "relation", "task_id")[0] == ("包含", "7-a")
    assert rows(read("process"), "process_id") == [("7",), ("8",)]
    assert read("process_process").count() == read("task_process").count() == 0


def test_run_time_day_has_the_table_types(spark, database):
    plan = schedule(spark, (1, 1, 100, "2024-01-10 01:00:00", "2024-01-10 01:00:20", 0))
    for _ in range(2):
        flows.run_time_day(*plan, "2024-01-10", "2024-01-09", f"{database}.dm")
    written = spark.table(f"{database}.dm")
    assert [(f.name, f.dataType) for f in written.schema] == [(f.name, f.dataType) for f in schemas.DEPTASKS]
    assert [str(r.taken_minute) for r in written.collect()] == ["0.33", "0.33"]


def test_log_hour(spark, database, tmp_path):
    (tmp_path / "hadoop-yarn-NODEMANAGER-n1.log").write_text(NM.format(CID) + "\n" + NM.format(CID).replace(" 10:", " 11:"))
    (tmp_path / "hadoop-yarn-RESOURCEMANAGER-r1.log").write_text(STORED + "\n")
    (tmp_path / "other.log").write_text(STORED + "\n")
    old = tmp_path / "hadoop-yarn-NODEMANAGER-n2.log"
    old.write_text(NM.format(CID) + "\n")
    os.utime(old, (0, 0))
    target = f"{tmp_path}-loaded"
    expected = [("n1", "2024-01-05 10:00:01.250"), ("r1", "2024-01-05 10:00:00.001")]
    for files in (2, 0):  # a second run finds nothing to do
        assert flows.log_hour(spark, str(tmp_path), "2024-01-05 10", target) == files
        assert rows(flows.logged(spark, target), "server_ip", "change_time") == expected
    assert flows.log_hour(spark, str(tmp_path), "2024-01-05 10", target, all_files=True) == 1
    assert flows.logged(spark, target).count() == 3
    given = logs.read_lines(spark, str(tmp_path), logs.RESOURCE_MANAGER, server_ip="10.0.0.1")
    assert given.first().server_ip == "10.0.0.1"


def test_attempts_and_tables_read_with_fixed_schemas(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"app_id":"job_1","stage_id":0,"kind":"MAP","duration_ms":5,"more":1}\n')
    got = scheduler.read_attempts(spark, str(tmp_path / "a.json"))
    assert got.schema == schemas.MR_TASK_ATTEMPT and got.first().duration_ms == 5
    spark.createDataFrame([("t", "p", 1, 2)], schemas.TABLET).write.parquet(str(tmp_path / "tablet"))
    assert rows(scheduler.read_table(spark, "tablet", str(tmp_path / "tablet"))) == [("t", "p", 1, 2)]


APPLICATION = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", sys.argv[1])
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
         .config("spark.driver.memory", "1g").getOrCreate())
small = spark.range(100).withColumn("k", F.col("id") % 10)
spark.range(1000).join(F.broadcast(small), "id").groupBy("k").count().orderBy("k").collect()
try:
    spark.range(1).select(F.raise_error(F.lit("cannot resolve column"))).collect()
except Exception:
    pass
spark.stop()
"""


def test_event_log_tables(spark, tmp_path):
    subprocess.run([sys.executable, "-c", APPLICATION, str(tmp_path)], check=True, timeout=180,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    lines = eventlog.read_lines(spark, str(tmp_path))
    tasks, stages, plans = eventlog.tasks(lines), eventlog.stages(lines), eventlog.plans(lines)
    for frame, schema in (
        (tasks, schemas.JOB_TASK), (stages, schemas.APP_STAGE), (plans, schemas.APP_PLAN),
        (eventlog.jobs(lines), schemas.APP_JOB), (eventlog.executors(lines), schemas.APP_EXECUTOR),
        (eventlog.memory(lines), schemas.APP_MEMORY), (eventlog.broadcasts(lines), schemas.APP_BROADCAST),
    ):
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schema]
        assert frame.count() > 0
    assert {r.allocated_memory for r in tasks.collect()} == {2**30}
    assert jobs.sql_failures(tasks).count() == 1
    assert jobs.global_sort(stages, plans, min_ms=-1).count() > 0
    assert eventlog.executors(lines).first().cores == 2


def test_shared_folder_is_the_sessions_own(spark):
    folder = shared_dir(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    assert scratch_path(spark, "x").startswith(folder.rstrip("/")) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_no_python_workers_or_local_checkpoints():
    banned = ("localCheckpoint", "pandas_udf", ".crossJoin(", "toPandas", ".rdd", "F.udf")
    for folder, below, names in os.walk(os.path.join(ROOT, "opdiag")):
        below[:] = [name for name in below if name != "llm"]
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                assert not [word for word in banned if word in text], name


def event_file(tmp_path, *events):
    folder = tmp_path / "logs"
    folder.mkdir()
    lines = [json.dumps(event, separators=(",", ":")) for event in events]
    (folder / "application_1700000000000_0007").write_text("\n".join(lines) + "\n")
    return str(folder)


def event(kind, **fields):
    return {"Event": f"SparkListener{kind}", **{k.replace("_", " "): v for k, v in fields.items()}}


def test_retried_and_shared_stages_are_one_row_per_attempt(spark, tmp_path):
    done = [
        event("StageCompleted", **{"Stage Info": {"Stage ID": 1, "Stage Attempt ID": n, "Submission Time": 10 * n,
                                                  "Completion Time": 10 * n + 8}}) for n in (0, 1)
    ]
    starts = [event("JobStart", **{"Job ID": n, "Submission Time": 0, "Stage IDs": [1],
                                   "Properties": {"spark.sql.execution.id": str(n)}}) for n in (3, 4)]
    lines = eventlog.read_lines(spark, event_file(tmp_path, *starts, *done))
    assert rows(eventlog.stages(lines), "stage_id", "stage_attempt", "job_id", "execution_id", "submit_ms") == [
        (1, 0, 3, 3, 0), (1, 1, 3, 3, 10),
    ]
    assert rows(eventlog.stage_jobs(lines), "job_id", "stage_id") == [(3, 1), (4, 1)]


def test_reasons_of_failures(spark, tmp_path):
    killed = "Container killed by YARN for exceeding memory limits"
    lines = eventlog.read_lines(spark, event_file(
        tmp_path,
        event("TaskEnd", **{"Stage ID": 1, "Task Type": "ResultTask",
                            "Task End Reason": {"Reason": "ExecutorLostFailure", "Loss Reason": killed},
                            "Task Info": {"Launch Time": 1, "Finish Time": 2, "Executor ID": "3"}}),
        event("JobEnd", **{"Job ID": 1, "Completion Time": 5,
                           "Job Result": {"Result": "JobFailed", "Exception": {"Message": "stage failed"}}}),
        event("JobEnd", **{"Job ID": 2, "Completion Time": 5, "Job Result": {"Result": "JobSucceeded"}}),
        {"Event": "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd", "executionId": 4, "time": 9,
         "errorMessage": "AnalysisException: no column x"},
        {"Event": "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd", "executionId": 5, "time": 9,
         "errorMessage": ""},
        event("ExecutorRemoved", **{"Timestamp": 7, "Executor ID": "3", "Removed Reason": killed}),
        event("ApplicationStart", Timestamp=0), event("ApplicationEnd", Timestamp=100),
        event("EnvironmentUpdate", **{"Spark Properties": {"spark.driver.cores": "2"}}),
        event("ExecutorAdded", **{"Timestamp": 1, "Executor ID": "3", "Executor Info": {"Total Cores": 4}}),
    ))
    lost = eventlog.tasks(lines)
    assert rows(lost, "failure_reason", "input_bytes") == [(f"ExecutorLostFailure: {killed}", None)]
    assert jobs.oom_failures(lost).count() == 1
    assert rows(eventlog.job_failures(lines), "unit", "failure_reason") == [("job 1", "stage failed")]
    wrong = eventlog.sql_execution_failures(lines)
    assert rows(jobs.unit_failures(wrong, "AnalysisException"), "unit") == [("execution 4",)]
    assert rows(jobs.unit_failures(eventlog.executor_losses(lines), Ours.OOM_FAILURE), "unit") == [("executor 3",)]
    assert rows(eventlog.executors(lines), "executor_id", "cores", "start_ms", "end_ms") == [
        ("3", 4, 1, 7), ("driver", 2, 0, 100),
    ]


def test_landed_events_are_read_by_kind(spark, tmp_path):
    folder = event_file(
        tmp_path, event("ApplicationStart", Timestamp=1), event("TaskStart", **{"Stage ID": 1}),
        event("JobEnd", **{"Job ID": 1, "Completion Time": 5, "Job Result": {"Result": "JobFailed"}}),
    )
    for _ in range(2):  # landing a day again changes nothing
        eventlog.land(eventlog.read_lines(spark, folder), str(tmp_path / "landed"), "2024-01-01")
    lines = eventlog.landed(spark, str(tmp_path / "landed"), "2024-01-01")
    assert rows(lines, "kind") == [("SparkListenerApplicationStart",), ("SparkListenerJobEnd",)]
    found = eventlog.job_failures(lines)
    assert rows(found, "unit", "failure_reason") == [("job 1", "JobFailed")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "kind" in plan[plan.index("PartitionFilters: [") :].split("PushedFilters")[0]
    assert plan.count("Scan") == 1
