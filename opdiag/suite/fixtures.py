"""Operational tables derived from the given tables, with the DataFrame API.

``oracle.py`` states the same derivations in SQL. Every derivation reads its table whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.operators.sized import cut

AS_OF = "2011-11-05"
PARTITION = "20111105"
TODAY, LASTDAY = "2024-01-10", "2024-01-09"
START_PROCESS = "process_3"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _floor(column: Column) -> Column:
    return F.floor(column).cast("bigint")


def fsimage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    order, part, line = c("l_orderkey"), c("l_partkey"), c("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "day", F.add_months(c("l_shipdate").cast("date"), 120).cast("string")
    )
    kind = part % 4
    dashed = F.when(kind % 2 == 0, c("day")).otherwise(F.replace("day", F.lit("-"), F.lit("")))
    width = F.when(kind < 2, 10).when(kind == 2, 7).otherwise(6)
    spelled = F.substring(dashed, F.lit(1), width)
    place = order % 10
    folder = (
        F.when(order == 0, "/")
        .when(order == 1, "Path")
        .when(
            place < 6,
            _text("/user/hive/warehouse/db", c("l_suppkey") % 5, ".db/tbl", part % 20, "/dt=",
                  spelled, "/part-"),
        )
        .when(place < 8, _text("/user/u", c("l_suppkey") % 7, "/f-"))
        .when(place == 8, "/tmp/f-")
        .otherwise(_text("/data/d", part % 4, "/f-"))
    )
    name = F.when(order < 2, "").otherwise(_text(order, "-", line))
    factor = line % 5
    replication = (
        F.when(factor == 0, 0).when(factor == 1, 3).when(factor == 2, 2).when(factor == 3, 16020)
    )
    idle = F.when(line == 1, order % 10).otherwise((order * 7 + line) % 2600).cast("int")
    unchanged = ((part * 13 + line) % 2600).cast("int")
    as_of = F.lit(AS_OF).cast("date")
    size = _floor(c("l_extendedprice")) * c("l_quantity").cast("bigint") * 400
    record = F.struct(
        F.concat(folder, name).alias("path"),
        replication.cast("int").alias("replication"),
        _text(F.date_sub(as_of, unchanged), " 08:00").alias("modificationtime"),
        F.when(order % 97 != 0, _text(F.date_sub(as_of, idle), " 08:00")).alias("accesstime"),
        F.lit(134217728).cast("bigint").alias("preferredblocksize"),
        line.cast("int").alias("blockscount"),
        F.when(line == 7, F.lit(0).cast("bigint")).otherwise(size).alias("filesize"),
        F.lit(-1).cast("bigint").alias("nsquota"),
        F.lit(-1).cast("bigint").alias("dsquota"),
        F.lit("-rw-r--r--").alias("permission"),
        _text("u", c("l_suppkey") % 7).alias("username"),
        F.lit("g").alias("groupname"),
        F.lit(PARTITION).alias("partition_key"),
    )
    # Some records occur twice. They come out of a generator, so the table is read once, and
    # filters on the record are not rewritten into filters on the expressions above.
    copies = F.when((line == 3) & (order % 10 == 8), 2).otherwise(1)
    return rows.select(F.inline(F.array_repeat(record, copies)))


def query_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    lines = [
        ("PLAN FRAGMENT 0",),
        ("2:HASH JOIN",),
        ("  |  cardinality=", c("o_custkey")),
        ("0:OlapScanNode",),
        ("     TABLE: t", c("o_custkey") % 50),
        ("     partitions=", c("o_orderkey") % 12, "/", c("o_orderkey") % 3 * 12),
        ("     cardinality=", _floor(c("o_totalprice")) * 100),
        ("1:OlapScanNode",),
        ("     TABLE: t", c("o_orderkey") % 50),
        ("     partitions=1/", c("o_custkey") % 30),
        ("     cardinality=", c("o_orderkey") * 1000),
    ]
    plan = F.concat(*[_text(*line, "\n") for line in lines])
    return table(spark, sf_dir, "orders").select(
        _text("q", c("o_orderkey")).alias("query_id"),
        c("o_orderdate").alias("start_time"),
        c("o_orderdate").alias("end_time"),
        _text("u", c("o_custkey") % 9).alias("user"),
        (c("o_orderkey") % 1000).alias("time_used"),
        c("o_orderstatus").alias("state"),
        F.lit(None).cast("string").alias("error_message"),
        _text("select ", c("o_orderkey")).alias("sql"),
        F.lit("ds").alias("database"),
        plan.alias("plan"),
    )


def _log_time() -> Column:
    return _text(
        F.substring(F.col("ts").cast("string"), 1, 19), ",",
        F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"),
    )


def _ids(column: str, width: int) -> Column:
    return F.lpad(F.col(column).cast("string"), width, "0")


def _container() -> Column:
    return _text("container_1700000000000_", _ids("user_id", 4), "_01_", _ids("event_id", 6))


def rm_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = (
        F.when(
            F.col("event_type") == "signup",
            _text(" INFO x.RMStateStore: Storing application with id application_1700000000000_",
                  _ids("user_id", 4)),
        )
        .when(F.col("event_type") == "error", " WARN noise")
        .otherwise(
            _text(" INFO x.RMContainerImpl: ", _container(),
                  " Container Transitioned from NEW to ", F.upper("event_type"))
        )
    )
    return table(spark, sf_dir, "events").select(
        F.concat(_log_time(), message).alias("value"),
        _text("rm-host-", F.col("user_id") % 3).alias("server_ip"),
    )


def nm_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.when(F.col("event_type") == "error", " WARN noise").otherwise(
        _text(" INFO x.ContainerImpl: Container ", _container(), " transitioned from LOCALIZING to ",
              F.upper("event_type"))
    )
    return table(spark, sf_dir, "events").select(
        F.concat(_log_time(), message).alias("value"),
        _text("nm-host-", F.col("user_id") % 3).alias("server_ip"),
    )


def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        _text("project_", F.col("n_nationkey")).alias("name"),
    )


def process_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions whose names repeat in several projects, for the run-time report."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        _text("process_", F.floor(F.col("c_custkey") / 3)).alias("name"),
        F.col("c_nationkey").cast("bigint").alias("project_id"),
    )


def task_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    process = F.floor(c("user_id") / 4)
    start = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        c("event_id").alias("id"),
        _text("task_", c("event_id") % 2).alias("name"),
        process.alias("process_definition_id"),
        (process * 100 + F.dayofmonth("ts")).alias("process_instance_id"),
        start.alias("submit_time"),
        start.alias("start_time"),
        F.timestamp_add("SECOND", F.floor(c("value") * 10).cast("int"), start).alias("end_time"),
        (c("event_id") % 3).cast("int").alias("retry_times"),
    )


def monitored_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opdiag.operators.runs import named_instances

    names = named_instances(
        task_instance(spark, sf_dir),
        process_definition(spark, sf_dir),
        project(spark, sf_dir),
    ).select("project_name", "process_name", "task_name").distinct()
    days = F.array(*[F.lit(day).cast("date") for day in (TODAY, LASTDAY)])
    return names.withColumn("dt", F.explode(days))


def workflow_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions with their JSON document, for the lineage."""
    c = F.col
    key = c("c_custkey")

    # some pairs of processes start each other
    sub = (
        F.when(key % 10 == 1, key + 1).when(key % 10 == 2, key - 1).otherwise(F.floor(key / 2))
    )

    def task(name: str, kind: str, pre: str, more: str = "") -> str:
        return f'{{"name":"{name}","type":"{kind}","preTasks":[{pre}]{more}}}'

    document = F.concat(
        F.lit('{"tasks":['),
        # the earlier of two equal names, which must not count
        F.when(key % 7 == 0, task("task_1", "PYTHON", "") + ",").otherwise(""),
        F.lit(task("task_0", "SHELL", "") + ","),
        F.lit(task("task_1", "SHELL", '"task_0"') + ","),
        F.lit(task("py", "PYTHON", '"task_0"') + ","),
        _text('{"name":"sub","type":"SUB_PROCESS","preTasks":["task_1"],'
              '"params":{"processDefinitionId":', sub, "}},"),
        F.when(
            key % 5 != 0,
            _text('{"name":"dep","type":"DEPENDENT","dependence":{"dependTaskList":['
                  '{"dependItemList":[{"projectId":', c("c_nationkey"), ',"definitionId":', key - 1,
                  ',"depTasks":"', F.when(key % 2 == 0, "ALL").otherwise("task_1"),
                  '"},{"depTasks":"task_0"}]}]}},'
                  '{"name":"task_2","type":"SHELL","preTasks":["dep","sub"],"dependence":null},'),
        ).otherwise(""),
        F.lit('{"name":"end","type":"SHELL","preTasks":["task_1"'),
        F.when(key % 13 == 0, ',"ghost"').otherwise(""),
        F.lit("]}]}"),
    )
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        _text("process_", key % 8).alias("name"),
        c("c_nationkey").cast("bigint").alias("project_id"),
        F.when(key % 11 == 0, 0).otherwise(1).alias("release_state"),
        _text("2024-01-", F.lpad((key % 28 + 1).cast("string"), 2, "0"), " 10:00:00")
        .alias("update_time"),
        document.alias("process_definition_json"),
    )


DEFINITIONS_DT = "2024-01-26"


def released(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opdiag.operators.lineage import released_definitions

    return released_definitions(
        workflow_definition(spark, sf_dir), project(spark, sf_dir), DEFINITIONS_DT
    )


def _launch(stage: Column) -> Column:
    c = F.col
    spread = c("l_orderkey") * 7919 + c("l_partkey") * 104729 + c("l_linenumber") * 1000003
    return spread % (7200000 - 340000 * stage)


def job_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    stage, app = c("l_suppkey") % 20, c("l_suppkey") % 10
    size, seconds = _floor(c("l_extendedprice")), c("l_quantity").cast("bigint")
    reason = (
        F.when(c("l_orderkey") % 500 == 1, "FetchFailedException: lost block")
        .when(c("l_orderkey") % 500 == 2, "java.lang.OutOfMemoryError: Java heap space")
        .when(c("l_orderkey") % 500 == 3, "AnalysisException: column not found")
    )
    return table(spark, sf_dir, "lineitem").select(
        _text("app_", app).alias("app_id"),
        stage.cast("int").alias("stage_id"),
        F.when(c("l_linestatus") == "O", "MAP").otherwise("REDUCE").alias("kind"),
        F.when(c("l_partkey") % 16 == 0, "driver")
        .otherwise(_text("exec_", c("l_partkey") % 8)).alias("executor_id"),
        _launch(stage).alias("launch_ms"),
        (seconds * 1000 * F.when(c("l_orderkey") % 1000 == 11, 50).otherwise(1)).alias("duration_ms"),
        (size * 1000 * F.when(c("l_orderkey") % 1000 == 7, 50).otherwise(1)).alias("input_bytes"),
        size.alias("input_records"),
        ((c("l_returnflag") == "R") & (stage < 5)).alias("speculative"),
        (seconds * 25 * app).alias("gc_ms"),
        (seconds * 1000).alias("cpu_ms"),
        (1000000 * app).alias("peak_memory"),
        F.lit(10000000).cast("bigint").alias("allocated_memory"),
        reason.alias("failure_reason"),
    )


def app_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = job_task(spark, sf_dir).groupBy("app_id", "stage_id").agg(
        F.min("launch_ms").alias("submit_ms"),
        F.max(F.col("launch_ms") + F.col("duration_ms")).alias("end_ms"),
    )
    return spans.select(
        "app_id", F.floor(F.col("stage_id") / 4).cast("bigint").alias("execution_id"),
        "stage_id", "submit_ms", "end_ms",
    )


def app_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    execution = F.col("execution_id")
    plan = _text(
        "AdaptiveSparkPlan\n+- Sort [a#1 ASC NULLS FIRST], ",
        F.when(execution % 3 == 0, "true").otherwise("false"), ", 0\n   +- FileScan parquet t[a#1] ",
        F.when(execution % 2 == 0, "PartitionFilters: []")
        .otherwise("PartitionFilters: [isnotnull(dt#2)]"),
        ", PushedFilters: []\n",
    )
    # from a generator, so that tests on the text do not turn into tests on the execution's number
    return app_stage(spark, sf_dir).select("app_id", "execution_id").distinct().select(
        "*", F.explode(F.array(plan)).alias("plan")
    )


def app_executor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_task(spark, sf_dir).groupBy("app_id", "executor_id").agg(
        (F.floor(F.count(F.lit(1)) / 50) + 1).cast("int").alias("cores"),
        F.min("launch_ms").alias("start_ms"),
        F.max(F.col("launch_ms") + F.col("duration_ms")).alias("end_ms"),
    )


def app_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _text("app_", F.col("o_custkey")).alias("app_id"),
        F.col("o_orderkey").alias("execution_id"),
        (_floor(F.col("o_totalprice")) * 1000).alias("bytes"),
    )


def app_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _text("app_", key).alias("app_id"),
        ((key % 4 + 1) * 2**30).alias("driver_memory"),
        ((key % 3 + 2) * 2**30).alias("executor_memory"),
    )


def sparse_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few long tasks per stage, so that stages have gaps."""
    return _sparse_task(spark, sf_dir).select(_text("app_", F.col("app")).alias("app_id"), "*").drop("app")


def _sparse_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the application's number."""
    c = F.col
    stage = c("l_partkey") % 200
    return table(spark, sf_dir, "lineitem").select(
        c("l_suppkey").alias("app"),
        stage.cast("int").alias("stage_id"),
        _launch(stage % 20).alias("launch_ms"),
        (c("l_quantity").cast("bigint") * 60000).alias("duration_ms"),
    )


def sparse_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    # numbers are grouped quicker than the ids made of them
    return _sparse_task(spark, sf_dir).groupBy("app", "stage_id").agg(
        F.min("launch_ms").alias("submit_ms"),
        F.max(F.col("launch_ms") + F.col("duration_ms")).alias("end_ms"),
    ).select(_text("app_", F.col("app")).alias("app_id"), "stage_id", "submit_ms", "end_ms")


def job_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About a dozen stages per job."""
    c = F.col
    start = _launch(c("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        _text("app_", c("l_suppkey")).alias("app_id"),
        (c("l_partkey") % 50).cast("int").alias("job_id"),
        start.alias("submit_ms"),
        (start + c("l_quantity").cast("bigint") * 20000).alias("end_ms"),
    )


def app_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_stage(spark, sf_dir).groupBy("app_id", "job_id").agg(
        (F.min("submit_ms") - 60000).alias("submit_ms"),
        (F.max("end_ms") + 60000).alias("end_ms"),
    )


def workflow_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "events").select(
        F.floor(c("user_id") / 4).alias("process_id"),
        _text("task_", c("event_id") % 2).alias("task_name"),
        c("ts").cast("date").alias("dt"),
        c("event_id").alias("attempt_id"),
        (c("event_id") % 4).cast("int").alias("retry_times"),
        F.when(c("event_type").isin("error", "signup"), "FAILURE").otherwise("SUCCESS")
        .alias("state"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("start_time"),
        F.floor(c("value") * 30).cast("bigint").alias("duration_s"),
    )


def tablet(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    unit = F.when(key % 3 == 0, 1000).when(key % 3 == 1, 1000000).otherwise(100000000)
    return table(spark, sf_dir, "part").select(
        _text("t", key % 20).alias("table_name"),
        _text("p", F.col("p_size")).alias("partition_name"),
        key.alias("tablet_id"),
        F.when(key % 20 == 3, 0).otherwise(_floor(F.col("p_retailprice")) * unit).cast("bigint")
        .alias("bytes"),
    )


def load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        _text("t", F.col("user_id") % 20).alias("table_name"),
        F.col("ts").alias("load_time"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("bytes"),
    )


def partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows of five tables."""
    names = ["ods_fsimage", "dwd_fsimage", "hdfs_storage", "hive_storage_dir", "hdfs_storage_user"]
    which = F.array(*[F.lit(name) for name in names])
    return table(spark, sf_dir, "orders").select(
        F.get(which, (F.col("o_orderkey") % 5).cast("int")).alias("table_name"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("partition_key"),
        F.col("o_orderdate").cast("date").alias("dt"),
        F.col("o_orderkey").alias("id"),
    )


def task_version(spark: SparkSession, sf_dir: str, change: bool) -> DataFrame:
    """Keyed rows with many versions; changes are an hour younger than the rows they replace."""
    c = F.col
    rows = table(spark, sf_dir, "orders").select(
        c("o_orderdate").cast("date").alias("dt"),
        _text(c("o_custkey") % 5).alias("project_id"),
        _text(c("o_custkey") % 7).alias("process_id"),
        _text(c("o_custkey") % 3).alias("task_id"),
        _text("name_", c("o_orderkey")).alias("task_name"),
        F.timestamp_add("SECOND", (c("o_orderkey") % 86400).cast("int"), c("o_orderdate"))
        .alias("insert_time"),
    )
    later = F.timestamp_add("HOUR", F.lit(1), c("insert_time"))
    return rows.withColumn("insert_time", later) if change else rows


def task_end_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-log lines of finished tasks, by application, next to lines of other kinds."""
    c = F.col
    # some tasks have a line about their start besides the one about their end
    steps = F.when(c("input_records") % 10 == 0, F.array(F.lit("Start"), F.lit("End"))).otherwise(
        F.array(F.lit("End"))
    )
    task = job_task(spark, sf_dir).withColumn("step", F.explode(steps))
    failed = c("failure_reason").isNotNull()
    event = F.struct(
        F.concat(F.lit("SparkListenerTask"), c("step")).alias("Event"),
        c("stage_id").alias("Stage ID"),
        c("kind").alias("Task Type"),
        F.struct(
            F.when(failed, "ExceptionFailure").otherwise("Success").alias("Reason"),
            c("failure_reason").alias("Description"),
        ).alias("Task End Reason"),
        F.struct(
            c("launch_ms").alias("Launch Time"),
            (c("launch_ms") + c("duration_ms")).alias("Finish Time"),
            c("executor_id").alias("Executor ID"),
            c("speculative").alias("Speculative"),
        ).alias("Task Info"),
        F.struct(
            (c("cpu_ms") * 1_000_000).alias("Executor CPU Time"),
            c("gc_ms").alias("JVM GC Time"),
            c("peak_memory").alias("Peak Execution Memory"),
            F.struct(
                c("input_bytes").alias("Bytes Read"), c("input_records").alias("Records Read")
            ).alias("Input Metrics"),
        ).alias("Task Metrics"),
    )
    number = F.substring("app_id", 5, 3)
    return task.select(
        F.to_json(event).alias("value"),
        F.concat(F.lit("application_1700000000000_"), F.lpad(number, 4, "0")).alias("app"),
    )


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-log lines of stages, jobs, executors and executions, by application.

    Every fifth stage has two attempts, every stage belongs to a job of its own and a shared one,
    every third job and execution fails, and every executor but the driver is removed.
    """
    c = F.col
    listener, sql = "SparkListener", "org.apache.spark.sql.execution.ui.SparkListener"

    def line(kind: str, prefix: str = listener, **fields) -> Column:
        parts = [F.lit(prefix + kind).alias("Event")]
        parts += [value.alias(name.replace("_", " ")) for name, value in fields.items()]
        return F.to_json(F.struct(*parts))

    def lines(rows: DataFrame, *values: Column) -> DataFrame:
        return rows.select("app_id", F.explode(F.array(*values)).alias("value"))

    stage = sparse_stage(spark, sf_dir)
    # read twice below, with other filters: the tasks are read once
    executor, _ = cut(app_executor(spark, sf_dir))
    attempts = stage.withColumn("attempt", F.explode(
        F.when(c("stage_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ))
    own = F.floor(c("stage_id") / 4).cast("int")
    jobs = stage.select(
        "app_id", "stage_id", "submit_ms", "end_ms", F.explode(F.array(own, F.lit(1000))).alias("job_id")
    ).groupBy("app_id", "job_id").agg(
        F.collect_list("stage_id").alias("stages"), F.min("submit_ms").alias("submit_ms"),
        F.max("end_ms").alias("end_ms"),
    )
    failed = c("job_id") % 3 == 0
    result = F.when(failed, F.struct(
        F.lit("JobFailed").alias("Result"), F.struct(_text("stage of ", c("job_id"), " failed").alias("Message")).alias("Exception")
    )).otherwise(F.struct(
        F.lit("JobSucceeded").alias("Result"),
        F.struct(F.lit(None).cast("string").alias("Message")).alias("Exception"),
    ))
    apps = executor.groupBy("app_id").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))
    workers = executor.where("executor_id <> 'driver'")
    made = [
        lines(attempts, line("StageCompleted", Stage_Info=F.struct(
            c("stage_id").alias("Stage ID"), c("attempt").alias("Stage Attempt ID"),
            (c("submit_ms") + c("attempt")).alias("Submission Time"),
            (c("end_ms") + c("attempt")).alias("Completion Time"),
        ))),
        lines(
            jobs,
            line("JobStart", Job_ID=c("job_id"), Submission_Time=c("submit_ms"), Stage_IDs=c("stages"),
                 Properties=F.create_map(F.lit("spark.sql.execution.id"), c("job_id").cast("string"))),
            line("JobEnd", Job_ID=c("job_id"), Completion_Time=c("end_ms"), Job_Result=result),
            line("SQLExecutionEnd", sql, executionId=c("job_id"), time=c("end_ms"),
                 errorMessage=F.when(failed, _text("AnalysisException: ", c("job_id"))).otherwise("")),
        ),
        lines(
            workers,
            line("ExecutorAdded", Timestamp=c("start_ms"), Executor_ID=c("executor_id"),
                 Executor_Info=F.struct(c("cores").alias("Total Cores"))),
            line("ExecutorRemoved", Timestamp=c("end_ms"), Executor_ID=c("executor_id"),
                 Removed_Reason=_text("Container killed by ", c("executor_id"), " for exceeding memory limits")),
        ),
        lines(
            apps,
            line("ApplicationStart", Timestamp=c("start_ms")),
            line("ApplicationEnd", Timestamp=c("end_ms")),
            line("EnvironmentUpdate", Spark_Properties=F.create_map(
                F.lit("spark.driver.cores"), (c("end_ms") % 4 + 1).cast("string"),
                F.lit("spark.driver.memory"), _text(c("end_ms") % 4 + 1, "g"),
            )),
        ),
    ]
    both = made[0]
    for frame in made[1:]:
        both = both.unionByName(frame)
    # application ids as they look in file names
    return both.select("value", F.concat(F.lit("app-1700000000-"), F.substring("app_id", 5, 9)).alias("app"))


def plan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-log lines of stages, plans, broadcasts and memory, by application.

    An execution has four stages: the first reads a table without a partition filter, the second
    one with a filter, the third sorts (globally in every third execution), the fourth does neither.
    The plan's scans lie below ten nodes with one child each.
    """
    c = F.col
    listener, sql = "SparkListener", "org.apache.spark.sql.execution.ui.SparkListener"
    # read four times below, with other columns: the tasks are read once
    stage, _ = cut(sparse_stage(spark, sf_dir))
    stage = stage.withColumn("execution", F.floor(c("stage_id") / 4))
    first, kind = c("execution") * 10, c("stage_id") % 4

    def accumulator(number: Column, value: Column) -> Column:
        return F.struct(number.cast("bigint").alias("ID"), value.cast("string").alias("Value"))

    worked = F.when(kind == 3, F.array(accumulator(first + 9, F.lit(1)))).otherwise(
        F.array(accumulator(first + kind, (c("end_ms") - c("submit_ms")) * 5))
    )
    completed = F.to_json(F.struct(
        F.lit(listener + "StageCompleted").alias("Event"),
        F.struct(
            c("stage_id").alias("Stage ID"), F.lit(0).alias("Stage Attempt ID"),
            c("submit_ms").alias("Submission Time"), c("end_ms").alias("Completion Time"),
            worked.alias("Accumulables"),
        ).alias("Stage Info"),
    ))
    execution = stage.groupBy("app_id", "execution").agg(
        F.collect_list("stage_id").alias("stages"), F.min("submit_ms").alias("submit_ms")
    )

    def node(name: Column | str, detail: Column | str, metrics: list, children: list, filters=None) -> Column:
        values = [value if isinstance(value, Column) else F.lit(value) for value in (name, detail)]
        named = [
            F.struct(F.lit(what).alias("name"), (c("execution") * 10 + at).alias("accumulatorId"))
            for what, at in metrics
        ]
        return F.struct(
            values[0].alias("nodeName"), values[1].alias("simpleString"),
            (F.array(*children) if children else F.array().cast("array<string>")).alias("children"),
            F.create_map(F.lit("PartitionFilters"), F.lit(filters)).alias("metadata"),
            (F.array(*named) if named else F.array().cast("array<string>")).alias("metrics"),
        )

    rows = "number of output rows"
    scans = [
        node("Scan parquet t.open", "FileScan parquet t.open[a#1]", [(rows, 0)], [], "[]"),
        node("Scan parquet t.pruned", "FileScan parquet t.pruned[a#1]", [(rows, 1)], [],
             "[isnotnull(dt#2)]"),
    ]
    tree = node("SortMergeJoin", "SortMergeJoin [a#1], [a#1], Inner", [(rows, 8)], scans)
    for _ in range(9):
        tree = node("Project", "Project [a#1]", [], [tree])
    order = _text("Sort [a#1 ASC NULLS FIRST], ", F.when(c("execution") % 3 == 0, "true").otherwise("false"), ", 0")
    tree = node("Sort", order, [("sort time", 2)], [tree])
    exchange = F.when(c("execution") % 2 == 0, _text(
        '{"name":"data size","accumulatorId":', c("execution") * 10 + 7, "}"
    )).otherwise("none")
    started = F.to_json(F.struct(
        F.lit(sql + "SQLExecutionStart").alias("Event"), c("execution").alias("executionId"),
        _text("plan of ", c("execution")).alias("physicalPlanDescription"),
        tree.alias("sparkPlanInfo"),
    ))
    # the size of a broadcast is named by a node further down, which only broadcasts() looks for
    replanned = F.concat(
        F.lit('{"Event":"' + sql + 'SQLAdaptiveExecutionUpdate","executionId":'), c("execution"),
        F.lit(',"physicalPlanDescription":"again","sparkPlanInfo":{"nodeName":"Exchange","children":[],"metrics":['),
        exchange, F.lit("]}}"),
    )
    updates = F.array(F.array(c("execution") * 10 + 7, c("submit_ms") * 1000), F.array(c("execution") * 10 + 6, F.lit(5).cast("bigint")))
    driver = F.to_json(F.struct(
        F.lit(sql + "DriverAccumUpdates").alias("Event"), c("execution").alias("executionId"),
        updates.alias("accumUpdates"),
    ))
    job = F.to_json(F.struct(
        F.lit(listener + "JobStart").alias("Event"), c("execution").alias("Job ID"),
        c("submit_ms").alias("Submission Time"), c("stages").alias("Stage IDs"),
        F.create_map(F.lit("spark.sql.execution.id"), c("execution").cast("string")).alias("Properties"),
    ))
    memory = F.to_json(F.struct(
        F.lit(listener + "EnvironmentUpdate").alias("Event"),
        F.create_map(F.lit("spark.driver.memory"), F.lit("2g"), F.lit("spark.executor.memory"), F.lit("3g"))
        .alias("Spark Properties"),
    ))
    broken = c("execution") % 2 == 1  # a plan that cannot be read
    lines = [
        stage.select("app_id", completed.alias("value")),
        execution.select("app_id", F.explode(F.array(started, job, driver)).alias("value")),
        execution.select("app_id", F.when(broken, F.left(replanned, F.length(replanned) - 3)).otherwise(replanned).alias("value")),
        execution.select("app_id").distinct().select("app_id", memory.alias("value")),
    ]
    both = lines[0]
    for frame in lines[1:]:
        both = both.unionByName(frame)
    return both.select("value", F.concat(F.lit("app-1700000000-"), F.substring("app_id", 5, 9)).alias("app"))


def job_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job-history lines of task attempts: started, then finished, failed, killed, or nothing yet."""
    c = F.col
    kind = F.when(c("l_linestatus") == "O", "MAP").otherwise("REDUCE")
    # orders repeat line numbers, so that the part and the price name the attempt as well
    number = _text(
        c("l_orderkey") * 10 + c("l_linenumber"), "_", c("l_partkey") * 1_000_000_000 + _floor(c("l_extendedprice") * 100)
    )
    attempt = _text(
        "attempt_1700000000000_000", c("l_suppkey") % 10, "_", F.lower(F.left(kind, F.lit(1))), "_", number
    )
    fate = c("l_orderkey") % 7
    seconds, size = c("l_quantity").cast("bigint"), _floor(c("l_extendedprice"))

    def counts(**values: Column) -> Column:
        return F.array(*[
            F.struct(F.lit(name).alias("name"), value.cast("bigint").alias("value"))
            for name, value in values.items()
        ])

    def group(name: str, inside: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), inside.alias("counts"))

    worked = F.concat(
        F.when(kind == "MAP", counts(MAP_INPUT_RECORDS=size)).otherwise(
            counts(REDUCE_INPUT_RECORDS=size, REDUCE_SHUFFLE_BYTES=size * 3)
        ),
        counts(GC_TIME_MILLIS=seconds * 25, CPU_MILLISECONDS=seconds * 1000,
               PHYSICAL_MEMORY_BYTES=size * 10, COMMITTED_HEAP_BYTES=size * 20),
    )
    groups = F.array(
        group("org.apache.hadoop.mapreduce.FileSystemCounter", counts(HDFS_BYTES_READ=size * 1000, FILE_BYTES_READ=size)),
        group("org.apache.hadoop.mapreduce.TaskCounter", worked),
    )
    start = _launch(c("l_suppkey") % 20)

    def event(type_: Column, what: Column) -> Column:
        return F.to_json(F.struct(type_.alias("type"), F.create_map(F.lit("Event"), what).alias("event")))

    started = event(F.concat(kind, F.lit("_ATTEMPT_STARTED")), F.struct(
        attempt.alias("attemptId"), kind.alias("taskType"), start.alias("startTime"),
        _text("node", c("l_partkey") % 8).alias("trackerName"),
        F.when(c("l_returnflag") == "R", "SPECULATIVE").otherwise("VIRGIN").alias("avataar"),
    ))
    outcome = F.when(fate == 1, "FAILED").when(fate == 2, "KILLED")
    ended = event(
        F.concat(kind, F.lit("_ATTEMPT_"), F.coalesce(outcome, F.lit("FINISHED"))),
        F.struct(
            attempt.alias("attemptId"), kind.alias("taskType"), (start + seconds * 1000).alias("finishTime"),
            outcome.alias("status"), F.when(outcome.isNull(), "SUCCEEDED").alias("taskStatus"),
            F.when(fate == 1, _text("Error: ", c("l_orderkey"))).alias("error"),
            F.struct(F.lit("COUNTERS").alias("name"), groups.alias("groups")).alias("counters"),
        ),
    )
    lines = F.when(fate == 0, F.array(started)).otherwise(F.array(ended, started))
    return table(spark, sf_dir, "lineitem").select(F.explode(F.concat(
        lines, F.when(c("l_linenumber") == 1, F.array(F.lit("Avro-Json"))).otherwise(F.array().cast("array<string>"))
    )).alias("value"))
