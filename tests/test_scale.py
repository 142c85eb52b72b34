"""Shared steps on larger inputs: what is written, sorted and joined on the way."""

import gzip
import json

from pyspark.sql import functions as F

from conftest import rows
from opdiag.operators import jobs, lineage
from opdiag.operators.sized import cut
from opdiag.sinks import ledger
from opdiag.sources import eventlog, fsimage, jobhistory, plangraph
from opdiag.suite import fixtures, queries


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_attempts_are_not_sorted_before_they_are_brought_together(spark):
    lines = spark.createDataFrame([("x",)], "value string")
    plan = plan_of(jobhistory.attempts(lines))
    assert plan.count("Exchange") == 1 and plan.rindex("Aggregate") < plan.index("Exchange")


def test_written_lines_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_LOG_LINES", 10)
    folder = f"file:{tmp_path}/lines"
    lines = spark.range(25).select(F.concat(F.lit("line "), "id").alias("value")).coalesce(1)
    queries._write_lines(lines, folder)
    files = list((tmp_path / "lines").glob("part-*"))
    assert len(files) == 3 and all(file.name.endswith(".gz") for file in files)
    assert rows(spark.read.text(folder)) == rows(lines)


def test_tasks_of_few_applications_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    shape = "app string, value string"
    made = [(f"application_1_000{n % 3}", f"line {n}") for n in range(30)] + [(None, "no application")]
    found = {}

    def kept(lines, folder, by=()):
        found["writers"] = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
        lines.write.partitionBy(*by).text(folder)

    monkeypatch.setattr(queries, "_write_lines", kept)
    monkeypatch.setattr(queries.fx, "task_end_events", lambda s, d: spark.createDataFrame(made, shape))
    queries._event_log(spark, "")
    assert int(found["writers"]) > 3
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_every_application_gets_one_log(spark, tmp_path, monkeypatch):
    made = [(f"app-1-{n % 20}", f"line {n}") for n in range(1000)] + [(None, "no application")]
    lines = spark.createDataFrame(made, "app string, value string").repartition(8)
    folder = f"{tmp_path}/logs"
    queries._write_logs(lines, folder)
    assert len(list((tmp_path / "logs").iterdir())) == 21
    read = eventlog.read_lines(spark, folder).select("app_id", "value")
    assert rows(read) == rows(lines.select("app", "value"))
    monkeypatch.setattr(queries, "_LOG_LINES", 1)
    long = spark.createDataFrame([("app-2-1", f"line {n}") for n in range(30_000)], "app string, value string")
    queries._write_logs(long, f"{tmp_path}/long")
    assert rows(eventlog.read_lines(spark, f"{tmp_path}/long").select("app_id", "value")) == rows(long)
    assert len(list((tmp_path / "long").iterdir())) > 1


def test_rows_are_not_joined_with_the_ledger_unless_a_file_was_loaded_again(spark, tmp_path):
    logs, target = tmp_path / "logs", f"{tmp_path}/landed"
    logs.mkdir()

    def write(name: str, n: int) -> None:
        line = json.dumps({"Event": "SparkListenerJobEnd", "Job ID": 1}, separators=(",", ":"))
        (logs / name).write_text((line + "\n") * n)

    write("app-1-1", 3)
    write("app-1-2", 2)
    assert eventlog.land_new(spark, str(logs), target) == 2
    landed = eventlog.landed_new(spark, target)
    assert "Join" not in plan_of(landed) and landed.count() == 5
    write("app-1-2", 7)
    assert eventlog.land_new(spark, str(logs), target) == 1
    assert eventlog.landed_new(spark, target).groupBy("app_id").count().orderBy("app_id").collect() == [
        ("app-1-1", 3), ("app-1-2", 7),
    ]
    assert ledger.loaded(spark, f"{tmp_path}/none", "app_id string").count() == 0


def test_plan_nodes_are_written_without_their_subtrees(spark):
    tree = {"nodeName": "Scan t", "simpleString": "scan", "children": [], "metrics": [{"name": "rows", "accumulatorId": 1}]}
    for level in range(10):
        tree = {"nodeName": f"Project {level}", "simpleString": "", "children": [tree], "metrics": []}
    event = {"Event": "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart", "executionId": 1, "sparkPlanInfo": tree}
    lines = spark.createDataFrame([("a", json.dumps(event, separators=(",", ":")))], "app_id string, value string")
    nodes = plangraph.plan_nodes(lines)
    assert "variant" not in plan_of(nodes)
    assert nodes.count() == 11 and rows(nodes.where("accumulator = 1"), "node") == [("Scan t",)]


def test_newest_listing_may_be_a_folder_of_part_files(spark, tmp_path):
    import os

    for age, (name, part) in enumerate((("a_1", "part-0"), ("a_2", "part-0"), ("a_1", "part-1"), ("b", "part-0"))):
        (tmp_path / name).mkdir(exist_ok=True)
        (tmp_path / name / part).write_text("x")
        os.utime(tmp_path / name / part, (1000 + age, 1000 + age))
    (tmp_path / "a_3").write_text("x")
    os.utime(tmp_path / "a_3", (1000, 1000))
    assert fsimage.newest_file(spark, str(tmp_path), "a_*").endswith("/a_1")
    assert fsimage.newest_file(spark, str(tmp_path)).endswith("/b")


def test_logs_of_a_host_are_written_by_several_tasks(spark, tmp_path):
    lines = spark.range(1000).select(F.concat(F.lit("line "), "id").alias("value"), F.lit("h").alias("server_ip"))
    queries._host_files(spark, lines, "yarn-NODEMANAGER", str(tmp_path / "logs"))
    assert len(list((tmp_path / "logs").glob("yarn-NODEMANAGER-h.log.*"))) > 8


def test_tasks_are_dealt_out_before_they_are_sorted(spark):
    shape = "project_id bigint, project_name string, process_id bigint, process_name string, process_definition_json string"
    plan = plan_of(lineage.workflow_tasks(spark.createDataFrame([], shape).union(spark.createDataFrame(
        [(1, "p", 1, "w", '{"tasks":[{"name":"a","type":"SHELL"}]}')], shape
    ))))
    assert "REBALANCE" in plan


def test_tasks_are_dealt_out_without_a_sort_of_a_stored_block(spark):
    shape = "project_id bigint, project_name string, process_id bigint, process_name string, process_definition_json string"
    document = '{"tasks":[{"name":"a","type":"SHELL"},{"name":"b","type":"SHELL"},{"name":"a","type":"PYTHON"}]}'
    made = spark.createDataFrame([(1, "p", n, "w", document) for n in (1, 1, None)], shape)
    tasks = lineage.workflow_tasks(made)
    assert "RoundRobinPartitioning" not in plan_of(tasks)
    assert rows(tasks, "process_id", "task_name") == [(1, "b"), (None, "b")]


def test_tasks_are_not_held_while_they_are_dealt_to_many_parts(spark):
    shape = "project_id bigint, project_name string, process_id bigint, process_name string, process_definition_json string"
    document = '{"tasks":[{"name":"a","type":"SHELL"},{"name":"a","type":"PYTHON"}]}'
    made = spark.createDataFrame([(1, "p", n, "w", document) for n in range(9)], shape)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "640")
    try:
        tasks = plan_of(lineage._defined_tasks(made))
    finally:
        spark.conf.set(key, before)
    # more parts than files that a task of a shuffle has open at once would be sorted in its memory
    dealt = [line for line in tasks.splitlines() if "REBALANCE" in line]
    assert dealt and all("640" not in line for line in dealt)


def test_plans_are_dealt_out_without_a_sort_of_a_stored_block(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(plangraph, "cut", lambda frame: (plans.append(plan_of(frame)), cut(frame))[1])
    event = '{"Event":"org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart","executionId":1,"sparkPlanInfo":{"nodeName":"Scan"}}'
    lines = spark.createDataFrame([("a", event), ("a", event), (None, event)], "app_id string, value string")
    assert rows(plangraph.plan_nodes(lines), "app_id", "node") == [("a", "Scan"), (None, "Scan")]
    assert "REBALANCE" in plans[0] and not any("RoundRobinPartitioning" in plan for plan in plans)


def test_landed_lines_are_in_files_of_a_bounded_length_before_compression(spark, tmp_path):
    logs, target = tmp_path / "logs", tmp_path / "landed"
    logs.mkdir()
    line = json.dumps({"Event": "SparkListenerJobEnd", "Job ID": 1, "text": "x" * 1000}, separators=(",", ":"))
    for n in range(8):
        (logs / f"app-1-{n}").write_text((line + "\n") * 2000)  # 2 MB
    before = {key: spark.conf.get(key) for key in CHANGED}
    eventlog.land_new(spark, str(logs), str(target), file_bytes=200_000)
    assert {key: spark.conf.get(key) for key in CHANGED} == before
    assert len(list((target / "rows").rglob("*.parquet"))) > 4
    assert eventlog.landed_new(spark, str(target)).count() == 16_000


CHANGED = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_kinds_are_landed_without_a_sort(spark, tmp_path, monkeypatch):
    (tmp_path / "app-1-1").write_text('{"Event":"SparkListenerJobEnd","Job ID":1}\n')
    found = []
    load = ledger.load_new
    monkeypatch.setattr(ledger, "load_new", lambda *a, **k: (
        found.append(int(spark.conf.get(CHANGED[0]))), load(*a, **k))[1])
    assert eventlog.land_new(spark, str(tmp_path), f"{tmp_path}/../landed") == 1
    assert found[0] >= len(eventlog.KINDS)


def test_logs_keep_empty_and_foreign_lines_in_order(spark, tmp_path):
    made = [("app-1-1", None, 0), ("app-1-1", "", 1), ("app-1-1", "grüße 漢", 2), (None, "a", 3), ("", "b", 4)]
    lines = spark.createDataFrame(made, "app string, value string, n int").coalesce(1)
    queries._write_logs(lines, f"{tmp_path}/logs")
    read = {name.name: gzip.decompress(name.read_bytes()) for name in (tmp_path / "logs").iterdir() if name.suffix == ".gz"}
    assert sorted(read["app=app-1-1.0.gz"].decode().split("\n")) == ["", "", "", "grüße 漢"]
    assert sorted(read["app=__HIVE_DEFAULT_PARTITION__.0.gz"].split()) == [b"a", b"b"]


def test_written_logs_are_the_bytes_of_the_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_LOG_LEVEL", 0)
    text = "x" * 20_000
    queries._write_logs(spark.createDataFrame([("app-1-1", text)], "app string, value string"), f"{tmp_path}/logs")
    assert (tmp_path / "logs" / "app=app-1-1.0.gz").stat().st_size > 20_000


def test_a_first_load_reads_a_folder_by_its_name_and_each_file_once(spark, tmp_path):
    logs, target = tmp_path / "logs", f"{tmp_path}/target"
    logs.mkdir()
    asked = []

    def read(paths):
        asked.append(paths)
        if len(asked) == 1:  # arrives after the listing
            (logs / "late log").write_text("line\n" * 3)
        return spark.read.text(paths).select(
            "value", F.col("_metadata.file_path").alias("file"), F.lit("").alias("part")
        )

    def load() -> int:
        return ledger.load_new(spark, ledger.listed(spark, str(logs)), read, target, folder=str(logs))

    assert load() == 0 and asked == []
    for name in ("a", "b"):
        (logs / name).write_text("line\n" * 2)
    assert load() == 2 and asked == [[str(logs)]]
    assert ledger.loaded(spark, target, "value string").count() == 7
    assert load() == 1 and load() == 0
    assert ledger.loaded(spark, target, "value string").count() == 7
    (logs / "b").write_text("line\n" * 5)
    assert load() == 1 and len(asked[-1]) == 1
    assert ledger.loaded(spark, target, "value string").count() == 10


def test_plan_events_read_the_tasks_once(spark, monkeypatch):
    shape = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double"
    made = [(n, n % 9, n % 4 if n % 5 else None, 1, 2.0) for n in range(60)]
    monkeypatch.setattr(fixtures, "table", lambda s, d, name: s.createDataFrame(made, shape))
    stages = fixtures.sparse_stage(spark, "")
    spans = fixtures.sparse_task(spark, "").groupBy("app_id", "stage_id").agg(
        F.min("launch_ms"), F.max(F.col("launch_ms") + F.col("duration_ms"))
    )
    assert rows(stages) == rows(spans) and stages.where("app_id is null").count() > 0
    assert "ExistingRDD" not in plan_of(fixtures.plan_events(spark, ""))


def test_plans_are_parsed_after_they_were_dealt_out_only(spark, monkeypatch):
    plans, head = [], '{"Event":"org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"'
    monkeypatch.setattr(plangraph, "cut", lambda frame: (plans.append(plan_of(frame)), cut(frame))[1])
    made = [("a", head + text) for text in (
        ',"executionId":1,"sparkPlanInfo":{"nodeName":"Scan"}}', ',"executionId":2}', ',"executionId":3,"sparkPla',
    )]
    nodes = plangraph.plan_nodes(spark.createDataFrame(made, "app_id string, value string"))
    assert rows(nodes, "execution_id", "node") == [(1, "Scan")]
    assert plans[0].count("parseJson") == 1


def test_plan_nodes_are_not_broadcast(spark):
    start = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"

    def events(n):
        scan = {"nodeName": "Scan parquet t", "simpleString": "PartitionFilters: []", "children": [],
                "metrics": [{"name": plangraph.ROWS, "accumulatorId": 10 * n}, {"name": "size", "accumulatorId": 10 * n + 1}]}
        yield {"Event": start, "executionId": n, "sparkPlanInfo": scan}
        values = [{"ID": 10 * n, "Value": f"{20_000_000 + n}"}, {"ID": 10 * n + 1, "Value": None}]
        for stage in (2 * n, 2 * n + 1)[: 1 + n % 2]:
            yield {"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": stage, "Accumulables": values}}

    made = [(f"app {n % 3}" if n % 5 else None, json.dumps(e, separators=(",", ":"))) for n in range(30) for e in events(n)]
    lines = spark.createDataFrame(made, "app_id string, value string")
    # the files of equal plans are smaller than any limit for broadcasts
    ran = plangraph.stage_nodes(plangraph.plan_nodes(lines), plangraph.stage_accumulators(lines))
    known = [(f"app {n % 3}", n, 2 * n + more, 20_000_000 + n) for n in range(30) if n % 5 for more in range(1 + n % 2)]
    for frame in (ran, jobs.open_scans(ran)):
        assert rows(frame, "app_id", "execution_id", "stage_id", "rows_out") == sorted(known, key=str)
        plan = plan_of(frame)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_tasks_are_sorted_in_parts_that_are_not_merged_again(spark):
    shape = "project_id bigint, project_name string, process_id bigint, process_name string, process_definition_json string"
    document = '{"tasks":[{"name":"a","type":"SHELL"},{"name":"a","type":"PYTHON"},{"name":"b","type":"SHELL"}]}'
    made = [(1, "p", n if n % 5 else None, "w", document) for n in range(40)]
    made += [(1, "p", 100, "w", text) for text in (None, "", '{"tasks":[]}', '{"tasks":nul')]
    defined = lineage._defined_tasks(spark.createDataFrame(made, shape))
    plan = plan_of(defined)
    # the definitions are dealt out unread, and the aggregate takes the parts as they were asked for
    assert plan.count("from_json") == 1 and plan.index("from_json") < plan.index("REBALANCE")
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
    assert rows(defined, "process_id", "task_name", "task_type") == rows(spark.createDataFrame(
        [(n, name, kind) for n in [None, *(n for n in range(40) if n % 5)] for name, kind in (("a", "PYTHON"), ("b", "SHELL"))],
        "process_id bigint, task_name string, task_type string",
    ))


def test_logs_are_sorted_in_parts_of_a_bounded_size(spark, tmp_path, monkeypatch):
    key, found = "spark.sql.adaptive.advisoryPartitionSizeInBytes", []
    made = spark.createDataFrame([("app-1-1", "x")], "app string, value string")
    before = spark.conf.get(key)
    arranged = type(made).sortWithinPartitions
    monkeypatch.setattr(type(made), "sortWithinPartitions", lambda self, *by: (found.append(spark.conf.get(key)), arranged(self, *by))[1])
    queries._write_logs(made, f"{tmp_path}/logs")
    assert found == [str(2**24)] and spark.conf.get(key) == before


def test_event_lines_are_parsed_once(spark):
    head = '{"Event":"org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"'
    made = [("a", head + text) for text in (
        ',"executionId":1,"physicalPlanDescription":"p"}', ',"physicalPlanDescription":"q"}', ',"executionId":2,"physicalPl', "",
    )]
    lines = spark.createDataFrame(made, "app_id string, value string")
    plans = eventlog.plans(lines)
    assert plan_of(plans).count("from_json") == 1
    assert rows(plans) == [("a", 1, "p")]


def test_kinds_are_found_in_the_head_of_a_line(spark):
    made = [
        '{"Event":"SparkListenerJobEnd","Job ID":1,"text":"' + "x" * 1000 + '"}', '{"Event":"SparkListenerJobEnd"}',
        '{"Event":"SparkListenerJobEnd', '{"Event":"Other","a":"SparkListenerJobEnd"}', '{"Event":"a.SparkListenerJobStart","b', "", None,
    ]
    lines = spark.createDataFrame([(line,) for line in made], "value string")
    kinds = eventlog._by_kind(lines)
    assert sorted(row.kind for row in kinds.collect()) == ["SparkListenerJobEnd", "SparkListenerJobEnd", "SparkListenerJobStart"]
    assert "substring_index" in plan_of(kinds)
