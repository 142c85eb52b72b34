import datetime as dt
import statistics
import random
import json

from conftest import rows

from opdiag import schemas
from opdiag.defaults import Fixed
from opdiag.operators import closure, lineage, runs

DAY = "2024-01-10"


def definitions(spark, *documents, state=1, update="2024-01-09 10:00:00"):
    """Documents as process id -> tasks."""
    data = [
        (pid, f"p{pid}", 100, state, update, json.dumps({"tasks": tasks}))
        for pid, tasks in documents
    ]
    frame = spark.createDataFrame(data, schemas.PROCESS_DEFINITION)
    projects = spark.createDataFrame([(100, "proj"), (1, "hidden")], schemas.PROJECT)
    return lineage.released_definitions(frame, projects, DAY)


def shell(name, *pre, **more):
    return {"name": name, "type": "SHELL", "preTasks": list(pre), **more}


def depends(name, *items):
    listed = [{"dependItemList": list(items)}]
    return {"name": name, "type": "DEPENDENT", "dependence": {"dependTaskList": listed}}


def sub(name, pid, *pre):
    return {"name": name, "type": "SUB_PROCESS", "preTasks": list(pre), "params": {"processDefinitionId": pid}}


def test_released(spark):
    assert definitions(spark, (7, [])).count() == 1
    assert definitions(spark, (7, []), state=0).count() == 0
    assert definitions(spark, (7, []), update="2024-01-10 23:59:59").count() == 1
    assert definitions(spark, (7, []), update="2024-01-11 00:00:00").count() == 0
    frame = spark.createDataFrame([(7, "p", 1, 1, "2024-01-01", "{}")], schemas.PROCESS_DEFINITION)
    projects = spark.createDataFrame([(1, "hidden")], schemas.PROJECT)
    assert lineage.released_definitions(frame, projects, DAY).count() == 0
    assert lineage.released_definitions(frame, projects, DAY, (2,)).count() == 1


def test_tasks_of_a_workflow(spark):
    frame = definitions(
        spark,
        (7, [shell("a"), {"name": "py", "type": "PYTHON"}, sub("s", 9), {"name": "a", "type": "SHELL"},
             shell("gone"), {"name": "gone", "type": "PYTHON"}]),
    )
    assert rows(lineage.workflow_tasks(frame), "task_id", "task_name", "task_type") == [
        ("7-a", "a", "SHELL"), ("9", "s", "SUB_PROCESS"),
    ]


def test_lineage_rows(spark):
    frame = definitions(
        spark,
        (7, [
            shell("a"),
            shell("b", "a", dependence=None),
            depends("d", {"projectId": 5, "definitionId": 8, "depTasks": "ALL"},
                    {"projectId": 5, "definitionId": 8, "depTasks": "x"}, {"depTasks": "a"}),
            shell("c", "d", "b"),
            shell("e", "ghost"),
        ]),
    )
    got = rows(
        lineage.task_lineage_rows(frame, DAY).where("task_id != '7'"),
        "task_name", "pre_project_id", "pre_process_id", "pre_task_id", "pre_task_name",
    )
    assert got == sorted(
        [
            ("a", None, None, None, None),
            ("b", 100, 7, "7-a", "a"),
            ("c", 5, 8, None, "ALL"), ("c", 5, 8, "8-x", "x"), ("c", 100, 7, "7-a", "a"),
            ("c", 100, 7, "7-b", "b"),
        ],
        key=str,
    )
    contained = lineage.task_lineage_rows(frame, DAY).where("task_id = '7'")
    assert {r.pre_task_name for r in contained.collect()} == {"a", "b", "c", "e"}
    assert rows(lineage.rejected_pre_tasks(frame), "task_name", "pre_task_name") == [("e", "ghost")]


def edge(src, dst, label=Fixed.DEPENDS):
    return (*src.split(":"), *dst.split(":"), label)


def test_edges_strict_and_extended(spark):
    frame = definitions(
        spark,
        (7, [shell("a"), sub("s", 8, "a"), shell("b", "s", "a"), shell("loop", "loop")]),
        (8, [shell("x"), depends("d", {"projectId": 1, "definitionId": 7, "depTasks": "ALL"},
                                 {"projectId": 1, "definitionId": 99, "depTasks": "ALL"}), shell("y", "d")]),
    )
    has = [edge(f"process:{p}", f"task:{p}-{t}", Fixed.CONTAINS) for p, t in
           ((7, "a"), (7, "b"), (7, "loop"), (8, "x"), (8, "y"))]
    strict = has + [edge("task:7-b", "task:7-a"), edge("task:7-loop", "task:7-loop"), edge("task:8-y", "process:7")]
    assert rows(lineage.lineage_edges(frame)) == sorted(strict, key=str)
    more = [edge("process:7", "process:8", Fixed.CONTAINS), edge("process:7", "process:8"),
            edge("process:8", "task:7-a"), edge("task:7-b", "process:8")]
    assert rows(lineage.lineage_edges(frame, "extended")) == sorted(strict + more, key=str)


def test_mutual_edges_and_dedupe(spark):
    data = [edge("task:b", "task:a"), edge("task:a", "task:b"), edge("task:a", "task:b"),
            edge("task:a", "task:a"), edge("task:a", "task:c"), edge("task:c", "task:a", "other")]
    frame = spark.createDataFrame(data, lineage.EDGE)
    assert rows(lineage.mutual_edges(frame)) == [("task", "a", "task", "b", Fixed.DEPENDS)]
    assert lineage.edge_dedupe(frame).count() == 5


def chain(spark, length, *extra):
    links = [edge("process:p", "task:1")] + [edge(f"task:{i}", f"task:{i + 1}") for i in range(1, length)]
    return spark.createDataFrame(links + list(extra), lineage.EDGE)


def test_closure_hop_limit_and_cycles(spark):
    starts = spark.createDataFrame([("process", "p")], ["kind", "id"])
    frame = chain(spark, 20, edge("task:5", "task:2"), edge("task:3", "process:p"), edge("task:4", "task:4"))
    found = rows(closure.reachable(frame, starts), "id", "hop")
    assert dict(found) == {str(i): i for i in range(1, 14)}
    sizes = [closure.reachable(frame, starts, n).count() for n in (1, 5, 14)]
    assert sizes == [1, 5, 14]
    assert closure.reachable(chain(spark, 3), starts).count() == 3


def test_closure_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        starts = spark.createDataFrame([("process", "p")], ["kind", "id"])
        assert closure.reachable(chain(spark, 20), starts).count() == 13
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dependence_on_an_empty_list_is_no_edge(spark):
    text = (
        '{"tasks":[{"name":"a","type":"SHELL","preTasks":["dep","own"]},'
        '{"name":"own","type":"SHELL","preTasks":[]},'
        '{"name":"dep","type":"DEPENDENT","dependence":{"dependTaskList":[]}}]}'
    )
    frame = spark.createDataFrame([(1, "p", 7, "f", text), (1, "p", 8, "g", text[:-4]), (1, "p", 9, "h", None)], (
        "project_id long, project_name string, process_id long, process_name string, "
        "process_definition_json string"
    ))
    edges = rows(lineage.lineage_edges(frame), "src_id", "dst_id")
    assert edges == [("7", "7-a"), ("7", "7-own"), ("7-a", "7-own")]
    made = lineage.task_lineage_rows(frame, "2024-01-01").where("task_id = '7-a'")
    assert rows(made, "pre_task_id") == [("7-own",)]
    assert rows(lineage.rejected_definitions(frame), "process_id") == [(8,), (9,)]


def test_raw_relations_name_sub_processes(spark):
    text = '{"tasks":[{"name":"s","type":"SUB_PROCESS","preTasks":["gone"],"params":{"processDefinitionId":99}}]}'
    frame = spark.createDataFrame([(1, "p", 7, "f", text)], (
        "project_id long, project_name string, process_id long, process_name string, "
        "process_definition_json string"
    ))
    raw = rows(lineage.all_edges(frame, "raw"), "src_kind", "src_id", "dst_kind", "dst_id")
    assert raw == [("process", "7", "process", "99"), ("process", "7", "task", "99")]


def made_runs(spark, *made):
    shape = schemas.WORKFLOW_RUN
    return spark.createDataFrame(
        [(1, "t", at(s).date() if d is None else d, n, 0, "SUCCESS", at(s), took)
         for n, (s, took, d) in enumerate(made)], shape
    )


def test_a_run_over_midnight_is_not_early(spark):
    made = [(f"2024-01-{d:02d} 23:50:00", 540, None) for d in range(1, 16)]
    made += [("2024-01-16 23:50:00", 630, None), ("2024-01-17 23:50:00", 4000, None)]
    found = rows(runs.end_time_anomalies(made_runs(spark, *made)), "dt", "end_second", "verdict")
    assert found == [(dt.date(2024, 1, 17), 23 * 3600 + 50 * 60 + 4000, "late")]


def test_monthly_tasks_have_a_baseline_of_runs(spark):
    made = [(f"2023-{m:02d}-01 06:00:00", 100, None) for m in range(1, 13)] + [("2024-01-01 06:00:00", 900, None)]
    frame = made_runs(spark, *made)
    assert rows(runs.duration_anomalies(frame), "dt", "usual") == [(dt.date(2024, 1, 1), 100.0)]
    judged = runs.duration_anomalies(frame, since="2024-01-01", until="2024-01-31", history_days=200)
    assert rows(judged, "usual", "verdict") == [(100.0, "long")]
    assert runs.duration_anomalies(frame, since="2023-12-01", until="2023-12-31").count() == 0


def test_rare_tasks_are_judged_alike_with_since(spark):
    made = [(f"{y}-{m:02d}-01 06:00:00", 10 if y < 2023 else 100, None) for y in range(2020, 2024) for m in (1, 4, 7, 10)]
    frame = made_runs(spark, *made)
    whole = rows(runs.duration_anomalies(frame).where("dt = '2023-10-01'"), "usual", "verdict")
    ranged = runs.duration_anomalies(frame, since="2023-10-01", until="2023-10-01")
    assert rows(ranged, "usual", "verdict") == whole == [(10.0, "long")]


def test_baselines_against_brute_force(spark):
    draw = random.Random(8)
    made = [(f"2024-01-{draw.randint(1, 9):02d} {draw.randint(0, 3):02d}:{draw.randint(0, 59):02d}:00",
             draw.randint(1, 50), None) for _ in range(120)]
    frame = made_runs(spark, *made)
    ordered = sorted((at(s), n, took) for n, (s, took, _) in enumerate(made))
    expected = {}
    for place, (_, number, _) in enumerate(ordered):
        before = [took for _, _, took in ordered[max(0, place - 14) : place]]
        if before:
            expected[number] = statistics.median(before)
    got = {r.attempt_id: r.usual for r in runs._baseline(frame, "duration_s", 14).collect()}
    assert got == expected


def at(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def schedule(spark, *attempts):
    """Attempts as (id, definition, instance, start, end, retries)."""
    data = [(i, "t", d, inst, at(s), at(s), at(e) if e else None, r) for i, d, inst, s, e, r in attempts]
    instances = spark.createDataFrame(data, schemas.TASK_INSTANCE)
    both = spark.createDataFrame(
        [(1, "p", 10, 1, "", ""), (2, "p", 20, 1, "", "")], schemas.PROCESS_DEFINITION
    )
    projects = spark.createDataFrame([(10, "x"), (20, "y")], schemas.PROJECT)
    watched = [(dt.date(2024, 1, d), "", "", "", n, "p", "t", None) for d in (9, 10) for n in ("x", "y")]
    return spark.createDataFrame(watched, schemas.MONITORED_TASK), instances, both, projects


TODAY, LAST = "2024-01-10", "2024-01-09"


def test_day_over_day_limits_retries_and_fan_out(spark):
    plan = schedule(
        spark,
        # two attempts of one instance: time runs from the first start to the last end
        (1, 1, 100, "2024-01-10 05:59:59", "2024-01-10 06:10:00", 0),
        (2, 1, 100, "2024-01-10 05:59:59", "2024-01-10 06:29:59", 1),
        # at the cut-off: excluded today, included on the previous day
        (3, 2, 200, "2024-01-10 06:00:00", "2024-01-10 06:01:00", 0),
        (4, 1, 90, "2024-01-09 06:00:00", "2024-01-09 06:10:00", 2),
        (5, 2, 91, "2024-01-09 05:00:00", "2024-01-09 05:00:00", 3),
    )
    shown = ["project_name", "taken_minute", "lastday_taken_minute", "start_diff_second", "dod",
             "retry_times", "lastday_retry_times"]
    wide = rows(runs.key_task_day_over_day(*plan, TODAY, LAST), *shown)
    assert wide == sorted(
        [("x", 30.0, 10.0, -1, 2.0, "0", "2"), ("x", 30.0, 0.0, 3599, None, "0", "3")], key=str
    )
    narrow = rows(runs.key_task_day_over_day(*plan, TODAY, LAST, match_project=True), *shown)
    assert narrow == [("x", 30.0, 10.0, -1, 2.0, "0", "2")]


def test_day_over_day_without_previous_day_or_end(spark):
    plan = schedule(spark, (1, 1, 100, "2024-01-10 00:00:00", None, 0))
    row = runs.key_task_day_over_day(*plan, TODAY, LAST).first()
    assert (row.taken_minute, row.lastday_taken_minute, row.dod, row.lastday_retry_times) == (None,) * 4


def run_rows(spark, *data):
    """Runs as (task, day of January, attempt, retries, state, start, seconds)."""
    full = [(1, t, dt.date(2024, 1, d), a, r, s, at(f"2024-01-{d:02d} {h}"), n) for t, d, a, r, s, h, n in data]
    return spark.createDataFrame(full, schemas.WORKFLOW_RUN)


def test_failures(spark):
    frame = run_rows(
        spark,
        ("a", 1, 1, 0, "FAILURE", "01:00:00", 1), ("a", 1, 2, 2, "SUCCESS", "02:00:00", 1),
        ("b", 1, 1, 0, "SUCCESS", "01:00:00", 1), ("b", 1, 2, 1, "FAILURE", "02:00:00", 1),
        ("b", 11, 3, 0, "FAILURE", "02:00:00", 7201), ("b", 10, 4, 1, "SUCCESS", "02:00:00", 7200),
    )
    assert rows(runs.final_failures(frame), "task_name", "attempt_id") == [("b", 2), ("b", 3)]
    assert rows(runs.first_failures(frame), "task_name", "attempt_id") == [("a", 2)]
    assert rows(runs.long_failures(frame, "2024-01-11"), "task_name", "failed_days") == [("b", 1)]
    assert rows(runs.long_failures(frame, "2024-01-10"), "task_name", "failed_days") == [("b", 1)]
    assert rows(runs.long_running(frame), "attempt_id") == [(3,)]


def test_anomalies_against_the_days_before(spark):
    usual = [("a", d, d, 0, "SUCCESS", "01:00:00", 100) for d in range(1, 8)]
    frame = run_rows(
        spark, *usual,
        ("a", 2, 50, 0, "FAILURE", "01:00:00", 9999),
        ("a", 8, 51, 0, "SUCCESS", "01:00:00", 201), ("a", 9, 52, 0, "SUCCESS", "01:00:00", 49),
        ("a", 10, 53, 0, "SUCCESS", "01:00:00", 200), ("a", 21, 54, 0, "SUCCESS", "01:31:00", 100),
        ("a", 30, 55, 0, "SUCCESS", "01:30:00", 100),
    )
    assert rows(runs.duration_anomalies(frame), "attempt_id", "usual", "verdict") == [
        (51, 100.0, "long"), (52, 100.0, "short"),
    ]
    # the history of day 21 are days 7 to 10, that of day 30 is day 21 alone
    assert rows(runs.end_time_anomalies(frame), "attempt_id", "verdict") == [(54, "late")]


def test_closure_of_nothing(spark):
    none = spark.createDataFrame([], "kind string, id string")
    starts = spark.createDataFrame([("process", "p")], ["kind", "id"])
    assert closure.reachable(chain(spark, 3), none).count() == 0
    assert closure.reachable(chain(spark, 3), none.where("1 = 0")).count() == 0
    assert closure.reachable(chain(spark, 3).where("1 = 0"), starts).count() == 0
    assert closure.reachable(chain(spark, 3).limit(0), starts.limit(0)).count() == 0
