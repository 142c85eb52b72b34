"""Loading once, run baselines from day to day, plan graphs, and streams with state."""

import datetime as dt
import json
import os

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from opdiag import flows, schemas
from opdiag.operators import baselines, jobs, runs
from opdiag.sinks import ledger
from opdiag.sources import eventlog, plangraph
from opdiag.streaming import containers as streams

NM = "2024-01-05 {}:00:01,250 INFO x.ContainerImpl: Container container_1_1_01_{:06d} transitioned from NEW to DONE"


def log_file(folder, host, *lines, modified=None):
    path = folder / f"yarn-NODEMANAGER-{host}.log"
    path.write_text("\n".join(NM.format(hour, number) for hour, number in lines) + "\n")
    if modified:
        os.utime(path, (modified, modified))


def loaded_numbers(spark, target, **hours):
    found = flows.logged(spark, target, **hours).select(F.right("container_id", F.lit(2)).cast("int"))
    return sorted(row[0] for row in found.collect())


def test_hours_are_loaded_once_whatever_arrives_when(spark, tmp_path):
    folder, target = tmp_path / "logs", str(tmp_path / "loaded")
    folder.mkdir()
    log_file(folder, "a", ("09", 1), ("10", 2), ("11", 3))
    assert flows.log_hour(spark, str(folder), "2024-01-05 10", target) == 1
    assert loaded_numbers(spark, target) == [1, 2]
    assert flows.log_hour(spark, str(folder), "2024-01-05 10", target) == 0
    # the file grows, in its last hour and in one that was loaded before; another file is late
    log_file(folder, "a", ("09", 1), ("10", 2), ("11", 3), ("11", 4), ("09", 5), modified=2_000_000_000)
    log_file(folder, "b", ("08", 6))
    assert flows.log_hour(spark, str(folder), "2024-01-05 10", target) == 2
    assert loaded_numbers(spark, target) == [1, 2, 5, 6]
    assert flows.log_hour(spark, str(folder), "2024-01-05 11", target) == 2
    assert loaded_numbers(spark, target) == [1, 2, 3, 4, 5, 6]
    assert loaded_numbers(spark, target, since="2024-01-05 09", until="2024-01-05 10") == [1, 2, 5]
    # only the parts that changed were written again
    written = ledger.entries(spark, f"{target}/yarn-NODEMANAGER").where("part is not null")
    assert rows(written, "load", "part", "n") == [
        (1, "2024-01-05 09", 1), (1, "2024-01-05 10", 1),
        (2, "2024-01-05 08", 1), (2, "2024-01-05 09", 2), (3, "2024-01-05 11", 2),
    ]


def test_rows_of_a_broken_load_do_not_count(spark, tmp_path):
    folder, target = tmp_path / "logs", tmp_path / "loaded"
    folder.mkdir()
    log_file(folder, "a", ("09", 1))
    flows.log_hour(spark, str(folder), "2024-01-05 10", str(target))
    first = target / "yarn-NODEMANAGER"
    # rows without an entry in the ledger, as a load leaves them that ends before its commit
    spark.read.parquet(str(first / "rows" / "load=1")).write.parquet(str(first / "rows" / "load=2"))
    assert loaded_numbers(spark, str(target)) == [1]
    log_file(folder, "b", ("10", 2))
    flows.log_hour(spark, str(folder), "2024-01-05 10", str(target))
    assert loaded_numbers(spark, str(target)) == [1, 2]


def test_landing_writes_few_files_and_each_log_once(spark, tmp_path):
    logs, target = tmp_path / "logs", str(tmp_path / "landed")
    logs.mkdir()
    for app in range(30):
        lines = [{"Event": "SparkListenerJobEnd", "Job ID": n, "Completion Time": 1} for n in range(3)]
        (logs / f"application_1_{app:04d}").write_text(
            "\n".join(json.dumps(line, separators=(",", ":")) for line in lines) + "\n"
        )
    assert eventlog.land_new(spark, str(logs), target) == 30
    assert eventlog.land_new(spark, str(logs), target) == 0
    landed = eventlog.landed_new(spark, target)
    assert landed.count() == 90 and landed.select("app_id").distinct().count() == 30
    files = list((tmp_path / "landed" / "rows").rglob("*.parquet"))
    assert len(files) <= 2


def made_runs(spark, days, per_day, tasks=2):
    start = dt.datetime(2024, 1, 1)
    made = []
    for number in range(days * per_day * tasks):
        day, task = divmod(number // per_day, tasks)
        minute = (number % per_day) * 7 % 1400 + number % 3
        began = start + dt.timedelta(days=day, minutes=minute)
        took = 100 + (number * 37) % 60 + (900 if number % 11 == 0 else 0)
        state = "FAILURE" if number % 13 == 0 else "SUCCESS"
        made.append((task, "t", began.date(), number, 0, state, began, took))
    return spark.createDataFrame(made, schemas.WORKFLOW_RUN)


@pytest.mark.parametrize("per_day", [3, 40])
def test_daily_verdicts_equal_those_of_the_whole_history(spark, per_day):
    frame = made_runs(spark, 8, per_day)
    day = lambda n: frame.where(F.col("dt") == F.lit(f"2024-01-{n:02d}").cast("date"))
    state = baselines.state_of(frame.where("dt < '2024-01-05'"))
    for n in range(5, 9):
        for daily, whole in (
            (baselines.day_duration_anomalies, runs.duration_anomalies),
            (baselines.day_end_time_anomalies, runs.end_time_anomalies),
        ):
            want = whole(frame).where(F.col("dt") == F.lit(f"2024-01-{n:02d}").cast("date"))
            assert rows(daily(state, day(n))) == rows(want)
        state = spark.createDataFrame(baselines.next_state(state, day(n)).collect(), state.schema)
    kept = state.select(F.size("last")).collect()
    assert [row[0] for row in kept] == [14, 14]


def test_a_day_reads_one_state_and_one_day(spark, tmp_path, database):
    path = str(tmp_path / "runs")
    made_runs(spark, 6, 3).write.partitionBy("dt").parquet(path)
    stored = spark.read.schema(schemas.WORKFLOW_RUN).parquet(path)
    names = [f"{database}.{name}" for name in ("run_state", "odd_duration", "odd_end")]
    for day in ("2024-01-04", "2024-01-05", "2024-01-05", "2024-01-06"):
        flows.baseline_day(stored, day, *names)
    parts = {row[0] for row in spark.sql(f"show partitions {names[0]}").collect()}
    assert parts == {"dt=2024-01-04", "dt=2024-01-05", "dt=2024-01-06"}
    whole = runs.duration_anomalies(stored).where("dt >= '2024-01-04'")
    got = spark.table(names[1]).withColumn("dt", F.col("dt").cast("date"))
    assert rows(got.select(*whole.columns)) == rows(whole)
    state = spark.table(names[0]).where("dt = '2024-01-05'").drop("dt")
    today = stored.where(F.col("dt") == F.lit("2024-01-06").cast("date"))
    plan = baselines.day_duration_anomalies(state, today)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert scans and all("dt#" in line and "PartitionFilters: [isnotnull(dt" in line for line in scans)


def planned(name, detail, metrics=(), children=(), filters=None):
    return {
        "nodeName": name, "simpleString": detail, "children": list(children),
        "metadata": {} if filters is None else {"PartitionFilters": filters},
        "metrics": [{"name": what, "accumulatorId": at, "metricType": "sum"} for what, at in metrics],
    }


def test_scans_and_sorts_are_tied_to_their_stage(spark):
    out = plangraph.ROWS
    deep = planned("Union", "Union", children=[
        planned("Scan parquet a", "FileScan a", [(out, 1)], filters="[]"),
        planned("Scan parquet b", "FileScan b", [(out, 2)], filters="[isnotnull(dt#1)]"),
        planned("Scan parquet c", "FileScan c PartitionFilters: [], PushedFilters: []", [(out, 3)]),
    ])
    for _ in range(2 * plangraph.LEVELS):
        deep = planned("Project", "Project", children=[deep])
    tree = planned("Sort", "Sort [a#1 ASC NULLS FIRST], true, 0", [("sort time", 4)], [deep])

    def stage(number, *values):
        return {"Event": "SparkListenerStageCompleted", "Stage Info": {
            "Stage ID": number, "Stage Attempt ID": 0, "Submission Time": 0, "Completion Time": 7_200_000,
            "Accumulables": [{"ID": at, "Name": "x", "Value": value} for at, value in values],
        }}

    start = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
    events = [
        {"Event": start, "executionId": 5, "sparkPlanInfo": tree},
        stage(1, (1, "20000000"), (99, "x")), stage(2, (2, "30000000")), stage(3, (3, "40000000")),
        stage(4, (4, "12")), stage(5),
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Submission Time": 0, "Stage IDs": [1, 2, 3, 4, 5],
         "Properties": {"spark.sql.execution.id": "5"}},
    ]
    texts = [json.dumps(event, separators=(",", ":")) for event in events]
    texts.append('{"Event":"' + start + '","executionId":6,"sparkPlanInfo":{"nodeName"')
    lines = spark.createDataFrame([("app", text) for text in texts], "app_id string, value string")
    nodes = plangraph.plan_nodes(lines)
    assert nodes.count() == 2 * plangraph.LEVELS + 5
    ran = plangraph.stage_nodes(nodes, plangraph.stage_accumulators(lines))
    assert rows(jobs.open_scans(ran), "stage_id", "scan", "rows_out") == [
        (1, "Scan parquet a", 20_000_000), (3, "Scan parquet c", 40_000_000)
    ]
    assert rows(jobs.open_scans(ran, 30_000_000), "stage_id") == [(3,)]
    long = jobs.sorting_stages(ran, eventlog.stages(lines))
    assert rows(long, "stage_id", "execution_id", "duration_ms") == [(4, 5, 7_200_000)]


class State:
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def changed(*times):
    return pd.DataFrame({"timestamp_ms": list(times), "identity": [int(t or 0) for t in times]})


def test_state_shrinks_as_the_clock_advances():
    update, state = streams.first_seen(horizon_ms=100), State()

    def batch(*frames):
        out = pd.concat(list(update(("h", "0"), iter(frames), state)))
        return list(zip(out["timestamp_ms"], out["late"]))

    assert batch(changed(1000, 1050), changed(1050, 1010)) == [(1000, False), (1050, False), (1010, False)]
    assert len(state.get[1]) == 3
    # a repeat within the horizon is known; what is older than the horizon is late, not lost
    assert batch(changed(1050, 940, 960, 940)) == [(940, True), (960, False)]
    assert batch(changed(2000)) == [(2000, False)]
    assert state.get == (2000, [2000], [2000])
    nothing, known = changed(None).astype({"timestamp_ms": "Float64"}), changed(1050, 1950)
    assert batch(known) == [(1050, True), (1950, False)]
    assert list(pd.concat(list(update(("h", "0"), iter([nothing]), state)))["late"]) == [True]


def test_stream_with_state_loses_and_repeats_nothing(spark, tmp_path):
    folder, changes = tmp_path / "logs", str(tmp_path / "changes")
    folder.mkdir()
    shape = "value string, server_ip string"

    def arrive(number, *lines):
        path = folder / "server_ip=h" / f"{number}.txt"
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(NM.format(hour, n) for hour, n in lines) + "\n")
        stream = spark.readStream.schema(shape).text(str(folder))
        from opdiag.operators.containers import nm_container_transitions

        streams.collect_distinct(
            stream, nm_container_transitions, changes, str(tmp_path / "progress"), part=F.lit("0")
        ).awaitTermination()
        late = streams.late_changes(spark, changes)
        number = F.right("container_id", F.lit(2)).cast("int").alias("n")
        return [sorted(r.n for r in frame.select(number).collect()) for frame in (streams.on_time(spark, changes), late)]

    assert arrive(1, ("10", 1), ("10", 1), ("11", 2)) == [[1, 2], []]
    assert arrive(2, ("11", 2), ("10", 3), ("08", 4)) == [[1, 2, 3], [4]]
    # repeats of lines beyond the horizon are no new changes
    assert arrive(3, ("23", 5), ("08", 4), ("10", 1)) == [[1, 2, 3, 5], [4]]
    assert arrive(4, ("10", 1), ("08", 4), ("11", 6), ("23", 5)) == [[1, 2, 3, 5], [4, 6]]
