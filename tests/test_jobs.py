import random
import statistics
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opdiag import schemas
from opdiag.operators import intervals, jobs, medians, retention, warehouse


@pytest.mark.parametrize("bound, parts", [(200_000, 4096), (3, 2), (1, 7)])
def test_group_median_against_brute_force(spark, monkeypatch, bound, parts):
    monkeypatch.setattr(medians, "PARTS", parts)
    rng = random.Random(5)
    data = [
        (rng.choice("aaab"), rng.choice([rng.randint(-99, 99), rng.randint(0, 10**13), 7]))
        for _ in range(3000)
    ] + [("f", 2**62), ("f", 2**63 - 1)] + [("g", 2**e + d) for e in range(1, 62) for d in (-1, 0, 1)] + [(None, 3), ("c", 4), ("c", 7), ("d", None), ("e", 2048), ("e", 2047), ("e", 4096)]
    groups = defaultdict(list)
    for key, value in data:
        if value is not None:
            groups[key].append(value)
    frame = spark.createDataFrame(data, "k string, v bigint")
    got = {r.k: (r.median, r.maximum, r.n) for r in medians.group_median(frame, ["k"], "v", bound).collect()}
    middle = {k: sum(x / 2 for x in (statistics.median_low(v), statistics.median_high(v))) for k, v in groups.items()}
    assert got == {k: (middle[k], max(v), len(v)) for k, v in groups.items()}


def test_merged_intervals_against_brute_force(spark):
    rng = random.Random(6)
    data = []
    for _ in range(800):
        start = rng.randint(0, 2 * 10**7)
        data.append((rng.choice("ab"), start, start + rng.choice([0, 10, 30_000, 8_000_000 if rng.random() < 0.01 else 5])))
    expected = []
    for key in "ab":
        pieces = []
        for _, start, end in sorted(d for d in data if d[0] == key):
            if pieces and start <= pieces[-1][1]:
                pieces[-1][1] = max(pieces[-1][1], end)
            else:
                pieces.append([start, end])
        expected += [(key, *p) for p in pieces]
    frame = spark.createDataFrame(data, "k string, start_ms bigint, end_ms bigint")
    assert rows(intervals.merged(frame, ["k"]), "k", "start_ms", "end_ms") == sorted(expected, key=str)


def test_idle_time_counts_head_tail_and_only_the_span(spark):
    pieces = spark.createDataFrame(
        [("a", 0, 20), ("a", 15, 30), ("a", 50, 200), ("c", 0, 5)], "k string, start_ms bigint, end_ms bigint"
    )
    spans = spark.createDataFrame(
        [("a", 10, 100), ("b", 0, 10), ("c", 10, 20)], "k string, span_start bigint, span_end bigint"
    )
    assert rows(intervals.idle_time(spans, pieces, ["k"]), "k", "total_ms", "idle_ms") == [
        ("a", 90, 20), ("b", 10, 10), ("c", 10, 10),
    ]


def tasks(spark, *changes):
    base = dict(
        app_id="a", stage_id=1, kind="MAP", executor_id="1", launch_ms=0, duration_ms=1000,
        input_bytes=1000, input_records=10, speculative=False, gc_ms=0, cpu_ms=1000,
        peak_memory=50, allocated_memory=100, failure_reason=None,
    )
    data = [tuple({**base, **c}[n] for n in schemas.JOB_TASK.names) for c in changes]
    return spark.createDataFrame(data, schemas.JOB_TASK)


def test_skew_and_tail_limits(spark):
    frame = tasks(spark, {}, {}, {"input_bytes": 5001, "duration_ms": 5000})
    assert rows(jobs.data_skew(frame), "max_input_bytes", "median_input_bytes") == [(5001, 1000.0)]
    assert jobs.task_tail(frame).count() == 0
    assert jobs.task_tail(frame, jobs.KIND, 4.9).first().kind == "MAP"


def test_stall_ignores_tasks_without_time(spark):
    frame = tasks(spark, {}, {}, {}, {"input_bytes": 99}, {"input_bytes": 100}, {"duration_ms": 0})
    assert rows(jobs.hdfs_stall(frame), "input_bytes", "rate", "median_rate") == [(99, 99, 1000.0)]


def test_shares(spark):
    frame = tasks(
        spark, *[{} for _ in range(9)], {"speculative": True}, {"stage_id": 2, "speculative": None},
        {"app_id": "b", "gc_ms": 101, "peak_memory": 29}, {"app_id": "c", "cpu_ms": 0, "gc_ms": 5, "allocated_memory": 0},
    )
    assert jobs.speculation(frame).count() == 0
    assert rows(jobs.speculation(frame, threshold=0.09), "app_id", "stage_id") == [("a", 1)]
    assert rows(jobs.gc_anomaly(frame), "app_id") == [("b",)]
    assert rows(jobs.memory_waste(frame), "app_id") == [("b",)]


def test_cpu_waste_keeps_idle_executors(spark):
    frame = tasks(spark, {"duration_ms": 3000}, {"executor_id": "driver", "duration_ms": 10})
    crew = spark.createDataFrame(
        [("a", "1", 2, 0, 2000), ("a", "driver", 1, 0, 1000), ("b", "1", 4, 0, 10)], schemas.APP_EXECUTOR
    )
    assert rows(jobs.cpu_waste(frame, crew), "app_id", "role", "busy_ms", "core_ms") == [
        ("a", "driver", 10, 1000), ("b", "executor", 0, 40),
    ]


def test_plan_diagnoses(spark):
    long, short = 1_800_001, 1_800_000
    stages = spark.createDataFrame(
        [("a", 0, 5, 1, 0, 0, long), ("a", 0, 6, 2, 0, 0, long), ("a", 0, 5, 3, 0, 0, short)], schemas.APP_STAGE
    )
    plans = spark.createDataFrame(
        [("a", 5, "x\nSort [s#1[0] ASC], true, 0\nScan PartitionFilters: [], y"),
         ("a", 5, "(1) Scan parquet t\nReadSchema: s\n\n(2) Sort\nArguments: [a ASC], true, 0\n\n"),
         ("a", 6, "Sort [a ASC], false, 0\n(1) Scan parquet t\nPartitionFilters: [dt = 1]\n\n")],
        schemas.APP_PLAN,
    )
    assert rows(jobs.global_sort(stages, plans), "stage_id") == [(1,)]
    frame = tasks(spark, {"input_records": 10**7}, {"input_records": 1}, {"stage_id": 2, "input_records": 10**8},
                  {"stage_id": 3, "input_records": 10**7})
    assert rows(jobs.large_scan(frame, stages, plans), "stage_id", "rows_read", "execution_id") == [
        (1, 10**7 + 1, 5)
    ]
    assert rows(jobs.mr_large_scan(frame), "app_id") == [("a",)]


def test_failure_reasons(spark):
    frame = tasks(
        spark, {"failure_reason": "FetchFailed: lost"}, {"failure_reason": "FetchFailed: gone"},
        {"failure_reason": "ExceptionFailure: java.lang.OutOfMemoryError: Java heap space"},
        {"failure_reason": "AnalysisException: cannot resolve x"}, {"failure_reason": "disk"},
    )
    assert rows(jobs.shuffle_failures(frame), "failed_tasks", "failure_reason") == [(2, "FetchFailed: gone")]
    assert rows(jobs.oom_failures(frame), "failed_tasks") == [(1,)]
    assert rows(jobs.sql_failures(frame), "failed_tasks") == [(1,)]


def test_broadcast_risk(spark):
    sent = spark.createDataFrame([("a", 1, 20), ("a", 2, 11), ("b", 1, 30)], schemas.APP_BROADCAST)
    memory = spark.createDataFrame([("a", 100, 500), ("b", 500, 100)], schemas.APP_MEMORY)
    assert rows(jobs.broadcast_oom_risk(sent, memory), "app_id", "broadcast_bytes", "memory") == [("a", 31, 100)]


def test_tablets_and_partitions(spark):
    mib = 2**20
    frame = spark.createDataFrame(
        [("t", "p1", 1, 100 * mib), ("t", "p2", 2, 100 * mib - 1), ("t", "p3", 3, 10240 * mib + 1),
         ("t", "p4", 4, 0), ("t", "p5", 5, 102400 * mib + 1)],
        schemas.TABLET,
    )
    assert rows(warehouse.tablet_size_anomaly(frame), "tablet_id", "verdict") == [
        (2, "small"), (3, "large"), (4, "small"), (5, "large"),
    ]
    assert rows(warehouse.partition_size_anomaly(frame), "partition_name", "verdict") == [
        ("p2", "small"), ("p4", "empty"), ("p5", "large"),
    ]


def test_retention_limits(spark):
    frame = spark.createDataFrame(
        [("t", "20231110"), ("t", "20231111"), ("t", "20231112"), ("t", "20231110")], "table_name string, partition_key string"
    )
    assert rows(retention.expired_partitions(frame, "2024-01-10"), "partition_key") == [("20231110",)]
    assert retention.retained(frame, "2024-01-10").count() == 2
    days = spark.createDataFrame([("2022-11-30",), ("2022-12-01",), ("2024-02-29",), ("2024-03-01",)], "dt string")
    kept = retention.retained_months(retention.month_partition(days.selectExpr("cast(dt as date) dt")), "2024-01-10")
    assert rows(kept, "month") == [("202212",), ("202402",)]


def test_upsert_prefers_the_highest_version_then_the_change(spark):
    shape = "k int, name string, insert_time int"
    old = spark.createDataFrame([(1, "old", 5), (2, "kept", 9), (3, "tie", 4)], shape)
    new = spark.createDataFrame([(1, "new", 6), (2, "late", 8), (3, "change", 4), (4, "added", 1)], shape)
    assert rows(retention.upsert_latest(old, new, ["k"]), "k", "name") == [
        (1, "new"), (2, "kept"), (3, "change"), (4, "added"),
    ]


def test_median_of_nothing(spark):
    frame = spark.createDataFrame([("a", 1)], "k string, v bigint")
    assert medians.group_median(frame.where("1 = 0"), ["k"], "v").count() == 0
    assert medians.group_median(frame.where("v > 1"), ["k"], "v").count() == 0


def test_close_values_are_divided_until_a_task_ranks_few(spark, monkeypatch):
    ranked = []
    inside = medians._inside

    def watched(valued, middle, names):
        found = inside(valued, middle, names)
        ranked.append(found.count())
        return found

    monkeypatch.setattr(medians, "_inside", watched)
    size = F.lit(134_217_728) + F.col("id") * 3
    frame = spark.range(60_000).select(F.lit("k").alias("k"), size.alias("v"))
    found = medians.group_median(frame, ["k"], "v", 500).first()
    assert found.median == 134_217_728 + 3 * 29_999.5 and found.n == 60_000
    assert ranked[0] > 500 >= ranked[-1]


def test_idle_time_of_spans_that_repeat_or_share_a_key(spark):
    spans = spark.createDataFrame(
        [("a", 0, 100), ("a", 0, 100), ("a", 200, 300), ("b", 0, 10)],
        "k string, span_start long, span_end long",
    )
    busy = spark.createDataFrame([("a", 10, 50), ("a", 190, 220)], "k string, start_ms long, end_ms long")
    assert rows(intervals.idle_time(spans, busy, ["k"])) == [("a", 100, 60), ("a", 100, 80), ("b", 10, 10)]


def test_tasks_that_read_nothing_are_not_stalled(spark):
    base = {name: None for name in schemas.JOB_TASK.names}
    made = [dict(base, app_id="a", stage_id=1, launch_ms=at, duration_ms=1000, input_bytes=size)
            for at, size in enumerate([1000, 1000, 1000, 1, 0, 0, 0, 0, None])]
    frame = spark.createDataFrame(made, schemas.JOB_TASK)
    assert rows(jobs.hdfs_stall(frame), "launch_ms", "median_rate") == [(3, 1000.0)]
