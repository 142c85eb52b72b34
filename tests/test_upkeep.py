"""Compaction to a byte target, keyed tables, job history from events, and months ahead."""

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opdiag import schemas
from opdiag.operators import retention
from opdiag.sinks import compaction, keyed
from opdiag.sinks import retention as upkeep
from opdiag.sources import jobhistory

TARGET = 200_000


def parquet_files(folder):
    return sorted(p for p in folder.rglob("*.parquet") if "_compaction" not in str(p))


def made_folder(spark, folder, pieces=24):
    """Two partitions of small files, one of them with a large file besides."""
    numbers = spark.range(60_000).withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    small = numbers.where("id < 20000").withColumn("day", F.concat(F.lit("2024-01-0"), F.col("id") % 2 + 1))
    small.repartition(pieces).write.partitionBy("day").parquet(str(folder))
    large = numbers.where("id >= 20000").withColumn("day", F.lit("2024-01-01")).coalesce(1)
    large.write.mode("append").partitionBy("day").parquet(str(folder))


def contents(spark, folder):
    read = spark.read.schema("id long, text string, day string").parquet(str(folder))
    return read.select(F.count(F.lit(1)), F.sum(F.xxhash64("id", "text", "day").cast("decimal(38,0)"))).first()


def test_only_small_files_are_merged_to_the_target(spark, tmp_path):
    folder = tmp_path / "day"
    made_folder(spark, folder)
    before, times = contents(spark, folder), {p: (p.stat().st_size, p.stat().st_mtime_ns) for p in parquet_files(folder)}
    large = [p for p, (size, _) in times.items() if size >= compaction.ENOUGH * TARGET]
    assert len(large) == 1 and len(times) == 49
    gone, made = compaction.compact(spark, str(folder), TARGET)
    assert gone == 48 and contents(spark, folder) == before
    left = parquet_files(folder)
    assert len(left) == made + 1 and made < 12
    assert all(p.stat().st_size < 2 * TARGET for p in left if p not in large)
    assert times[large[0]] == (large[0].stat().st_size, large[0].stat().st_mtime_ns)
    assert not (folder / "_compaction").exists()


def test_nothing_to_merge(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "t"))
    assert compaction.compact(spark, str(tmp_path / "t"), TARGET) == (0, 0)


@pytest.mark.parametrize("steps", [0, 1, 7])
def test_a_broken_run_is_undone_or_finished(spark, tmp_path, monkeypatch, steps):
    folder = tmp_path / "t"
    made_folder(spark, folder, 12)
    before = contents(spark, folder)

    class Broken(Exception):
        pass

    delete, done = compaction.Files.delete, []

    def breaks(self, name, folder=False):
        """Fails after some of the files that were merged have gone."""
        if not folder:
            done.append(name)
            if len(done) > steps:
                raise Broken
        return delete(self, name, folder)

    monkeypatch.setattr(compaction.Files, "delete", breaks)
    with pytest.raises(Broken):
        compaction.compact(spark, str(folder), TARGET)
    monkeypatch.undo()
    compaction.compact(spark, str(folder), TARGET)
    assert contents(spark, folder) == before


def test_an_unfinished_rewrite_is_thrown_away(spark, tmp_path):
    folder = tmp_path / "t"
    made_folder(spark, folder, 12)
    before = contents(spark, folder)
    spark.range(5).write.parquet(str(folder / "_compaction" / "staged" / "bin=0"))
    assert compaction.compact(spark, str(folder), TARGET)[0] > 0
    assert contents(spark, folder) == before


KEYED = "dt date, key string, name string, insert_time timestamp_ntz"


def version(spark, *made):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(day if key != "none" else None, key, name, dt.datetime(2024, 1, 1, hour)) for key, name, hour in made], KEYED
    )


def names(table):
    return dict(rows(table.read(), "key", "name"))


def test_changes_are_merged_when_read_and_folded(spark, tmp_path, database):
    table = keyed.KeyedTable(spark, f"{database}.t", str(tmp_path), ["dt", "key"], buckets=4)
    table.create(version(spark, ("a", "a1", 1), ("a", "a0", 0), ("b", "b1", 1), ("none", "n1", 1)))
    assert names(table) == {"a": "a1", "b": "b1", "none": "n1"}
    table.upsert(version(spark, ("a", "a2", 2), ("b", "old", 0), ("c", "c1", 1), ("none", "n2", 2)))
    table.upsert(version(spark, ("c", "tie", 1)))
    want = {"a": "a2", "b": "b1", "c": "tie", "none": "n2"}
    assert names(table) == want
    for _ in range(2):
        table.fold()
        assert names(table) == want
    assert table.generation() == 2 and not os.path.exists(tmp_path / "base" / "generation=0")
    table.upsert(version(spark, ("d", "d1", 1)))
    assert names(table) == {**want, "d": "d1"}


def test_a_broken_change_or_fold_does_not_count(spark, tmp_path, database):
    table = keyed.KeyedTable(spark, f"{database}.t", str(tmp_path), ["dt", "key"], buckets=4)
    table.create(version(spark, ("a", "a1", 1)))
    table.upsert(version(spark, ("a", "a2", 2)))
    table.upsert(version(spark, ("a", "a3", 3)))
    (tmp_path / "changes" / "base=0" / "load=2" / "_SUCCESS").unlink()
    (tmp_path / "base" / "generation=1").mkdir()
    assert names(table) == {"a": "a2"}
    table.upsert(version(spark, ("a", "a4", 4)))
    table.fold()
    assert names(table) == {"a": "a4"}


def test_reading_moves_the_changes_but_not_the_base(spark, tmp_path, database):
    table = keyed.KeyedTable(spark, f"{database}.t", str(tmp_path), ["dt", "key"], buckets=8)
    table.create(version(spark, *[(f"k{n}", "x", 1) for n in range(50)]))
    table.upsert(version(spark, ("k1", "y", 2)))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    base = plan.index("base_0")
    scan = plan.rindex("\n", 0, base)
    above = plan[:scan].splitlines()
    depth = len(plan[scan + 1 : base]) - len(plan[scan + 1 : base].lstrip(" :+-"))
    line = plan[scan + 1 :].splitlines()[0]
    depth = line.index("FileScan")
    # lines above the base's scan with a smaller indent are its ancestors
    ancestors, limit = [], depth
    for text in reversed(above):
        indent = len(text) - len(text.lstrip(" :+-"))
        if indent < limit:
            ancestors.append(text)
            limit = indent
    assert any("SortMergeJoin" in text for text in ancestors)
    assert not any("Exchange" in text for text in ancestors)
    assert "Exchange" in plan


def history_line(kind, attempt, **fields):
    counts = fields.pop("counts", None)
    body = {"attemptId": attempt, "taskType": kind.split("_")[0], **fields}
    if counts:
        body["counters"] = {"name": "COUNTERS", "groups": [
            {"name": name, "counts": [{"name": k, "displayName": k, "value": v} for k, v in group.items()]}
            for name, group in counts.items()
        ]}
    return json.dumps({"type": kind, "event": {"org.apache.hadoop.mapreduce.jobhistory.X": body}})


def test_attempts_from_events(spark):
    one, two, three = (f"attempt_1700_0001_{kind}_000000_{n}" for kind, n in (("m", 0), ("m", 1), ("r", 0)))
    events = [
        "Avro-Json", '{"type":"record","name":"Event"}', '{"type":"MAP_ATTEMPT_FINISHED","event":',
        history_line("MAP_ATTEMPT_FINISHED", one, finishTime=700, taskStatus="SUCCEEDED", counts={
            "FileSystemCounter": {"HDFS_BYTES_READ": 5, "FILE_BYTES_READ": 99},
            "TaskCounter": {"MAP_INPUT_RECORDS": 7, "GC_TIME_MILLIS": 1, "CPU_MILLISECONDS": 2,
                            "PHYSICAL_MEMORY_BYTES": 3, "COMMITTED_HEAP_BYTES": 4},
        }),
        history_line("MAP_ATTEMPT_STARTED", one, startTime=100, trackerName="n1"),
        history_line("MAP_ATTEMPT_STARTED", two, startTime=150, trackerName="n2", avataar="SPECULATIVE"),
        history_line("MAP_ATTEMPT_KILLED", two, finishTime=160, status="KILLED", error="late"),
        history_line("REDUCE_ATTEMPT_STARTED", three, startTime=200, trackerName="n3"),
        history_line("REDUCE_ATTEMPT_STARTED", three, startTime=200, trackerName="n3"),
        history_line("REDUCE_ATTEMPT_FAILED", "attempt_1700_0002_r_000000_0", finishTime=1, status="FAILED"),
    ]
    found = jobhistory.attempts(spark.createDataFrame([(line,) for line in events], "value string"))
    assert found.schema.fieldNames() == [*schemas.MR_TASK_ATTEMPT.names, "state", "attempt_id"]
    assert rows(found.drop("allocated_memory")) == sorted([
        ("job_1700_0001", 0, "MAP", "n1", 100, 600, 5, 7, False, 1, 2, 3, None, "SUCCEEDED", one),
        ("job_1700_0001", 0, "MAP", "n2", 150, 10, None, None, True, None, None, None, "late", "KILLED", two),
        ("job_1700_0001", 1, "REDUCE", "n3", 200, None, None, None, False, None, None, None, None, "RUNNING", three),
    ], key=str)


def test_months_are_added_ahead_and_dropped_behind(spark, database):
    frame = spark.createDataFrame(
        [("t", m) for m in ("202301", "202312", "202401", "202407")], "table_name string, month string"
    )
    assert rows(retention.month_plan(frame, "2024-01-31", months=2, ahead=1)) == [
        ("t", "202301", "drop"), ("t", "202311", "add"), ("t", "202312", "keep"), ("t", "202401", "keep"),
        ("t", "202402", "add"), ("t", "202407", "keep"),
    ]
    spark.sql(f"create table {database}.m (x int, month string) using parquet partitioned by (month)")
    spark.sql(f"insert into {database}.m values (1, '202301'), (2, '202401')")
    done = upkeep.maintain_months(spark, [f"{database}.m"], "2024-01-31", months=1)
    assert done == {f"{database}.m": {"add": ["202312", "202402"], "drop": ["202301"]}}
    assert rows(spark.table(f"{database}.m")) == [(2, "202401")]
    again = upkeep.maintain_months(spark, [f"{database}.m"], "2024-01-31", months=1)
    assert again == {f"{database}.m": {"add": [], "drop": []}}
