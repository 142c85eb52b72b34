import pytest
from conftest import rows

from opdiag.operators import containers
from opdiag.plans import scans
from opdiag.schemas import QUERY_RECORD
from opdiag.streaming import containers as streams

NM = "2024-01-05 10:00:01,250 INFO x.ContainerImpl: Container {} transitioned from NEW to LOCALIZING"
RM = "2024-01-05 10:00:01,250 INFO x.RMContainerImpl: {} Container Transitioned from NEW to RESERVED"
STORED = "2024-01-05 10:00:00,001 INFO x.RMStateStore: Storing application with id application_17_0002"
CID = "container_17_0002_01_000003"


def lines(spark, *values, host="h1"):
    return spark.createDataFrame([(v, host) for v in values], "value string, server_ip string")


def test_node_manager_lines(spark):
    frame = lines(spark, NM.format(CID), "noise", "2024 transitioned from x to y", None)
    assert rows(containers.nm_container_transitions(frame)) == [
        ("application_17_0002", CID, "NEW", "LOCALIZING", "2024-01-05 10:00:01.250", 1704448801250, "h1")
    ]


def test_epoch_ids_only_on_request(spark):
    frame = lines(spark, NM.format("container_e5_17_0002_01_000003"))
    assert containers.nm_container_transitions(frame).count() == 0
    got = rows(containers.nm_container_transitions(frame, accept_epoch=True), "application_id", "container_id")
    assert got == [("application_17_0002", "container_e5_17_0002_01_000003")]


def test_resource_manager_lines(spark):
    got = rows(containers.rm_container_transitions(lines(spark, STORED, RM.format(CID), NM.format(CID))))
    assert [r[:4] for r in got] == [
        ("application_17_0002", "container_17_0002_01_000001", "INIT", "NEW"),
        ("application_17_0002", CID, "NEW", "RESERVED"),
    ]


def test_zone_shifts_the_epoch_time(spark):
    frame = lines(spark, NM.format(CID))
    utc = containers.nm_container_transitions(frame).first().timestamp_ms
    east = containers.nm_container_transitions(frame, "Asia/Shanghai").first().timestamp_ms
    assert utc - east == 8 * 3600 * 1000


def test_hour(spark):
    later = STORED.replace(" 10:", " 11:")
    assert rows(containers.of_hour(lines(spark, STORED, later, " " + STORED), "2024-01-05 10"), "value") == [(STORED,)]


@pytest.mark.parametrize("restart", [False, True])
def test_stream_equals_batch_without_repeats(spark, tmp_path, restart):
    folder = tmp_path / "logs"
    folder.mkdir()
    name = "hadoop-yarn-NODEMANAGER-host{}.log"
    texts = [NM.format(f"container_17_0002_01_{i:06d}") for i in range(50)]
    (folder / name.format(1)).write_text("\n".join(texts + texts[:10]) + "\n")

    def run():
        streams.collect_changes(
            streams.stream_lines(spark, str(folder), "*NODEMANAGER*"),
            containers.nm_container_transitions, str(tmp_path / "out"), str(tmp_path / "progress"),
        ).awaitTermination()

    if restart:
        run()
        # a rotated copy of the same file adds nothing, a new host's file does
        (folder / (name.format(1) + ".1")).write_text("\n".join(texts[:20]) + "\n")
        run()
    (folder / name.format(2)).write_text("\n".join(texts[:5]) + "\n")
    run()
    got = rows(streams.published(spark, str(tmp_path / "out")))
    batch = containers.nm_container_transitions(lines(spark, *texts, host="host1")).unionByName(
        containers.nm_container_transitions(lines(spark, *texts[:5], host="host2"))
    )
    assert got == rows(batch)


def record(spark, *plans, start="2024-01-05 00:00:00"):
    shaped = [("q%d" % i, start, start, "u", "1", "EOF", None, "s", "d", p) for i, p in enumerate(plans)]
    text = spark.createDataFrame(shaped, ", ".join(f"`{n}` string" for n in QUERY_RECORD.names))
    return text.select(*[text[f.name].cast(f.dataType) for f in QUERY_RECORD.fields])


DAY = ("2024-01-05 00:00:00", "2024-01-05 23:59:59")


def node(table, part, rows_):
    return f"ScanNode\n     TABLE: {table}\n     partitions={part}\n     cardinality={rows_}\n"


def test_scan_nodes(spark):
    plan = "join cardinality=20000000\n 0:Olap" + node("t", "1/0", 10_000_000) + "1:Olap" + node("u", "3/4", 9_999_999) \
        + "2:Olap" + node("v", "3/4", 10_000_001)
    frame = record(spark, plan, "no scan", "0:Olap" + node("w", "a/b", "many"), None)
    got = scans.plan_scan_cardinality(frame, *DAY)
    assert rows(got, "table_name", "partitions_ratio", "cardinality") == [
        ("", None, "20000000"), ("t", None, "10000000"), ("v", 0.75, "10000001"),
    ]
    assert rows(scans.plan_scan_cardinality(frame, *DAY, require_table=True), "table_name") == [("t",), ("v",)]


def test_scan_window_includes_both_ends(spark):
    plan = node("t", "1/1", 10**8)
    for start, expected in (
        ("2024-01-04 23:59:59", 0), ("2024-01-05 00:00:00", 1),
        ("2024-01-05 23:59:59", 1), ("2024-01-06 00:00:00", 0),
    ):
        assert scans.plan_scan_cardinality(record(spark, plan, start=start), *DAY).count() == expected


def test_frequency_counts_a_query_once_per_table(spark):
    twice = node("t", "1/1", 1) + node("t", "1/1", 1)
    got = scans.query_frequency(record(spark, twice, node("t", "1/1", 1) + node("u", "1/1", 1), "x", None))
    assert [tuple(r) for r in got.collect()] == [("t", 2), ("u", 1)]


def test_no_line_is_lost_however_late_its_host(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    name = "hadoop-yarn-NODEMANAGER-host{}.log"
    line = NM.format("container_17_0002_01_000001")
    late = [line, line.replace(" 10:", " 08:"), line.replace("2024-01-05", "2024-01-03")]
    for at, text in enumerate(late):
        (folder / name.format(at)).write_text(text + "\n" + text + "\n")
        streams.collect_changes(
            streams.stream_lines(spark, str(folder), "*NODEMANAGER*"),
            containers.nm_container_transitions, str(tmp_path / "out"), str(tmp_path / "progress"),
        ).awaitTermination()
    times = [r.change_time for r in streams.published(spark, str(tmp_path / "out")).collect()]
    assert len(times) == 3 and len(set(times)) == 3
    some = streams.published(spark, str(tmp_path / "out"), "2024-01-04", "2024-01-05")
    assert some.count() == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-04" in plan[plan.index("PartitionFilters") :]
