from conftest import rows
from pyspark.sql import functions as F

from opdiag.functions.classes import access_class, size_class
from opdiag.functions.paths import partition_date_text, partition_value
from opdiag.operators import ageing, storage
from opdiag.schemas import FSIMAGE_FILE

DAY = "20240110"
AS_OF = "2024-01-10"


def listing(spark, *records):
    """Records as (path, size) or with replication, access and modification time as well."""
    full = [
        (p[0], p[2] if len(p) > 2 else 3, p[4] if len(p) > 4 else "2024-01-01 08:00",
         p[3] if len(p) > 3 else "2024-01-01 08:00", 134217728, 1, p[1], -1, -1, "-rw", "u", "g")
        for p in records
    ]
    return spark.createDataFrame(full, FSIMAGE_FILE).withColumn("partition_key", F.lit(DAY))


def test_prefixes_stop_at_the_path_length(spark):
    flat = storage.flatten_listing(listing(spark, ("/", 0), ("/a/b", 1), ("/1/2/3/4/5/6/7/8", 1)), DAY)
    got = {r.path: r for r in flat.collect()}
    assert got["/"].p1 == "/" and got["/"].p2 is None
    assert (got["/a/b"].p1, got["/a/b"].p2, got["/a/b"].p3) == ("/a", "/a/b", None)
    assert got["/1/2/3/4/5/6/7/8"].p7 == "/1/2/3/4/5/6/7"


def test_flatten_drops_header_other_days_and_null_paths(spark):
    frame = listing(spark, ("Path", 0), (None, 1), ("/a", 1))
    other = frame.withColumn("partition_key", F.lit("20240109"))
    assert rows(storage.flatten_listing(frame.unionByName(other), DAY), "path") == [("/a",)]


def test_equal_records_collapse_and_only_unreplicated_sizes_add_up(spark):
    frame = listing(
        spark, ("/a", 5, 3), ("/a", 5, 3), ("/b", 5, 16020), ("/b", 5, 16020),
        ("/c", 5, 0), ("/d", 5, None), ("/d", 5, None),
    )
    got = dict(rows(storage.flatten_listing(frame, DAY), "path", "filesize_total"))
    assert got == {"/a": 15, "/b": 10, "/c": 5, "/d": 10}


def test_size_class_limits(spark):
    mib = 1024**2
    sizes = [1024 * mib, 1024 * mib - 1, 128 * mib, 128 * mib - 1, 1, 0, -1, None]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, s bigint")
    got = [r.c for r in frame.select("i", size_class(F.col("s")).alias("c")).orderBy("i").collect()]
    big, med, small, empty = storage.SIZE_CLASSES
    assert got == [big, med, med, small, small, empty, None, None]


def test_access_class_limits(spark):
    ages = [-3, 0, 7, 8, 90, 91, 365, 366]
    frame = spark.createDataFrame([(a,) for a in ages], "a int").select(
        "a", F.concat(F.date_sub(F.lit(AS_OF).cast("date"), F.col("a")).cast("string"), F.lit(" 23:59")).alias("t")
    )
    got = dict(rows(frame.select("a", access_class(F.col("t"), AS_OF).alias("c"))))
    heat, warm, cold, old = storage.ACCESS_CLASSES
    assert got == {-3: heat, 0: heat, 7: heat, 8: warm, 90: warm, 91: cold, 365: cold, 366: old}
    odd = spark.createDataFrame([("",), (None,), ("never",)], "t string")
    assert rows(odd.select(access_class(F.col("t"), AS_OF))) == [(None,)] * 3


def test_directory_without_any_known_temperature_is_left_out(spark):
    flat = storage.flatten_listing(
        listing(spark, ("/a/x", 1, 3, None), ("/b/x", 1, 3), ("/b/y", -1, 3), ("/c/x", -1, 3)), DAY
    )
    report = storage.dir_storage_report(flat, AS_OF)
    assert rows(report, "dir_name", "dir_size", "sma_dir_pro") == [("/b", 2, 1)]


def test_class_counts_and_unclassified_add_up_to_files(spark):
    flat = storage.flatten_listing(
        listing(spark, *[(f"/a/{i}", s) for i, s in enumerate([0, 1, 2**28, 2**31, -1])]), DAY
    )
    row = storage.dir_storage_report(flat, AS_OF).first()
    assert sum(row[n] for n in storage.SIZE_CLASSES) + 1 == row.dir_size == 5
    assert row.storage_measure == 3 * (1 + 2**28 + 2**31 - 1) / 2**40


def test_only_database_directories_on_request(spark):
    root = "/user/hive/warehouse"
    flat = storage.flatten_listing(
        listing(spark, (f"{root}/a.db/t/f", 1), (f"{root}/lone/f", 1), (f"{root}/a.db/t2/f", 1)), DAY
    )
    every = storage.warehouse_storage_report(flat, AS_OF).first()
    named = storage.warehouse_storage_report(flat, AS_OF, only_db_suffix=True).first()
    assert (every.db_count, every.table_count, every.dir_size) == (2, 3, 3)
    assert (named.db_count, named.table_count, named.dir_size) == (1, 2, 2)
    assert storage.warehouse_storage_report(flat.where("false"), AS_OF).count() == 0


def test_user_shares(spark):
    flat = storage.flatten_listing(
        listing(spark, ("/user/a/1", 285, 1), ("/user/b/1", 715, 9), ("/tmp/x", 10**6)), DAY
    )
    assert rows(storage.user_storage_share(flat, AS_OF), "user_name", "user_storage_pro", "user_dir_pro") == [
        ("/user/a", 0.29, 0.5), ("/user/b", 0.72, 0.5),
    ]


def worked_listing(spark):
    """Ten files whose report is worked out by hand; 2024-01-10 is the day."""
    tib, mib = 1024**4, 1024**2
    root = "/user/hive/warehouse"
    return storage.flatten_listing(listing(
        spark,
        # path, size, replication, access time
        (f"{root}/a.db/t1/f1", 2 * tib // 4, 2, "2024-01-09 10:00"),   # big, hot: 1 TiB with copies
        (f"{root}/a.db/t1/f2", 200 * mib, 1, "2023-12-01 10:00"),      # medium, warm
        (f"{root}/a.db/t2/f1", 10, 3, "2023-06-01 10:00"),             # small, cold: 30 bytes
        (f"{root}/b.db/t1/f1", 0, 3, "2020-01-01 10:00"),              # empty, very old
        (f"{root}/b.db/t1/f1", 0, 3, "2020-01-01 10:00"),              # the same record once more
        ("/tmp/x", 128 * mib, 16020, "2024-01-10 10:00"),              # medium, hot: not multiplied
        ("/tmp/x", 128 * mib, 16020, "2024-01-10 10:00"),              # added up with its copy
        ("/tmp/y", 1, 0, "2024-01-03 10:00"),                          # small, hot
        ("/odd/z", -5, 1, "2024-01-03 10:00"),                         # no size class: no row
        ("/", 5, 1, "2024-01-03 10:00"),                               # the root is no directory
    ), DAY)


def test_worked_directory_report(spark):
    report = storage.dir_storage_report(worked_listing(spark), AS_OF)
    names = ["dir_name", "storage_measure", "dir_size", *storage.SIZE_CLASSES, *storage.ACCESS_CLASSES, "etl_dt"]
    mib, tib = 1024**2, 1024**4
    assert rows(report, *names) == [
        ("/tmp", (2 * 128 * mib + 1) / tib, 2, 0, 1, 1, 0, 2, 0, 0, 0, "20240110"),
        ("/user", (tib + 200 * mib + 30) / tib, 4, 1, 1, 1, 1, 1, 1, 1, 1, "20240110"),
    ]


def test_worked_warehouse_report(spark):
    report = storage.warehouse_storage_report(worked_listing(spark), AS_OF)
    names = ["db_count", "table_count", "storage_measure", "dir_size", *storage.SIZE_CLASSES, *storage.ACCESS_CLASSES]
    mib, gib = 1024**2, 1024**3
    # t1 of the two databases has two paths, so there are three tables
    assert rows(report, *names) == [(2, 3, (1024 * gib + 200 * mib + 30) / gib, 4, 1, 1, 1, 1, 1, 1, 1, 1)]


def test_never_accessed_follows_the_time_zone(spark):
    flat = storage.flatten_listing(listing(spark, (f"{ROOT}/f", 1, 3, "1970-01-01 00:00", "2024-01-01 08:00")), DAY)
    assert ageing.stale_warehouse_files(flat, AS_OF).count() == 1
    assert ageing.stale_warehouse_files(flat, AS_OF, never_accessed="1970-01-01 00:00:00").count() == 0


def test_partition_values(spark):
    values = ["202406", "2024-06", "20240607", "2024-06-07", "2024067", "302406", "2024-6", "|bar"]
    frame = spark.createDataFrame([(f"/w/d/t/dt={v}",) for v in values] + [("/w/d/t/x",)], "p string")
    got = rows(frame.select("p", partition_date_text(F.col("p")), partition_value(F.col("p"))))
    shown = {p.split("=")[-1]: (date, value) for p, date, value in got}
    assert shown["202406"][0] == "2024-06-01" and shown["2024-06"][0] == "2024-06-01"
    assert shown["20240607"][0] == "2024-06-07" and shown["2024-06-07"][0] == "2024-06-07"
    assert [shown[v][0] for v in ("2024067", "302406", "2024-6", "|bar", "/w/d/t/x")] == [None] * 5
    assert shown["|bar"][1] == "|bar" and shown["302406"][1] == ""


ROOT = "/user/hive/warehouse/a.db/t"


def test_stale_files(spark):
    old, new, never = "2019-01-09 23:59", "2019-01-10 00:00", "1970-01-01 08:00"
    flat = storage.flatten_listing(
        listing(
            spark,
            (f"{ROOT}/old_access", 1, 3, old, new), (f"{ROOT}/old_change", 1, 3, new, old),
            (f"{ROOT}/fresh", 1, 3, new, new), (f"{ROOT}/never", 1, 3, never, old),
            (f"{ROOT}/unknown", 1, 3, None, old), (f"{ROOT}/blank", 1, 3, "", old),
            (f"{ROOT}/empty", 0, 3, old, old), ("/tmp/t/x/y/z", 1, 3, old, old),
        ),
        DAY,
    )
    got = ageing.stale_warehouse_files(flat, AS_OF)
    assert {r.path.split("/")[-1] for r in got.collect()} == {"old_access", "old_change", "blank"}
    assert {(r.db, r.tbl) for r in got.collect()} == {("a", "t")}


def test_old_partitions_in_use(spark):
    used, idle = "2024-01-04 00:00", "2024-01-03 00:00"
    flat = storage.flatten_listing(
        listing(
            spark,
            (f"{ROOT}/dt=201901/f", 1, 3, used, idle), (f"{ROOT}/dt=2019-01-10/f", 1, 3, used, idle),
            (f"{ROOT}/dt=2018-12/f", 1, 3, idle, used), (f"{ROOT}/dt=2018-13/f", 1, 3, used, used),
            (f"{ROOT}/dt=19990101/f", 1, 3, used, used), (f"{ROOT}/dt=20181231/f", 1, 3, idle, idle),
        ),
        DAY,
    )
    got = ageing.old_partition_touched(flat, AS_OF)
    assert rows(got, "partition_key", "partition_date") == [
        ("2018-12", "2018-12-01"), ("201901", "2019-01-01"),
    ]
