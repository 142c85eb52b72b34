"""What the physical plans look like: pruning, shuffles, run-time splits."""

from contextlib import contextmanager

from conftest import SMALL
from pyspark.sql import functions as F

from opdiag.defaults import Fixed
from opdiag.operators import medians, runs, sized, storage
from opdiag.suite import fixtures as fx
from opdiag.suite.queries import QUERIES


def plan_of(frame, run=False):
    if run:
        frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **conf):
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_no_query_runs_python_or_a_cross_join(spark):
    for name in ("dir_storage_report", "user_storage_share", "task_lineage_rows", "lineage_edges",
                 "key_task_day_over_day", "wf_duration_anomaly", "spark_cpu_waste", "sr_query_frequency"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        for word in ("Cartesian", "BroadcastNestedLoop", "PythonUDF", "MapInPandas", "ArrowEval"):
            assert word not in plan, name


def test_report_shuffles_once_to_dedupe_and_once_to_sum(spark):
    assert plan_of(QUERIES["dir_storage_report"](spark, SMALL)).count("Exchange") == 2


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(QUERIES["mr_gc_anomaly"](spark, SMALL))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan
    plan = plan_of(QUERIES["plan_scan_cardinality"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_start_times_are_ranged_for_the_scan(spark, tmp_path):
    fx.task_instance(spark, SMALL).write.parquet(str(tmp_path / "i"))
    stored = spark.read.parquet(str(tmp_path / "i"))
    plan = plan_of(stored.where(runs._before_cutoff("2024-01-10", False, Fixed.CUTOFF)))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(start_time" in plan and "LessThan(start_time" in plan


def test_total_of_user_shares_reuses_the_sums(spark):
    plan = plan_of(storage.user_storage_share(
        storage.flatten_listing(fx.fsimage(spark, SMALL), fx.PARTITION), fx.AS_OF), run=True)
    assert "ReusedExchange" in plan or "Reused" in plan


def test_hot_key_is_split_in_a_lookup_join(spark):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
    ):
        keys = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 50)
        rows = spark.range(0, 200_000, 1, 8).select(keys.alias("k"), "id", F.xxhash64("id").alias("x"))
        lookup = rows.groupBy("k").agg(F.max("x").alias("top"))
        joined = sized.join_lookup(rows, lookup, ["k"])
        out = joined.groupBy((F.col("id") % 3).alias("g")).agg(F.count("*").alias("n"))
        assert "skewed" in plan_of(out, run=True) or "skew=true" in plan_of(out)
        assert sum(r.n for r in out.collect()) == 200_000


def test_small_middle_buckets_are_broadcast_and_large_ones_not(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    assert "BroadcastHashJoin" in plan_of(medians.group_median(rows, ["k"], "v"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "SortMergeJoin" in plan_of(medians.group_median(rows, ["k"], "v"))
