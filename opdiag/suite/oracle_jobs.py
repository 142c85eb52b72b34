"""DuckDB SQL for the engine, warehouse and table-maintenance queries."""


def _launch(stage: str) -> str:
    return (
        "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1000003) "
        f"% (7200000 - 340000 * {stage})"
    )


FX_JOB_TASK = f"""
fx_task as (
  select 'app_' || (l_suppkey % 10) as app_id, cast(l_suppkey % 20 as integer) as stage_id,
         case when l_linestatus = 'O' then 'MAP' else 'REDUCE' end as kind,
         case when l_partkey % 16 = 0 then 'driver' else 'exec_' || (l_partkey % 8) end as executor_id,
         {_launch("(l_suppkey % 20)")} as launch_ms,
         cast(l_quantity as bigint) * 1000 * case when l_orderkey % 1000 = 11 then 50 else 1 end as duration_ms,
         cast(floor(l_extendedprice) as bigint) * 1000 * case when l_orderkey % 1000 = 7 then 50 else 1 end as input_bytes,
         cast(floor(l_extendedprice) as bigint) as input_records,
         l_returnflag = 'R' and l_suppkey % 20 < 5 as speculative,
         cast(l_quantity as bigint) * 25 * (l_suppkey % 10) as gc_ms, cast(l_quantity as bigint) * 1000 as cpu_ms,
         1000000 * (l_suppkey % 10) as peak_memory, cast(10000000 as bigint) as allocated_memory,
         case l_orderkey % 500 when 1 then 'FetchFailedException: lost block'
           when 2 then 'java.lang.OutOfMemoryError: Java heap space'
           when 3 then 'AnalysisException: column not found' end as failure_reason
  from lineitem)"""

FX_STAGE = FX_JOB_TASK + """,
fx_stage as (select app_id, cast(stage_id // 4 as bigint) as execution_id, stage_id,
                    min(launch_ms) as submit_ms, max(launch_ms + duration_ms) as end_ms
             from fx_task group by app_id, stage_id)"""

FX_PLAN = FX_STAGE + """,
fx_plan as (select app_id, execution_id,
                   execution_id % 3 = 0 as sorts, execution_id % 2 = 0 as scans
            from (select distinct app_id, execution_id from fx_stage))"""


def _median(keys: str, value: str, threshold: int) -> str:
    return f"""with {FX_JOB_TASK}
select {keys}, count(*) as tasks, max({value}) as max_{value}, median(cast({value} as double)) as median_{value}
from fx_task group by {keys} having max({value}) > {threshold} * median(cast({value} as double))"""


def _speculation(keys: str) -> str:
    return f"""with {FX_JOB_TASK}
select {keys}, count(*) as tasks, count(*) filter (speculative) as speculative_tasks,
       cast(count(*) filter (speculative) as double) / count(*) as speculative_share
from fx_task group by {keys} having cast(count(*) filter (speculative) as double) / count(*) > 0.1"""


def _failures(pattern: str) -> str:
    return f"""with {FX_JOB_TASK}
select app_id, stage_id, count(*) as failed_tasks, min(launch_ms) as first_launch_ms,
       min(failure_reason) as failure_reason
from fx_task where regexp_matches(failure_reason, '{pattern}') group by app_id, stage_id"""


_MEMORY_WASTE = f"""with {FX_JOB_TASK}
select app_id, max(peak_memory) as peak_memory, max(allocated_memory) as allocated_memory,
       cast(max(peak_memory) as double) / max(allocated_memory) as used_share
from fx_task group by app_id having cast(max(peak_memory) as double) / max(allocated_memory) < 0.3"""


def _idle(fixture: str, keys: str) -> str:
    """Gaps between each interval and the furthest end before it, head and tail added."""
    return f"""with {fixture},
ordered as (select {keys}, s, e, max(e) over (partition by {keys} order by s, e
              rows between unbounded preceding and 1 preceding) as upto from fx_interval),
gap as (select {keys}, cast(sum(greatest(s - upto, 0)) as bigint) as inner_gap, min(s) as s, max(e) as e
        from ordered group by {keys}),
both_ends as (select {keys}, b - a as total_ms, coalesce(inner_gap, 0) + (s - a) + (b - e) as idle_ms
              from fx_span join gap using ({keys}))
select *, cast(idle_ms as double) / total_ms as idle_share from both_ends
where cast(idle_ms as double) / total_ms > 0.3"""


SPARSE = f"""
fx_interval as (select 'app_' || l_suppkey as app_id, cast(l_partkey % 200 as integer) as stage_id,
                       {_launch("(l_partkey % 200 % 20)")} as s,
                       {_launch("(l_partkey % 200 % 20)")} + cast(l_quantity as bigint) * 60000 as e
                from lineitem),
fx_span as (select app_id, stage_id, min(s) as a, max(e) as b from fx_interval group by app_id, stage_id)"""

_JOBS = f"""
fx_interval as (select 'app_' || l_suppkey as app_id, cast(l_partkey % 50 as integer) as job_id,
                       {_launch("l_linenumber")} as s,
                       {_launch("l_linenumber")} + cast(l_quantity as bigint) * 20000 as e
                from lineitem),
fx_span as (select app_id, job_id, min(s) - 60000 as a, max(e) + 60000 as b from fx_interval group by app_id, job_id)"""

FX_TABLET = """
fx_tablet as (select 't' || (p_partkey % 20) as table_name, 'p' || p_size as partition_name, p_partkey as tablet_id,
                     cast(case when p_partkey % 20 = 3 then 0 else cast(floor(p_retailprice) as bigint)
                       * case p_partkey % 3 when 0 then 1000 when 1 then 1000000 else 100000000 end end as bigint) as bytes
              from part)"""

FX_PARTITION = """
fx_partition as (select ['ods_fsimage', 'dwd_fsimage', 'hdfs_storage', 'hive_storage_dir', 'hdfs_storage_user']
                          [o_orderkey % 5 + 1] as table_name,
                        strftime(o_orderdate, '%Y%m%d') as partition_key, cast(o_orderdate as date) as dt, o_orderkey as id
                 from orders)"""

_VERSION = """
select cast(o_orderdate as date) as dt, cast(o_custkey % 5 as varchar) as project_id,
       cast(o_custkey % 7 as varchar) as process_id, cast(o_custkey % 3 as varchar) as task_id,
       'name_' || o_orderkey as task_name, o_orderdate + to_seconds(o_orderkey % 86400) {later} as insert_time,
       {new} as new
from orders"""

SQL = {
    "spark_data_skew": _median("app_id, stage_id", "input_bytes", 40),
    "spark_task_tail": _median("app_id, stage_id", "duration_ms", 40),
    "mr_data_skew": _median("app_id, kind", "input_bytes", 40),
    "mr_task_tail": _median("app_id, kind", "duration_ms", 40),
    "spark_hdfs_stall": f"""with {FX_JOB_TASK},
rated as (select *, input_bytes * 1000 // nullif(duration_ms, 0) as rate from fx_task),
usual as (select app_id, stage_id, median(cast(rate as double)) as median_rate from rated group by app_id, stage_id)
select app_id, stage_id, launch_ms, duration_ms, input_bytes, rate, median_rate
from rated join usual using (app_id, stage_id) where rate < cast(0.1 as double) * median_rate""",
    "spark_speculation": _speculation("app_id, stage_id"),
    "mr_speculation": _speculation("app_id, kind"),
    "mr_gc_anomaly": f"""with {FX_JOB_TASK}
select app_id, cast(sum(gc_ms) as bigint) as gc_ms, cast(sum(cpu_ms) as bigint) as cpu_ms,
       cast(sum(gc_ms) as double) / cast(sum(cpu_ms) as double) as gc_share
from fx_task group by app_id having cast(sum(gc_ms) as double) / cast(sum(cpu_ms) as double) > cast(0.1 as double)""",
    "spark_memory_waste": _MEMORY_WASTE,
    "mr_memory_waste": _MEMORY_WASTE,
    "spark_cpu_waste": f"""with {FX_JOB_TASK},
per_executor as (select app_id, executor_id, 1 + count(*) // 50 as cores, min(launch_ms) as a,
                        max(launch_ms + duration_ms) as b, sum(duration_ms) as busy
                 from fx_task group by app_id, executor_id),
roles as (select app_id, case when executor_id = 'driver' then 'driver' else 'executor' end as role,
                 cast(sum(cores * (b - a)) as bigint) as core_ms, cast(sum(busy) as bigint) as busy_ms
          from per_executor group by 1, 2)
select *, cast(busy_ms as double) / core_ms as busy_share from roles
where cast(busy_ms as double) / core_ms < cast(0.3 as double)""",
    "spark_large_scan": f"""with {FX_PLAN},
read as (select app_id, stage_id, cast(sum(input_records) as bigint) as rows_read from fx_task group by all
         having sum(input_records) > 10000000)
select r.app_id, r.stage_id, r.rows_read, s.execution_id from read r join fx_stage s using (app_id, stage_id)
join fx_plan p on s.app_id = p.app_id and s.execution_id = p.execution_id where p.scans""",
    "mr_large_scan": f"""with {FX_JOB_TASK}
select app_id, cast(sum(input_records) as bigint) as rows_read from fx_task group by app_id
having sum(input_records) > 10000000""",
    "spark_broadcast_oom_risk": """with total as (
  select 'app_' || o_custkey as app_id, cast(sum(cast(floor(o_totalprice) as bigint) * 1000) as bigint) as broadcast_bytes
  from orders group by o_custkey),
memory as (select 'app_' || c_custkey as app_id,
                  least((c_custkey % 4 + 1) * 1073741824, (c_custkey % 3 + 2) * 1073741824) as memory from customer)
select app_id, broadcast_bytes, memory, cast(broadcast_bytes as double) / memory as broadcast_share
from total join memory using (app_id) where cast(broadcast_bytes as double) / memory > cast(0.3 as double)""",
    "spark_job_idle": _idle(_JOBS, "app_id, job_id"),
    "spark_stage_idle": _idle(SPARSE, "app_id, stage_id"),
    "spark_global_sort": f"""with {FX_PLAN}
select s.app_id, s.stage_id, s.execution_id, s.end_ms - s.submit_ms as duration_ms
from fx_stage s join fx_plan p on s.app_id = p.app_id and s.execution_id = p.execution_id
where p.sorts and s.end_ms - s.submit_ms > 1800000""",
    "spark_sql_failure": _failures("AnalysisException|ParseException"),
    "spark_shuffle_failure": _failures("FetchFailed|[Ss]huffle"),
    "spark_oom": _failures("OutOfMemoryError"),
    "sr_bucket_size": f"""with {FX_TABLET}
select *, case when bytes < 104857600 then 'small' else 'large' end as verdict from fx_tablet
where bytes < 104857600 or bytes > 10737418240""",
    "sr_partition_size": f"""with {FX_TABLET},
sized as (select table_name, partition_name, cast(sum(bytes) as bigint) as bytes, count(*) as tablets
          from fx_tablet group by table_name, partition_name)
select * from (select *, case when bytes = 0 then 'empty' when bytes < 104857600 then 'small'
                              when bytes > 107374182400 then 'large' end as verdict from sized)
where verdict is not null""",
    "sr_load_profile": """select 't' || (user_id % 20) as table_name, date_trunc('hour', ts) as load_hour,
       count(*) as loads, cast(sum(cast(floor(value * 1000) as bigint)) as bigint) as bytes
from events group by 1, 2""",
    "expired_partitions": f"""with {FX_PARTITION}
select distinct table_name, partition_key from fx_partition where partition_key < '20000502'""",
    "retained_partitions": f"""with {FX_PARTITION}
select * from fx_partition where partition_key >= '20000502'""",
    "month_partition": f"""with {FX_PARTITION}
select * from (select *, strftime(dt, '%Y%m') as month from fx_partition) where month between '199906' and '200008'""",
    "upsert_latest": f"""with versions as ({_VERSION.format(later="", new=0)}
union all {_VERSION.format(later="+ interval 1 hour", new=1)})
select dt, project_id, process_id, task_id, task_name, insert_time from (
  select *, row_number() over (partition by dt, project_id, process_id, task_id
                               order by insert_time desc, new desc, task_name desc) as r from versions) where r = 1""",
}
SQL |= {
    "table_partitions_overwritten": f"""with {FX_TABLET}
select table_name, partition_name, tablet_id, case when tablet_id % 3 = 1 then bytes + 1 else bytes end as bytes,
       cast(tablet_id % 3 as integer) as pt from fx_tablet""",
    "table_appended": f"with {FX_TABLET} select * from fx_tablet",
    "files_compacted": f"with {FX_TABLET} select *, cast(tablet_id % 3 as integer) as pt from fx_tablet",
    "keyed_table": f"""with first as ({_VERSION.format(later="", new=0)}),
second as ({_VERSION.format(later="+ interval 1 hour", new=1)}),
versions as (
  select * from first union all select * from second
  union all select * replace (insert_time + interval 2 hour as insert_time, 2 as new) from first where task_id = '1'
  union all select * replace (insert_time + interval 3 hour as insert_time, 3 as new, cast(null as date) as dt) from second)
select dt, project_id, process_id, task_id, task_name, insert_time from (
  select *, row_number() over (partition by dt, project_id, process_id, task_id
                               order by insert_time desc, new desc, task_name desc) as r from versions) where r = 1""",
    "month_partition_plan": f"""with {FX_PARTITION},
there as (select distinct table_name, strftime(dt, '%Y%m') as month from fx_partition),
wanted as (select table_name, strftime(m, '%Y%m') as month from (select distinct table_name from there),
           (select unnest(range(date '2000-07-01', date '2001-10-01', interval 1 month)) as m))
select coalesce(t.table_name, w.table_name) as table_name, coalesce(t.month, w.month) as month,
       case when t.month is null then 'add' when t.month < '200007' then 'drop' else 'keep' end as action
from wanted w full join there t on t.table_name = w.table_name and t.month = w.month""",
    "mr_job_history": f"""
select 'job_1700000000000_000' || (l_suppkey % 10) as app_id, case when kind = 'MAP' then 0 else 1 end as stage_id, kind,
       'node' || (l_partkey % 8) as executor_id, launch as launch_ms, case when ended then seconds * 1000 end as duration_ms,
       case when ended then size * 1000 + case when kind = 'MAP' then 0 else size * 3 end end as input_bytes,
       case when ended then size end as input_records, l_returnflag = 'R' as speculative,
       case when ended then seconds * 25 end as gc_ms, case when ended then seconds * 1000 end as cpu_ms,
       case when ended then size * 10 end as peak_memory, case when ended then size * 20 end as allocated_memory,
       case when l_orderkey % 7 = 1 then 'Error: ' || l_orderkey end as failure_reason,
       case l_orderkey % 7 when 0 then 'RUNNING' when 1 then 'FAILED' when 2 then 'KILLED' else 'SUCCEEDED' end as state,
       'attempt_1700000000000_000' || (l_suppkey % 10) || '_' || lower(kind[1]) || '_'
         || (l_orderkey * 10 + l_linenumber) || '_' || (l_partkey * 1000000000 + cast(floor(l_extendedprice * 100) as bigint))
         as attempt_id
from (select *, case when l_linestatus = 'O' then 'MAP' else 'REDUCE' end as kind, l_orderkey % 7 <> 0 as ended,
             cast(l_quantity as bigint) as seconds, cast(floor(l_extendedprice) as bigint) as size,
             {_launch("(l_suppkey % 20)")} as launch from lineitem)""",
}
