"""All oracle SQL, by query name."""

from opdiag.suite import (
    oracle_jobs,
    oracle_lineage,
    oracle_plans,
    oracle_runs,
    oracle_storage,
)

SQL: dict[str, str] = {
    **oracle_storage.SQL,
    **oracle_plans.SQL,
    **oracle_lineage.SQL,
    **oracle_runs.SQL,
    **oracle_jobs.SQL,
}
SQL["export_history"] = (
    "select * exclude (partition_key) replace (partition_key as etl_dt) from ("
    f"select *, '20111105' as partition_key from ({oracle_storage.SQL['dir_storage_report']}))"
)
SQL["fsimage_csv_load"] = oracle_storage.SQL["fsimage_flatten"]
SQL["listing_odd_paths"] = f"""with {oracle_storage.FX_FSIMAGE}
select path || ',a,' || blockscount as path, replication, modificationtime, accesstime, preferredblocksize,
       blockscount, filesize, case when blockscount <> 2 then nsquota end as nsquota, dsquota, permission,
       username, groupname
from fx_ods_fsimage"""
SQL["lineage_relation_files"] = oracle_lineage.RELATION_FILES
SQL["task_json_rows"] = (
    "select cast(to_json(t) as varchar) as value from ("
    f"{oracle_lineage.SQL['workflow_tasks']}) t"
)
SQL["event_log_tasks"] = f"""with {oracle_jobs.FX_JOB_TASK}
select 'application_1700000000000_' || lpad(app_id[5:], 4, '0') as app_id, stage_id, kind, executor_id, launch_ms,
       duration_ms, input_bytes, input_records, speculative, gc_ms, cpu_ms, peak_memory,
       'ExceptionFailure: ' || failure_reason as failure_reason
from fx_task"""
SQL["mr_attempt_lines"] = f"with {oracle_jobs.FX_JOB_TASK} select * from fx_task"

_APP = "'app-1700000000-' || app_id[5:]"
_EVENTS = f"""{oracle_jobs.FX_JOB_TASK}, {oracle_jobs.SPARSE},
fx_job as (select app_id, job_id, min(a) as a, max(b) as b
           from (select *, unnest([stage_id // 4, 1000]) as job_id from fx_span) group by app_id, job_id),
fx_exec as (select app_id, executor_id, cast(1 + count(*) // 50 as integer) as cores, min(launch_ms) as a,
                   max(launch_ms + duration_ms) as b from fx_task group by app_id, executor_id),
fx_app as (select app_id, min(a) as a, max(b) as b from fx_exec group by app_id)"""
SQL |= {
    "event_log_stages": f"""with {_EVENTS}
select {_APP} as app_id, cast(stage_id // 4 as integer) as job_id, cast(stage_id // 4 as bigint) as execution_id,
       stage_id, n as stage_attempt, a + n as submit_ms, b + n as end_ms
from fx_span, (values (cast(0 as integer)), (cast(1 as integer))) as v(n) where n = 0 or stage_id % 5 = 0""",
    "event_log_stage_jobs": f"""with {_EVENTS}
select {_APP} as app_id, cast(j as integer) as job_id, cast(j as bigint) as execution_id, stage_id
from (select *, unnest([stage_id // 4, 1000]) as j from fx_span)""",
    "event_log_jobs": f"""with {_EVENTS}
select {_APP} as app_id, cast(job_id as integer) as job_id, cast(job_id as bigint) as execution_id,
       a as submit_ms, b as end_ms from fx_job""",
    "event_log_executors": f"""with {_EVENTS}
select {_APP} as app_id, executor_id, cores, a as start_ms, b as end_ms from fx_exec where executor_id <> 'driver'
union all select {_APP}, 'driver', cast(b % 4 + 1 as integer), a, b from fx_app""",
    "event_log_memory": f"""with {_EVENTS}
select {_APP} as app_id, cast((b % 4 + 1) * 1073741824 as bigint) as driver_memory,
       cast(1073741824 as bigint) as executor_memory from fx_app""",
    "job_failure": f"""with {_EVENTS}
select {_APP} as app_id, 'job ' || job_id as unit, b as end_ms, 'stage of ' || job_id || ' failed' as failure_reason
from fx_job where job_id % 3 = 0""",
    "sql_execution_failure": f"""with {_EVENTS}
select {_APP} as app_id, 'execution ' || job_id as unit, b as end_ms, 'AnalysisException: ' || job_id as failure_reason
from fx_job where job_id % 3 = 0""",
    "executor_oom": f"""with {_EVENTS}
select {_APP} as app_id, 'executor ' || executor_id as unit, b as end_ms,
       'Container killed by ' || executor_id || ' for exceeding memory limits' as failure_reason
from fx_exec where executor_id <> 'driver'""",
}

_PLANNED = f"""{oracle_jobs.SPARSE},
fx_execution as (select {_APP} as app_id, cast(stage_id // 4 as bigint) as execution_id, min(a) as a
                 from fx_span group by app_id, stage_id // 4),
fx_node(path, node, detail, partition_filters, metric, k) as (
  select * from (values
    ('0', 'Sort', 'sort', null, 'sort time', 2),
    (repeat('0.', 10) || '0', 'SortMergeJoin', 'SortMergeJoin [a#1], [a#1], Inner', null, 'number of output rows', 8),
    (repeat('0.', 11) || '0', 'Scan parquet t.open', 'FileScan parquet t.open[a#1]', '[]', 'number of output rows', 0),
    (repeat('0.', 11) || '1', 'Scan parquet t.pruned', 'FileScan parquet t.pruned[a#1]', '[isnotnull(dt#2)]',
     'number of output rows', 1)) v
  union all select repeat('0.', i) || '0', 'Project', 'Project [a#1]', null, null, null from range(1, 10) r(i)
  union all select '0', 'Exchange', null, null, 'data size', 7),
fx_plan_node as (
  select app_id, execution_id, path, node,
         case when detail = 'sort' then 'Sort [a#1 ASC NULLS FIRST], '
              || case when execution_id % 3 = 0 then 'true' else 'false' end || ', 0' else detail end as detail,
         partition_filters, execution_id * 10 + k as accumulator, metric
  from fx_execution, fx_node where node <> 'Exchange' or execution_id % 2 = 0),
fx_stage_node as (
  select n.app_id, n.execution_id, stage_id, 0 as stage_attempt, path, node, detail, partition_filters,
         case when metric = 'number of output rows' then (b - a) * 5 end as rows_out, a, b
  from fx_plan_node n join (select {_APP} as app_id, stage_id, a, b from fx_span) s
    on s.app_id = n.app_id and n.execution_id = s.stage_id // 4 and n.accumulator = n.execution_id * 10 + s.stage_id % 4
  where s.stage_id % 4 <> 3)"""
_BROADCAST = "execution_id % 2 = 0"  # only these plans name the size of a broadcast in readable JSON
SQL |= {
    "event_log_plan_nodes": f"with {_PLANNED} select * from fx_plan_node",
    "event_log_stage_nodes": f"with {_PLANNED} select * exclude (a, b) from fx_stage_node",
    "event_log_plans": f"""with {_PLANNED}
select app_id, execution_id, 'plan of ' || execution_id as plan from fx_execution
union all select app_id, execution_id, 'again' from fx_execution where {_BROADCAST}""",
    "event_log_broadcasts": f"""with {_PLANNED}
select app_id, execution_id, a * 1000 as bytes from fx_execution where {_BROADCAST}""",
    "event_log_broadcast_risk": f"""with {_PLANNED},
total as (select app_id, cast(sum(a * 1000) as bigint) as broadcast_bytes from fx_execution where {_BROADCAST} group by app_id)
select app_id, broadcast_bytes, cast(2147483648 as bigint) as memory, broadcast_bytes / 2147483648.0::double as broadcast_share
from total where broadcast_bytes / 2147483648.0::double > 0.3::double""",
    "spark_open_scan": f"""with {_PLANNED}
select app_id, stage_id, stage_attempt, execution_id, path, node as scan, rows_out from fx_stage_node
where node = 'Scan parquet t.open' and rows_out > 10000000""",
    "spark_sorting_stage": f"""with {_PLANNED}
select app_id, stage_id, stage_attempt, execution_id, b - a as duration_ms from fx_stage_node
where node = 'Sort' and execution_id % 3 = 0 and b - a > 1800000""",
}
SQL["table_exported"] = " union all ".join(
    f"select * replace ('{day}' as etl_dt) from ({oracle_storage.SQL['dir_storage_report']})"
    for day in ("20111105", "20111106")
)
SQL["newest_listing"] = f"""with {oracle_storage.FX_FSIMAGE}
select path, replication, modificationtime, accesstime, preferredblocksize, blockscount, filesize, nsquota, dsquota,
       permission, username, groupname from fx_ods_fsimage where path is distinct from 'Path'"""
