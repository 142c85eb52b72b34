"""DuckDB SQL for the workflow-run queries."""

from opdiag.suite.oracle_storage import _round

FX_SCHEDULER = """
fx_project as (select cast(n_nationkey as bigint) as id, 'project_' || n_nationkey as name from nation),
fx_definition as (select c_custkey as id, 'process_' || (c_custkey // 3) as name, cast(c_nationkey as bigint) as project_id
                  from customer),
fx_instance as (
  select event_id as id, 'task_' || (event_id % 2) as name, user_id // 4 as process_definition_id,
         (user_id // 4) * 100 + day(ts) as process_instance_id, date_trunc('second', ts) as start_time,
         date_trunc('second', ts) as submit_time,
         date_trunc('second', ts) + to_seconds(cast(floor(value * 10) as integer)) as end_time,
         cast(event_id % 3 as integer) as retry_times
  from events),
named as (select i.id, i.name as task_name, d.name as process_name, p.name as project_name, i.process_instance_id,
                 i.submit_time, i.start_time, i.end_time, i.retry_times
          from fx_instance i join fx_definition d on i.process_definition_id = d.id
          join fx_project p on d.project_id = p.id),
fx_monitored as (select distinct project_name, process_name, task_name, d.dt
                 from named, (values (date '2024-01-10'), (date '2024-01-09')) d(dt))"""


def _attempts(day: str) -> str:
    """The earliest attempt per task name, with the minutes from its instance's first start to last end."""
    minutes = _round("cast(date_diff('second', s.opened, s.closed) as double) / 60", 2)
    return f"""
  select distinct on (n.project_name, n.process_name, n.task_name)
         n.project_name, n.process_name, n.task_name, n.submit_time, n.start_time, n.end_time,
         cast(n.retry_times as varchar) as retries, {minutes} as minutes
  from early_{day[-2:]} n join (
    select project_name, process_name, task_name, process_instance_id, min(start_time) as opened,
           arg_max(end_time, (start_time, id)) as closed
    from early_{day[-2:]} group by all) s
    using (project_name, process_name, task_name, process_instance_id)
  order by n.project_name, n.process_name, n.task_name, n.start_time, n.id"""


def _early(day: str, operator: str) -> str:
    return f"""early_{day[-2:]} as (select * from named where cast(start_time as date) = date '{day}'
             and cast(start_time as time) {operator} time '06:00:00')"""


_CHANGE = _round("(f.minutes - b.minutes) / nullif(b.minutes, 0)", 4)


def _day_over_day(match: str) -> str:
    """``match`` holds the columns by which the previous day's runs are found."""
    return f"""with {FX_SCHEDULER}, {_early("2024-01-10", "<")}, {_early("2024-01-09", "<=")},
fresh as ({_attempts("2024-01-10")}), earlier as ({_attempts("2024-01-09")}),
watched as (select distinct project_name, process_name, task_name from fx_monitored),
before_it as (select w.project_name, w.process_name, w.task_name, e.start_time, e.minutes, e.retries
              from watched w join earlier e using ({match}))
select project_name, process_name, task_name, date '2024-01-10' as dt, f.submit_time, f.start_time, f.end_time,
       b.minutes as lastday_taken_minute, f.minutes as taken_minute,
       cast(date_diff('second', b.start_time, f.start_time) - 86400 as integer) as start_diff_second,
       {_CHANGE} as dod, f.retries as retry_times, b.retries as lastday_retry_times
from watched join fresh f using (project_name, process_name, task_name)
left join before_it b using (project_name, process_name, task_name)"""


FX_RUN = """
fx_run as (
  select user_id // 4 as process_id, 'task_' || (event_id % 2) as task_name, cast(ts as date) as dt,
         event_id as attempt_id, cast(event_id % 4 as integer) as retry_times,
         case when event_type in ('error', 'signup') then 'FAILURE' else 'SUCCESS' end as state,
         date_trunc('second', ts) as start_time, cast(floor(value * 30) as bigint) as duration_s
  from events)"""

_FINAL = """
final as (select * from (select *, row_number() over (partition by process_id, task_name, dt order by attempt_id desc) as r
                         from fx_run) where r = 1 and state = 'FAILURE')"""


def _anomaly(value: str, test: str, verdict: str) -> str:
    return f"""with {FX_RUN},
good as (select *, date_diff('second', cast(dt as timestamp), start_time) + duration_s as end_second
         from fx_run where state = 'SUCCESS'),
g as (select *, median(cast({value} as double)) over (
          partition by process_id, task_name order by start_time, attempt_id
          rows between 14 preceding and 1 preceding) as usual from good)
select process_id, task_name, dt, attempt_id, {value}, usual, {verdict} as verdict from g where {test}"""


SQL = {
    "key_task_day_over_day": _day_over_day("process_name, task_name"),
    "key_task_day_over_day_by_project": _day_over_day("project_name, process_name, task_name"),
    "wf_final_failure": f"""with {FX_RUN}, {_FINAL}
select process_id, task_name, dt, attempt_id, retry_times, start_time, duration_s from final""",
    "wf_first_failure": f"""with {FX_RUN}
select process_id, task_name, dt, attempt_id, retry_times, start_time, duration_s from fx_run
where state = 'SUCCESS' and retry_times > 1""",
    "wf_long_failure": f"""with {FX_RUN}, {_FINAL}
select process_id, task_name, count(distinct dt) as failed_days, max(dt) as last_failed from final
where dt between date '2024-01-21' and date '2024-01-30' group by process_id, task_name""",
    "wf_end_time_anomaly": _anomaly(
        "end_second", "abs(end_second - usual) > 1800",
        "case when end_second > usual then 'late' else 'early' end",
    ),
    "wf_duration_anomaly": _anomaly(
        "duration_s", "duration_s > 2 * usual or duration_s < 0.5 * usual",
        "case when duration_s > usual then 'long' else 'short' end",
    ),
    "wf_long_running": f"""with {FX_RUN}
select process_id, task_name, dt, attempt_id, state, start_time, duration_s from fx_run where duration_s > 7200""",
}
_DAYS = "dt in (date '2024-01-28', date '2024-01-29', date '2024-01-30')"
SQL |= {
    f"{name}_daily": f"select * from ({SQL[name]}) where {_DAYS}"
    for name in ("wf_end_time_anomaly", "wf_duration_anomaly")
}
