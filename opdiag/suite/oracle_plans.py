"""DuckDB SQL for the plan-text and log-line queries."""

FX_QUERY_RECORD = """
fx_query_record as (
  select 'q' || o_orderkey as query_id, o_orderdate as start_time, o_orderdate as end_time,
         'u' || (o_custkey % 9) as "user", o_orderkey % 1000 as time_used, o_orderstatus as state,
         cast(null as varchar) as error_message, 'select ' || o_orderkey as sql, 'ds' as "database",
         'PLAN FRAGMENT 0' || chr(10) || '2:HASH JOIN' || chr(10)
         || '  |  cardinality=' || o_custkey || chr(10) || '0:OlapScanNode' || chr(10)
         || '     TABLE: t' || (o_custkey % 50) || chr(10)
         || '     partitions=' || (o_orderkey % 12) || '/' || (o_orderkey % 3 * 12) || chr(10)
         || '     cardinality=' || (cast(floor(o_totalprice) as bigint) * 100) || chr(10)
         || '1:OlapScanNode' || chr(10) || '     TABLE: t' || (o_orderkey % 50) || chr(10)
         || '     partitions=1/' || (o_custkey % 30) || chr(10)
         || '     cardinality=' || (o_orderkey * 1000) || chr(10) as plan
  from orders)"""

# The expected changes come from the events that the log lines are made of; no line is parsed.
_CHANGE = """
change as (
  select *, lpad(cast(user_id as varchar), 4, '0') as app, lpad(cast(event_id as varchar), 6, '0') as number,
         substr(cast(ts as varchar), 1, 19) || '.' || lpad(cast(event_id % 1000 as varchar), 3, '0') as change_time,
         epoch_ms(date_trunc('second', ts)) + event_id % 1000 as timestamp_ms
  from events where event_type <> 'error')"""


def _changed(first: str, number: str, from_state: str, to_state: str, host: str) -> str:
    return f"""select '{first}_' || app as application_id, 'container_1700000000000_' || app || '_01_' || {number}
       as container_id, {from_state} as from_state, {to_state} as to_state, change_time, timestamp_ms,
       '{host}' || (user_id % 3) as server_ip from change"""


def rm_sql(where: str = "true") -> str:
    """Every change of a container, and the birth of an application on signup."""
    stored = "event_type = 'signup'"
    number = f"case when {stored} then '000001' else number end"
    states = f"case when {stored} then 'INIT' else 'NEW' end", f"case when {stored} then 'NEW' else upper(event_type) end"
    changed = _changed("application_1700000000000", number, *states, "rm-host-")
    return f"with {_CHANGE} {changed} where {where}"


def nm_sql(where: str = "true") -> str:
    changed = _changed(
        "application_1700000000000", "number", "'LOCALIZING'", "upper(event_type)", "nm-host-"
    )
    return f"with {_CHANGE} {changed} where {where}"


SQL = {
    "plan_scan_cardinality": f"""with {FX_QUERY_RECORD},
node as (select * exclude (plan), unnest(string_split(plan, 'ScanNode')) as scan from fx_query_record),
row_of as (select row_number() over () as r, * from node),
line as (select r, row_number() over (partition by r) as pos, l
         from (select r, unnest(string_split(scan, chr(10))) as l from row_of)),
mark as (select r, l[strpos(l, 'TABLE: ') + 7:] as t, l[strpos(l, 'partitions=') + 11:] as p,
                l[strpos(l, 'cardinality=') + 12:] as c, strpos(l, 'TABLE: ') as ht, strpos(l, 'partitions=') as hp,
                strpos(l, 'cardinality=') as hc, pos from line),
value as (select r, coalesce(min_by(t, pos) filter (ht > 0), '') as table_name,
                 coalesce(min_by(p, pos) filter (hp > 0), '') as partitions,
                 min_by(c, pos) filter (hc > 0) as cardinality from mark group by r)
select table_name, partitions,
       try_cast(split_part(partitions, '/', 1) as double)
         / nullif(try_cast(split_part(partitions, '/', 2) as double), 0) as partitions_ratio,
       cardinality, query_id, start_time, end_time, "user", time_used, state, error_message, sql, "database", scan
from row_of join value using (r)
where try_cast(cardinality as bigint) >= 10000000
  and start_time >= timestamp '1990-01-01' and start_time <= timestamp '2010-12-31 23:59:59'""",
    "sr_query_frequency": f"""with {FX_QUERY_RECORD},
node as (select query_id, unnest(string_split(plan, 'ScanNode')[2:]) as scan from fx_query_record),
named as (select query_id, regexp_extract(scan, 'TABLE: (.*?)\\n', 1) as table_name from node)
select table_name, count(distinct query_id) as query_count from named where table_name <> ''
group by table_name order by query_count desc, table_name""",
    "rm_container_transitions": rm_sql(),
    "nm_container_transitions": nm_sql(),
    "rm_hour_transitions": rm_sql("starts_with(change_time, '2024-01-05 10')"),
    "rm_container_stream": rm_sql(),
    "nm_container_stream": nm_sql(),
    "rm_container_stream_state": f"""with change as ({rm_sql()}),
clock as (select server_ip, right(container_id, 1) as part, max(timestamp_ms) as newest from change
          where substr(change_time, 12, 2) >= '12' group by all)
select change.*, coalesce(substr(change_time, 12, 2) < '12' and timestamp_ms < newest - 3600000, false) as late
from change left join clock on clock.server_ip = change.server_ip and part = right(container_id, 1)""",
    "log_hour_repeated": f"select * from ({nm_sql()}) union all select * from ({rm_sql()})",
    "log_files_by_name": nm_sql("user_id % 3 <> 0"),
}
