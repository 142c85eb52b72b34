"""DuckDB SQL for the workflow-definition queries, with the JSON taken apart by DuckDB."""

FX_DEF = """
fx_def as (
  select c_custkey as id, 'process_' || (c_custkey % 8) as name, cast(c_nationkey as bigint) as project_id,
         case when c_custkey % 11 = 0 then 0 else 1 end as release_state,
         '2024-01-' || lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0') || ' 10:00:00' as update_time,
         '{"tasks":['
         || case when c_custkey % 7 = 0 then '{"name":"task_1","type":"PYTHON","preTasks":[]},' else '' end
         || '{"name":"task_0","type":"SHELL","preTasks":[]},{"name":"task_1","type":"SHELL","preTasks":["task_0"]},'
         || '{"name":"py","type":"PYTHON","preTasks":["task_0"]},'
         || '{"name":"sub","type":"SUB_PROCESS","preTasks":["task_1"],"params":{"processDefinitionId":'
         || case c_custkey % 10 when 1 then c_custkey + 1 when 2 then c_custkey - 1 else c_custkey // 2 end || '}},'
         || case when c_custkey % 5 <> 0 then
              '{"name":"dep","type":"DEPENDENT","dependence":{"dependTaskList":[{"dependItemList":[{"projectId":'
              || c_nationkey || ',"definitionId":' || (c_custkey - 1) || ',"depTasks":"'
              || case when c_custkey % 2 = 0 then 'ALL' else 'task_1' end
              || '"},{"depTasks":"task_0"}]}]}},{"name":"task_2","type":"SHELL","preTasks":["dep","sub"],"dependence":null},'
            else '' end
         || '{"name":"end","type":"SHELL","preTasks":["task_1"'
         || case when c_custkey % 13 = 0 then ',"ghost"' else '' end || ']}]}' as js
  from customer),
rel as (select d.project_id, 'project_' || n.n_nationkey as project_name, d.id as process_id, d.name as process_name, d.js
        from fx_def d join nation n on d.project_id = n.n_nationkey
        where d.release_state = 1 and left(d.update_time, 10) <= '2024-01-26'
          and d.project_id not in (1, 2, 3, 4, 18, 20, 31, 33)),
arr as (select * exclude (js), from_json(js::json->'tasks', '["JSON"]') as ts from rel),
pos as (select *, unnest(ts) as t, generate_subscripts(ts, 1) as p from arr),
ranked as (select *, t->>'name' as task_name,
                  row_number() over (partition by process_id, t->>'name' order by p desc) as r from pos),
defined as (select project_id, project_name, process_id, process_name, task_name, t->>'type' as task_type,
                   cast(t->'params'->>'processDefinitionId' as bigint) as sub_id,
                   coalesce(from_json(t->'preTasks', '["VARCHAR"]'), []) as pre,
                   case when json_type(t->'dependence') = 'OBJECT' then t->'dependence'->'dependTaskList' end as dep
            from ranked where r = 1),
task as (select *, case when task_type = 'SUB_PROCESS' then cast(sub_id as varchar)
                        else process_id || '-' || task_name end as task_id
         from defined where task_type in ('SHELL', 'SUB_PROCESS')),
wanted as (select * exclude (pre), unnest(pre) as pre_name from task),
lists as (select process_id, task_name, unnest(from_json(dep, '["JSON"]')) as l from defined where dep is not null),
item as (select process_id, task_name, unnest(from_json(l->'dependItemList', '["JSON"]')) as i from lists),
dependency as (
  select w.project_id, w.project_name, w.process_id, w.process_name, w.task_id, w.task_name, w.task_type,
         cast(i->>'projectId' as bigint) as other, cast(i->>'definitionId' as bigint) as def_id,
         i->>'depTasks' as dep_task, false as pre_is_sub, cast(null as bigint) as pre_sub
  from wanted w join item d on w.process_id = d.process_id and w.pre_name = d.task_name
  union all
  select w.project_id, w.project_name, w.process_id, w.process_name, w.task_id, w.task_name, w.task_type,
         null, null, w.pre_name, d.task_type = 'SUB_PROCESS', d.sub_id
  from wanted w join defined d on w.process_id = d.process_id and w.pre_name = d.task_name and d.dep is null)"""

_LINEAGE_ROWS = """
select project_id, '2024-01-26' as dt, project_name, process_id, process_name, task_id, task_name,
       case when other is null then project_id else other end as pre_project_id,
       case when other is null then process_id else def_id end as pre_process_id,
       case when other is null then process_id || '-' || dep_task
            when dep_task = 'ALL' then null else def_id || '-' || dep_task end as pre_task_id,
       dep_task as pre_task_name
from dependency
union all
select project_id, '2024-01-26', project_name, process_id, process_name, task_id, task_name, null, null, null, null
from task where len(pre) = 0
union all
select project_id, '2024-01-26', project_name, process_id, process_name, cast(process_id as varchar), process_name,
       project_id, process_id, task_id, task_name
from task"""

NODES = """
node as (select 'process' as kind, cast(process_id as varchar) as id from rel
         union select 'task', task_id from task where task_type = 'SHELL')"""

_STRICT = """
raw_edge as (
  select 'process' as src_kind, cast(process_id as varchar) as src_id, 'task' as dst_kind, task_id as dst_id, '包含' as label
  from task
  union all
  select 'task', task_id, case when other is not null and dep_task = 'ALL' then 'process' else 'task' end,
         case when other is not null and dep_task = 'ALL' then cast(def_id as varchar)
              when other is not null then def_id || '-' || dep_task else process_id || '-' || dep_task end, '依赖'
  from dependency)"""

_EXTENDED = """
raw_edge as (
  select 'process' as src_kind, cast(process_id as varchar) as src_id,
         case when task_type = 'SUB_PROCESS' then 'process' else 'task' end as dst_kind, task_id as dst_id, '包含' as label
  from task
  union all
  select 'process', cast(process_id as varchar), 'process', cast(sub_id as varchar), '依赖'
  from task where task_type = 'SUB_PROCESS'
  union all
  select case when task_type = 'SUB_PROCESS' then 'process' else 'task' end, task_id,
         case when (other is not null and dep_task = 'ALL') or pre_is_sub then 'process' else 'task' end,
         case when other is not null and dep_task = 'ALL' then cast(def_id as varchar)
              when pre_is_sub then cast(pre_sub as varchar)
              when other is not null then def_id || '-' || dep_task else process_id || '-' || dep_task end, '依赖'
  from dependency)"""

_EDGE = """
edge as (select distinct e.* from raw_edge e
         where exists (select 1 from node n where n.kind = e.src_kind and n.id = e.src_id)
           and exists (select 1 from node n where n.kind = e.dst_kind and n.id = e.dst_id))"""


def _closure(form: str) -> str:
    return f"""with recursive {FX_DEF}, {NODES}, {form}, {_EDGE},
walk(kind, id, hop) as (
  select 'process', cast(process_id as varchar), 0 from rel where process_name = 'process_3'
  union
  select e.dst_kind, e.dst_id, w.hop + 1 from walk w join edge e on w.kind = e.src_kind and w.id = e.src_id
  where w.hop < 13)
select date '2024-01-26' as dt, cast(project_id as varchar) as project_id, cast(process_id as varchar) as process_id,
       task_id, project_name, process_name, task_name
from task where task_type = 'SHELL' and task_id in (select id from walk where kind = 'task' and hop > 0)"""


_RAW = _STRICT.replace("""
  from dependency)""", """
  from dependency
  union all
  select 'process', cast(process_id as varchar), 'process', cast(sub_id as varchar), '依赖'
  from task where task_type = 'SUB_PROCESS')""")

RELATION_FILES = f"""with {FX_DEF}, {_RAW}
select distinct src_id, label, dst_id, src_kind || '_' || dst_kind as name from raw_edge
union all select cast(process_id as varchar), null, null, 'process' from rel
union all select task_id, null, null, 'task' from task where task_type = 'SHELL'"""

_REJECTED = f"""with {FX_DEF}
select project_id, project_name, process_id, process_name from rel where process_id % 9 = 0"""


SQL = {
    "rejected_definitions": _REJECTED,
    "workflow_tasks": f"""with {FX_DEF}
select project_id, project_name, process_id, process_name, task_id, task_name, task_type from task""",
    "rejected_pre_tasks": f"""with {FX_DEF}
select w.project_id, w.project_name, w.process_id, w.process_name, w.task_name, w.pre_name as pre_task_name
from wanted w where not exists (
  select 1 from defined d where d.process_id = w.process_id and d.task_name = w.pre_name)""",
    "task_lineage_rows": f"with {FX_DEF} {_LINEAGE_ROWS}",
    "lineage_edges": f"with {FX_DEF}, {NODES}, {_STRICT}, {_EDGE} select * from edge",
    "lineage_edges_extended": f"with {FX_DEF}, {NODES}, {_EXTENDED}, {_EDGE} select * from edge",
    "mutual_edges": f"""with {FX_DEF}, {NODES}, {_EXTENDED}, {_EDGE}
select a.src_kind as one_kind, a.src_id as one_id, a.dst_kind as other_kind, a.dst_id as other_id, a.label
from edge a join edge b on a.src_kind = b.dst_kind and a.src_id = b.dst_id
  and a.dst_kind = b.src_kind and a.dst_id = b.src_id and a.label = b.label
where a.src_kind < a.dst_kind or (a.src_kind = a.dst_kind and a.src_id < a.dst_id)""",
    "edge_dedupe": f"with {FX_DEF}, {_EXTENDED} select distinct * from raw_edge",
    "upstream_closure": _closure(_STRICT),
    "upstream_closure_extended": _closure(_EXTENDED),
}
