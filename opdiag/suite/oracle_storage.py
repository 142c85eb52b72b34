"""DuckDB SQL for the file-listing queries.

Fixed values in it, which must equal the operators': the names of size and temperature classes and
their limits, the replication that marks a directory, and the pattern ``[1|2]`` of partition values.
"""

FX_FSIMAGE = """
fx_raw as (
  select l_orderkey as ok, l_linenumber as ln, l_partkey as pk, l_suppkey as sk,
         cast(cast(l_shipdate + interval 10 year as date) as varchar) as d,
         cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as k,
         case when l_linenumber = 7 then 0
              else cast(floor(l_extendedprice) as bigint) * cast(l_quantity as bigint) * 400 end as filesize
  from lineitem),
fx_one as (
  select case when ok = 0 then '/' when ok = 1 then 'Path'
              when ok % 10 < 6 then '/user/hive/warehouse/db' || (sk % 5) || '.db/tbl' || (pk % 20) || '/dt='
                   || (case pk % 4 when 0 then d when 1 then replace(d, '-', '')
                       when 2 then substr(d, 1, 7) else substr(replace(d, '-', ''), 1, 6) end)
                   || '/part-' || k
              when ok % 10 < 8 then '/user/u' || (sk % 7) || '/f-' || k
              when ok % 10 = 8 then '/tmp/f-' || k
              else '/data/d' || (pk % 4) || '/f-' || k end as path,
         cast(case ln % 5 when 0 then 0 when 1 then 3 when 2 then 2 when 3 then 16020 end as integer) as replication,
         cast(cast(date '2011-11-05' - cast((pk * 13 + ln) % 2600 as integer) as date) as varchar) || ' 08:00'
           as modificationtime,
         case when ok % 97 <> 0 then cast(cast(date '2011-11-05' -
              cast(case when ln = 1 then ok % 10 else (ok * 7 + ln) % 2600 end as integer) as date) as varchar)
              || ' 08:00' end as accesstime,
         cast(134217728 as bigint) as preferredblocksize, cast(ln as integer) as blockscount, filesize,
         cast(-1 as bigint) as nsquota, cast(-1 as bigint) as dsquota, '-rw-r--r--' as permission,
         'u' || (sk % 7) as username, 'g' as groupname, '20111105' as partition_key
  from fx_raw),
fx_ods_fsimage as (
  select * from fx_one
  union all select * from fx_one where blockscount = 3 and path like '/tmp%'),
fx_records as (
  select path, blockscount, accesstime, filesize, replication, modificationtime, preferredblocksize,
         nsquota, dsquota, permission, username, groupname,
         cast(if(coalesce(replication, 0) in (0, 16020), sum(filesize), cast(replication as bigint) * filesize)
              as bigint) as filesize_total
  from fx_ods_fsimage where partition_key = '20111105' and path <> 'Path'
  group by path, blockscount, accesstime, filesize, replication, modificationtime, preferredblocksize,
           nsquota, dsquota, permission, username, groupname),
fx_parts as (select *, string_split(path, '/') as s from fx_records),
flat as (
  select path, '/' || s[2] as p1, '/' || s[2] || '/' || s[3] as p2,
         '/' || s[2] || '/' || s[3] || '/' || s[4] as p3,
         '/' || s[2] || '/' || s[3] || '/' || s[4] || '/' || s[5] as p4,
         '/' || s[2] || '/' || s[3] || '/' || s[4] || '/' || s[5] || '/' || s[6] as p5,
         '/' || s[2] || '/' || s[3] || '/' || s[4] || '/' || s[5] || '/' || s[6] || '/' || s[7] as p6,
         '/' || s[2] || '/' || s[3] || '/' || s[4] || '/' || s[5] || '/' || s[6] || '/' || s[7] || '/' || s[8] as p7,
         blockscount, filesize_total, accesstime, filesize, replication, modificationtime, preferredblocksize,
         nsquota, dsquota, permission, username, groupname, '20111105' as partition_key
  from fx_parts)"""

CLASSED = FX_FSIMAGE + """,
aged as (select *, date_diff('day', cast(substr(accesstime, 1, 10) as date), date '2011-11-05') as age from flat),
classed as (
  select *, case when filesize / 1024 / 1024 >= 1024 then 'big_dir_pro'
                 when filesize / 1024 / 1024 >= 128 then 'med_dir_pro'
                 when filesize / 1024 / 1024 > 0 then 'sma_dir_pro'
                 when filesize = 0 then 'emp_dir_pro' end as file_ide,
            case when age <= 7 then 'heat_data_pro' when age <= 90 then 'warm_data_pro'
                 when age <= 365 then 'cold_data_pro' when age > 365 then 'ext_cold_data_pro' end as data_ide
  from aged)"""

_SIZES = ("big_dir_pro", "med_dir_pro", "sma_dir_pro", "emp_dir_pro")
_AGES = ("heat_data_pro", "warm_data_pro", "cold_data_pro", "ext_cold_data_pro")


def _counts() -> str:
    """One conditional count per class."""
    named = [("file_ide", n) for n in _SIZES] + [("data_ide", n) for n in _AGES]
    return ", ".join(f"count(*) filter ({column} = '{n}') as {n}" for column, n in named)


_BOTH_KNOWN = "having count(file_ide) > 0 and count(data_ide) > 0"


def _round(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(38,10)), {digits}) as double)"


def _shares(by: str, names: tuple[str, ...], column: str, where: str) -> str:
    cells = ", ".join(
        _round(f"cast(count(*) filter ({column} = '{n}') as double) / count(*)", 2) + f" as {n}"
        for n in names
    )
    return (
        f"with {CLASSED} select {by}, count(*) as file_cun, {cells} from classed "
        f"where {where} group by {by} having count({column}) > 0"
    )


_PARTITION_DATE = """
case when regexp_full_match(v, '[0-9]{6}') then v[1:4] || '-' || v[5:6] || '-01'
     when regexp_full_match(v, '[0-9]{4}-[0-9]{2}') then v || '-01'
     when regexp_full_match(v, '[0-9]{8}') then v[1:4] || '-' || v[5:6] || '-' || v[7:8]
     when regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') then v end"""

_TIMES = """
in_use as (select * from (select *, try_cast(accesstime || ':00' as timestamp) as a_time,
                                 try_cast(modificationtime || ':00' as timestamp) as m_time from flat)
           where p3 = '/user/hive/warehouse' and filesize > 0 and accesstime is not null and a_time is distinct from timestamp '1970-01-01 08:00:00')"""

SQL = {
    "fsimage_flatten": f"with {FX_FSIMAGE} select * from flat",
    "file_class_by_dir": f"""with {CLASSED}
select p1, file_ide, data_ide, count(*) as num,
       cast(cast(sum(filesize_total) as bigint) as double) / 1048576 as filesize_total
from classed where p1 <> '/' group by p1, file_ide, data_ide""",
    "dir_storage_report": f"""with {CLASSED}
select p1 as dir_name, '一级' as dir_level,
       cast(cast(sum(filesize_total) as bigint) as double) / 1099511627776 as storage_measure,
       count(*) as dir_size, {_counts()}, '20111105' as etl_dt
from classed where p1 <> '/' group by p1 {_BOTH_KNOWN}""",
    "warehouse_storage_report": f"""with {CLASSED}
select count(distinct p4) as db_count, count(distinct p5) as table_count,
       cast(cast(sum(filesize_total) as bigint) as double) / 1073741824 as storage_measure,
       count(*) as dir_size, {_counts()}, '20111105' as etl_dt
from classed where p3 = '/user/hive/warehouse' group by p3 {_BOTH_KNOWN}""",
    "user_storage_share": f"""with {FX_FSIMAGE},
owned as (select p2, filesize from flat where p1 = '/user' and p2 is not null),
per_user as (select p2, sum(filesize) as sto, count(*) as num from owned group by p2)
select p2 as user_name,
       {_round("cast(sto as double) / cast((select sum(filesize) from owned) as double)", 2)} as user_storage_pro,
       {_round("cast(num as double) / (select count(*) from owned)", 2)} as user_dir_pro, '20111105' as etl_dt
from per_user""",
    "small_file_ratio": _shares("p1", _SIZES, "file_ide", "p1 <> '/'"),
    "cold_data_ratio": _shares("p1", _AGES, "data_ide", "p1 <> '/'"),
    "small_file_ratio_table": _shares("p4, p5", _SIZES, "file_ide", "p3 = '/user/hive/warehouse'"),
    "cold_data_ratio_table": _shares("p4, p5", _AGES, "data_ide", "p3 = '/user/hive/warehouse'"),
    "stale_warehouse_files": f"""with {FX_FSIMAGE}, {_TIMES}
select path, username, groupname, filesize, accesstime, modificationtime, permission,
       regexp_extract(p5, '^/user/hive/warehouse/([^/.]*)', 1) as db,
       regexp_extract(p5, '([^/]*)$', 1) as tbl
from in_use where least(a_time, m_time) < timestamp '2006-11-05'
order by db, tbl, accesstime""",
    "old_partition_touched": f"""with {FX_FSIMAGE}, {_TIMES},
valued as (select *, regexp_extract(p6, '/[^/]+=([12][0-9-]*)$', 1) as v,
                  regexp_extract(p6, '/([^/]+)=([1|2].*)', 2) as partition_key
           from (select * exclude (partition_key) from in_use)),
dated as (select *, {_PARTITION_DATE} as partition_date from valued)
select path, username, groupname, filesize, accesstime, modificationtime, partition_key, partition_date
from dated
where starts_with(partition_key, '2') and greatest(a_time, m_time) > timestamp '2011-10-29'
  and try_cast(partition_date as date) < date '2006-11-05'""",
}
