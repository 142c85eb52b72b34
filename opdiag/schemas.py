"""Fixed schemas of the input and result relations. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _B, _D, _T = (
    StringType(), IntegerType(), LongType(), BooleanType(), DateType(), TimestampNTZType(),
)

# File listing, in the column order of the delimited listing file.
FSIMAGE_FILE = _struct(
    path=_S, replication=_I, modificationtime=_S, accesstime=_S, preferredblocksize=_L,
    blockscount=_I, filesize=_L, nsquota=_L, dsquota=_L, permission=_S, username=_S, groupname=_S,
)
PROJECT = _struct(id=_L, name=_S)
PROCESS_DEFINITION = _struct(
    id=_L, name=_S, project_id=_L, release_state=_I, update_time=_S, process_definition_json=_S,
)
DEFINITION_JSON = _struct(
    tasks=ArrayType(
        _struct(
            name=_S,
            type=_S,
            preTasks=ArrayType(_S),
            params=_struct(processDefinitionId=_L),
            dependence=_struct(
                dependTaskList=ArrayType(
                    _struct(
                        dependItemList=ArrayType(
                            _struct(projectId=_L, definitionId=_L, depTasks=_S)
                        )
                    )
                )
            ),
        )
    )
)
TASK_INSTANCE = _struct(
    id=_L, name=_S, process_definition_id=_L, process_instance_id=_L,
    submit_time=_T, start_time=_T, end_time=_T, retry_times=_I,
)
MONITORED_TASK = _struct(
    dt=_D, project_id=_S, process_id=_S, task_id=_S,
    project_name=_S, process_name=_S, task_name=_S, insert_time=_T,
)
DEPTASKS = _struct(
    project_name=_S, process_name=_S, task_name=_S, dt=_D,
    submit_time=_T, start_time=_T, end_time=_T,
    lastday_taken_minute=DecimalType(38, 2), taken_minute=DecimalType(38, 2),
    start_diff_second=_I, dod=DecimalType(38, 6), retry_times=_S, lastday_retry_times=_S,
)

CONTAINER_STATE = _struct(
    application_id=_S, container_id=_S, from_state=_S, to_state=_S,
    change_time=_S, timestamp_ms=_L, server_ip=_S,
)
QUERY_RECORD = _struct(
    query_id=_S, start_time=_T, end_time=_T, user=_S, time_used=_L,
    state=_S, error_message=_S, sql=_S, database=_S, plan=_S,
)

# Job, stage and task metrics, for Spark and MapReduce alike.
JOB_TASK = _struct(
    app_id=_S, stage_id=_I, kind=_S, executor_id=_S, launch_ms=_L, duration_ms=_L,
    input_bytes=_L, input_records=_L, speculative=_B, gc_ms=_L, cpu_ms=_L,
    peak_memory=_L, allocated_memory=_L, failure_reason=_S,
)
MR_TASK_ATTEMPT = JOB_TASK
APP_STAGE = _struct(
    app_id=_S, job_id=_I, execution_id=_L, stage_id=_I, stage_attempt=_I, submit_ms=_L, end_ms=_L,
)
# ``unit`` names what failed: a job, an SQL execution or an executor.
APP_FAILURE = _struct(app_id=_S, unit=_S, end_ms=_L, failure_reason=_S)
APP_JOB = _struct(app_id=_S, job_id=_I, execution_id=_L, submit_ms=_L, end_ms=_L)
APP_PLAN = _struct(app_id=_S, execution_id=_L, plan=_S)
# One row per node and metric; ``accumulator`` names the metric's counter.
APP_PLAN_NODE = _struct(
    app_id=_S, execution_id=_L, path=_S, node=_S, detail=_S, partition_filters=_S,
    accumulator=_L, metric=_S,
)
STAGE_NODE = _struct(
    app_id=_S, execution_id=_L, stage_id=_I, stage_attempt=_I, path=_S, node=_S, detail=_S,
    partition_filters=_S, rows_out=_L,
)
APP_EXECUTOR = _struct(app_id=_S, executor_id=_S, cores=_I, start_ms=_L, end_ms=_L)
APP_MEMORY = _struct(app_id=_S, driver_memory=_L, executor_memory=_L)
APP_BROADCAST = _struct(app_id=_S, execution_id=_L, bytes=_L)

WORKFLOW_RUN = _struct(
    process_id=_L, task_name=_S, dt=_D, attempt_id=_L, retry_times=_I,
    state=_S, start_time=_T, duration_s=_L,
)
TABLET = _struct(table_name=_S, partition_name=_S, tablet_id=_L, bytes=_L)
LOAD_JOB = _struct(table_name=_S, load_time=_T, bytes=_L)
