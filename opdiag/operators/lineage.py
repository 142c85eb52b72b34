"""Workflow definitions to tasks, dependency rows and lineage edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opdiag.defaults import Fixed
from opdiag.operators.sized import cut, dealt, join_lookup, written_parts
from opdiag.schemas import DEFINITION_JSON

EDGE = ["src_kind", "src_id", "dst_kind", "dst_id", "label"]
SHELL, SUB_PROCESS = "SHELL", "SUB_PROCESS"
_PROCESS = ["project_id", "project_name", "process_id", "process_name"]


def released_definitions(
    definitions: DataFrame,
    projects: DataFrame,
    dt: str,
    exclude_projects: Sequence[int] = Fixed.EXCLUDED_PROJECTS,
) -> DataFrame:
    """Released definitions updated up to ``dt``, with their project's name."""
    released = definitions.where(
        (F.col("release_state") == 1)
        & (F.left("update_time", F.lit(10)) <= dt)
        & ~F.col("project_id").isin(*exclude_projects)
    ).select(
        "project_id",
        F.col("id").alias("process_id"),
        F.col("name").alias("process_name"),
        "process_definition_json",
    )
    named = projects.select(F.col("id").alias("project_id"), F.col("name").alias("project_name"))
    return released.join(named, "project_id")


def _task_id(process_id: Column, task_name: Column) -> Column:
    return F.concat(process_id.cast("string"), F.lit("-"), task_name)


def rejected_definitions(definitions: DataFrame) -> DataFrame:
    """Released definitions whose JSON has no readable list of tasks."""
    document = F.from_json("process_definition_json", DEFINITION_JSON)
    return definitions.where(document["tasks"].isNull()).select(*_PROCESS, "process_definition_json")


def _defined_tasks(definitions: DataFrame) -> DataFrame:
    """Every task of every definition; of equally named ones the last counts.

    The last one is an aggregate that sorts a part of the tasks in memory, and tasks are many times
    larger than the stored definitions they come from. So the definitions are dealt out and read
    there, and the tasks go to a number of parts that adaptive execution does not merge again: a
    merged part is bounded by its compressed bytes only, and one task would sort several hundred MB.
    """
    document = F.from_json("process_definition_json", DEFINITION_JSON)
    documents = dealt(
        definitions.select(*_PROCESS, "process_definition_json"),
        "process_id", "process_definition_json",
    )
    # an inner explode would be tested before the deal as well, and every definition be read twice
    tasks = documents.select(
        *_PROCESS, F.posexplode_outer(document["tasks"]).alias("pos", "task")
    ).where("pos is not null").withColumn("task_name", F.col("task.name"))
    return (
        tasks.repartition(written_parts(definitions.sparkSession), "process_id", "task_name")
        .groupBy("process_id", "task_name")
        .agg(
            F.max_by(
                F.struct(
                    "project_id", "project_name", "process_name",
                    F.col("task.type").alias("task_type"),
                    F.col("task.params.processDefinitionId").alias("sub_process_id"),
                    F.col("task.preTasks").alias("pre_tasks"),
                    F.col("task.dependence.dependTaskList").alias("depends"),
                ),
                "pos",
            ).alias("t")
        )
        .select("process_id", "task_name", "t.*")
    )


def _with_id(tasks: DataFrame) -> DataFrame:
    """Shell and sub-process tasks; a sub-process task goes by the id of its sub-process."""
    own = _task_id(F.col("process_id"), F.col("task_name"))
    sub = F.col("sub_process_id").cast("string")
    return tasks.where(F.col("task_type").isin(SHELL, SUB_PROCESS)).withColumn(
        "task_id", F.when(F.col("task_type") == SUB_PROCESS, sub).otherwise(own)
    )


def workflow_tasks(definitions: DataFrame) -> DataFrame:
    """Shell and sub-process tasks of the definitions."""
    return _with_id(_defined_tasks(definitions)).select(*_PROCESS, "task_id", "task_name", "task_type")


def _dependencies(defined: DataFrame) -> DataFrame:
    """One row per dependency of a task, resolved through the preceding task's definition.

    A preceding task with a dependence list stands for the listed tasks of other workflows;
    otherwise the preceding task itself is meant.
    """
    wanted = _with_id(defined).withColumn("pre_name", F.explode("pre_tasks"))
    listed = F.flatten(F.transform("depends", lambda item: item["dependItemList"]))
    lookup = defined.select(
        "process_id",
        F.col("task_name").alias("pre_name"),
        # an object with an empty list is a dependence, on nothing
        F.col("depends").isNotNull().alias("external"),
        listed.alias("items"),
        (F.col("task_type") == SUB_PROCESS).alias("pre_is_sub"),
        F.col("sub_process_id").alias("pre_sub_id"),
    )
    # very many tasks may wait for one name
    found = join_lookup(wanted.drop("depends"), lookup, ["process_id", "pre_name"])
    # an internal dependency becomes a single item, so that one explode serves both forms
    nothing = F.lit(None)
    own = F.array(
        F.struct(
            nothing.cast("bigint").alias("projectId"),
            nothing.cast("bigint").alias("definitionId"),
            F.col("pre_name").alias("depTasks"),
        )
    )
    return found.withColumn(
        "item", F.explode(F.when(F.col("external"), F.col("items")).otherwise(own))
    ).drop("items", "pre_tasks")


def rejected_pre_tasks(definitions: DataFrame) -> DataFrame:
    """Preceding-task names that the workflow does not define."""
    defined = _defined_tasks(definitions)
    known = defined.select("process_id", F.col("task_name").alias("pre_task_name"))
    named = _with_id(defined).select(
        *_PROCESS, "task_name", F.explode("pre_tasks").alias("pre_task_name")
    )
    return join_lookup(named, known, ["process_id", "pre_task_name"], "left_anti").select(
        *_PROCESS, "task_name", "pre_task_name"
    )


def task_lineage_rows(definitions: DataFrame, dt: str) -> DataFrame:
    """One row per dependency, one without ``pre_`` values for a task that has none, and one per
    task that names its process as the dependent.

    A dependency on a whole workflow has no ``pre_task_id``.
    """
    # read three times below: the JSON is parsed once and the tasks are written down
    defined, _ = cut(_defined_tasks(definitions))
    item = F.col("item")
    other = item["projectId"].isNotNull()
    pre_process = F.when(other, item["definitionId"]).otherwise(F.col("process_id"))
    whole = other & (item["depTasks"] == "ALL")
    dependent = _dependencies(defined).select(
        *_PROCESS, "task_id", "task_name",
        F.when(other, item["projectId"]).otherwise(F.col("project_id")).alias("pre_project_id"),
        pre_process.alias("pre_process_id"),
        F.when(~whole, _task_id(pre_process, item["depTasks"])).alias("pre_task_id"),
        item["depTasks"].alias("pre_task_name"),
    )
    tasks = _with_id(defined)
    contained = F.struct(
        F.col("process_id").cast("string").alias("task_id"),
        F.col("process_name").alias("task_name"),
        F.col("project_id").alias("pre_project_id"),
        F.col("process_id").alias("pre_process_id"),
        F.col("task_id").alias("pre_task_id"),
        F.col("task_name").alias("pre_task_name"),
    )
    alone = F.struct(
        "task_id",
        "task_name",
        F.lit(None).cast("bigint").alias("pre_project_id"),
        F.lit(None).cast("bigint").alias("pre_process_id"),
        F.lit(None).cast("string").alias("pre_task_id"),
        F.lit(None).cast("string").alias("pre_task_name"),
    )
    free = F.coalesce(F.size("pre_tasks") <= 0, F.lit(True))
    fixed = tasks.select(
        *_PROCESS,
        F.explode(F.when(free, F.array(contained, alone)).otherwise(F.array(contained))).alias("r"),
    ).select(*_PROCESS, "r.*")
    return fixed.unionByName(dependent).select(
        "project_id", F.lit(dt).alias("dt"), "project_name", "process_id", "process_name",
        "task_id", "task_name", "pre_project_id", "pre_process_id", "pre_task_id", "pre_task_name",
    )


def _edge(src_kind, src_id, dst_kind, dst_id, label: str) -> Column:
    parts = (src_kind, src_id, dst_kind, dst_id, F.lit(label))
    return F.struct(*[part.cast("string").alias(name) for part, name in zip(parts, EDGE)])


def lineage_nodes(definitions: DataFrame, defined: DataFrame | None = None) -> DataFrame:
    """Node kinds and ids: every process and every shell task."""
    defined = _defined_tasks(definitions) if defined is None else defined
    tasks = _with_id(defined).where(F.col("task_type") == SHELL)
    return definitions.select(
        F.lit("process").alias("kind"), F.col("process_id").cast("string").alias("id")
    ).unionByName(tasks.select(F.lit("task").alias("kind"), F.col("task_id").alias("id")))


def all_edges(definitions: DataFrame, resolve: str = "strict") -> DataFrame:
    """Contains and depends-on edges as defined, whether or not their ends exist.

    ``raw`` names a sub-process task like any other and adds the edge from its process to the
    sub-process; ``strict`` leaves that edge out; ``extended`` puts the sub-process in its place.
    """
    return _edges_of(cut(_defined_tasks(definitions))[0], resolve)


def _edges_of(defined: DataFrame, resolve: str) -> DataFrame:
    if resolve not in ("raw", "strict", "extended"):
        raise ValueError(f"resolve must be raw, strict or extended, not {resolve!r}")
    process, task = F.lit("process"), F.lit("task")
    extended = F.lit(resolve == "extended")
    is_sub = F.col("task_type") == SUB_PROCESS
    own_kind = F.when(is_sub & extended, process).otherwise(task)

    tasks = _with_id(defined)
    contains = _edge(process, F.col("process_id"), own_kind, F.col("task_id"), Fixed.CONTAINS)
    to_sub = _edge(process, F.col("process_id"), process, F.col("sub_process_id"), Fixed.DEPENDS)
    within = tasks.select(
        F.explode(
            F.when(is_sub & F.lit(resolve != "strict"), F.array(contains, to_sub))
            .otherwise(F.array(contains))
        )
        .alias("e")
    )

    item = F.col("item")
    other = item["projectId"].isNotNull()
    whole = other & (item["depTasks"] == "ALL")
    to_pre_sub = extended & ~F.col("external") & F.col("pre_is_sub")
    pre_process = F.when(other, item["definitionId"]).otherwise(F.col("process_id"))
    dst_kind = F.when(whole | to_pre_sub, process).otherwise(task)
    dst_id = (
        F.when(whole, item["definitionId"].cast("string"))
        .when(to_pre_sub, F.col("pre_sub_id").cast("string"))
        .otherwise(_task_id(pre_process, item["depTasks"]))
    )
    depends = _dependencies(defined).select(
        _edge(own_kind, F.col("task_id"), dst_kind, dst_id, Fixed.DEPENDS).alias("e")
    )

    return within.unionByName(depends).select("e.*")


def lineage_edges(definitions: DataFrame, resolve: str = "strict") -> DataFrame:
    """Edges whose two ends exist, one per pair and label.

    ``strict`` knows process and shell-task nodes, so edges of sub-process tasks vanish.
    ``extended`` lets a sub-process task stand for its process, in both directions.
    """
    defined, _ = cut(_defined_tasks(definitions))
    nodes = lineage_nodes(definitions, defined)
    edges = edge_dedupe(_edges_of(defined, resolve))
    for end in ("src", "dst"):
        known = nodes.select(F.col("kind").alias(f"{end}_kind"), F.col("id").alias(f"{end}_id"))
        edges = edges.join(known, [f"{end}_kind", f"{end}_id"], "left_semi")
    return edges.select(*EDGE)


def edge_dedupe(edges: DataFrame) -> DataFrame:
    """One edge per direction, node pair and label."""
    return edges.select(*EDGE).dropDuplicates()


def mutual_edges(edges: DataFrame) -> DataFrame:
    """Node pairs that are connected in both directions under one label."""
    a, b = (
        F.struct(F.col(f"{end}_kind").alias("kind"), F.col(f"{end}_id").alias("id"))
        for end in ("src", "dst")
    )
    forward = a < b
    return (
        edges.where(a != b)
        .groupBy(F.least(a, b).alias("one"), F.greatest(a, b).alias("other"), "label")
        .agg(F.max(forward.cast("int")).alias("f"), F.max((~forward).cast("int")).alias("r"))
        .where((F.col("f") == 1) & (F.col("r") == 1))
        .select(
            F.col("one.kind").alias("one_kind"), F.col("one.id").alias("one_id"),
            F.col("other.kind").alias("other_kind"), F.col("other.id").alias("other_id"),
            "label",
        )
    )
