"""The six delimited lineage relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Column names and delimiters of the relations.
RELATIONS: dict[str, tuple[str, list[str]]] = {
    "process": (",", ["project_id", "project_name", "process_id", "process_name"]),
    "task": ("#", ["project_id", "project_name", "process_id", "process_name", "task_id",
                   "task_name", "task_type"]),
    "process_task": (",", ["process_id", "relation", "task_id"]),
    "task_task": (",", ["task_id", "relation", "pre_task_id"]),
    "task_process": (",", ["task_id", "relation", "process_id"]),
    # the published header names both ends process_id; the second is told apart here
    "process_process": (",", ["process_id", "relation", "sub_process_id"]),
}


def schema_of(name: str) -> StructType:
    return StructType([StructField(column, StringType()) for column in RELATIONS[name][1]])


def lineage_relations(
    definitions: DataFrame, tasks: DataFrame, edges: DataFrame
) -> dict[str, DataFrame]:
    """Node and edge relations from the definitions, their tasks and their edges.

    Each relation is a pass over its input; write computed edges down before, for instance with
    ``sized.cut``.
    """
    frames = {
        "process": definitions.select(*RELATIONS["process"][1]),
        "task": tasks.where(F.col("task_type") == "SHELL").select(*RELATIONS["task"][1]),
    }
    for name in ("process_task", "task_task", "task_process", "process_process"):
        start, end = name.split("_")
        first, relation, last = RELATIONS[name][1]
        frames[name] = edges.where(
            (F.col("src_kind") == start) & (F.col("dst_kind") == end)
        ).select(
            F.col("src_id").alias(first), F.col("label").alias(relation), F.col("dst_id").alias(last)
        )
    return frames


def write_relations(frames: dict[str, DataFrame], folder: str) -> None:
    """One folder of header CSV files per relation."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").option("header", True).option("sep", RELATIONS[name][0]).csv(
            f"{folder.rstrip('/')}/{name}"
        )


def json_rows(rows: DataFrame) -> DataFrame:
    """Rows as JSON objects, the load format of stores that take JSON; NULL fields are left out."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
