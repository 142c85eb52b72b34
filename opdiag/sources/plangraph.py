"""Plans in Spark event logs as nodes, and which stages ran them.

An event that starts or re-plans an SQL execution carries the plan as a tree in JSON. Its nodes are
unfolded row by row, ``LEVELS`` levels at a time, without a shuffle; nodes deeper than that are taken
up by a further round. Every node names its metrics' accumulators, and every completed stage the
accumulators that its tasks have added to, which ties nodes to stages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.operators.sized import cut, dealt
from opdiag.schemas import APP_PLAN_NODE, STAGE_NODE
from opdiag.sources.eventlog import PLANNED, of_kind, parsed

LEVELS = 8
ROWS = "number of output rows"  # fixed value: the metric's name in plans

_METRICS = "array<struct<name: string, accumulatorId: bigint>>"
_STAGE = """
`Stage Info` struct<`Stage ID`: int, `Stage Attempt ID`: int,
  `Accumulables`: array<struct<`ID`: bigint, `Value`: string>>>
"""


def _children(level: str) -> str:
    """Nodes below those of a column; a node's path lists the child numbers from the root."""
    return (
        f"flatten(transform({level}, p -> transform("
        "coalesce(try_variant_get(p.node, '$.children', 'array<variant>'), array()), "
        "(c, i) -> struct(concat(p.path, '.', i) as path, c as node))))"
    )


def _described(level: str) -> str:
    """What is kept of the nodes of a column: not the subtrees, which every level would repeat."""
    fields = {
        "node": "'$.nodeName', 'string'", "detail": "'$.simpleString', 'string'",
        "partition_filters": "'$.metadata.PartitionFilters', 'string'",
        "metrics": f"'$.metrics', '{_METRICS}'",
    }
    got = ", ".join(f"try_variant_get(p.node, {where}) as {name}" for name, where in fields.items())
    return f"transform({level}, p -> struct(p.path as path, {got}))"


def plan_nodes(lines: DataFrame) -> DataFrame:
    """``APP_PLAN_NODE``: the nodes of all versions of a plan, one row per node and metric.

    A node that several versions share, with the same accumulators, is one node. Nodes without a
    metric have one row with a null ``accumulator``. Events without a readable plan have no nodes.
    """
    event = F.try_parse_json("value")
    # plans are many times larger than the files they are read from, so they are dealt out anew
    planned = dealt(of_kind(lines, *PLANNED).select("app_id", "value"), "app_id", "value")
    roots = planned.select("app_id", event.alias("event")).select(
        "app_id",
        F.try_variant_get("event", "$.executionId", "bigint").alias("execution_id"),
        # no node where there is no plan: as a filter of rows this would be tested before the deal as
        # well, and every plan be parsed twice
        F.expr(
            "filter(array(struct('0' as path, try_variant_get(event, '$.sparkPlanInfo', 'variant') as node)), "
            "p -> p.node is not null)"
        ).alias("level_0"),
    )
    found, deeper = [], roots
    while True:  # as many rounds as the deepest plan has times LEVELS
        rows = deeper
        for level in range(LEVELS):
            rows = rows.withColumn(f"level_{level + 1}", F.expr(_children(f"level_{level}")))
        unfolded, _ = cut(rows.select(
            "app_id", "execution_id",
            F.flatten(F.array(*[F.expr(_described(f"level_{level}")) for level in range(LEVELS)]))
            .alias("nodes"),
            F.col(f"level_{LEVELS}").alias("level_0"),
        ))
        found.append(unfolded.select("app_id", "execution_id", F.explode("nodes").alias("n")))
        deeper = unfolded.where("size(level_0) > 0").select("app_id", "execution_id", "level_0")
        if deeper.isEmpty():
            break

    nodes = reduce(DataFrame.unionByName, found).select(
        "app_id", "execution_id", "n.path", "n.node", "n.detail", "n.partition_filters",
        F.explode_outer("n.metrics").alias("metric"),
    )
    return nodes.select(
        "app_id", "execution_id", "path", "node", "detail", "partition_filters",
        F.col("metric.accumulatorId").alias("accumulator"), F.col("metric.name").alias("metric"),
    ).distinct().select(*APP_PLAN_NODE.names)


def stage_accumulators(lines: DataFrame) -> DataFrame:
    """Accumulators that the tasks of a completed stage attempt have added to, with their value."""
    info = F.col("Stage Info")
    return parsed(lines, "SparkListenerStageCompleted", _STAGE).select(
        "app_id", info["Stage ID"].alias("stage_id"),
        F.coalesce(info["Stage Attempt ID"], F.lit(0)).alias("stage_attempt"),
        F.explode(info["Accumulables"]).alias("a"),
    ).select(
        "app_id", "stage_id", "stage_attempt", F.col("a.ID").alias("accumulator"),
        F.col("a.Value").try_cast("bigint").alias("value"),
    )


def stage_nodes(nodes: DataFrame, accumulators: DataFrame) -> DataFrame:
    """``STAGE_NODE``: the plan nodes that a stage attempt ran, and the rows they put out.

    Both inputs have a row per accumulator; an accumulator belongs to one node.
    """
    # plans are alike, so files of millions of nodes have few bytes: the optimizer would take the nodes
    # for small, and adaptive execution does not give up a broadcast for a join that shuffles more
    ran = nodes.where("accumulator is not null").hint("merge").join(accumulators, ["app_id", "accumulator"])
    keys = ["app_id", "execution_id", "stage_id", "stage_attempt", "path", "node", "detail",
            "partition_filters"]
    rows = F.max(F.when(F.col("metric") == ROWS, F.col("value"))).alias("rows_out")
    return ran.groupBy(*keys).agg(rows).select(*STAGE_NODE.names)
