"""Bounded upstream closure over the lineage edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.defaults import Fixed
from opdiag.operators.sized import cut


def reachable(edges: DataFrame, starts: DataFrame, max_hops: int = Fixed.MAX_HOPS) -> DataFrame:
    """Nodes (``kind``, ``id``, ``hop``) first reached in 1 to ``max_hops`` directed hops.

    ``starts`` holds distinct ``kind``, ``id`` rows. Each round joins only the newest nodes with
    the edges and drops those seen before. Rounds are written to the shared folder, so the plan
    stays short and a lost executor costs no earlier round; the driver only learns how many nodes
    a round found.
    """
    links, _ = cut(
        edges.select(
            F.col("src_kind").alias("kind"), F.col("src_id").alias("id"), "dst_kind", "dst_id"
        )
    )
    newest, found = cut(starts.select("kind", "id", F.lit(0).alias("hop")))
    rounds = [newest]
    for hop in range(1, max_hops + 1):
        seen = reduce(DataFrame.unionByName, rounds).select("kind", "id")
        newest, found = cut(
            links.join(newest.select("kind", "id"), ["kind", "id"], "left_semi")
            .select(F.col("dst_kind").alias("kind"), F.col("dst_id").alias("id"))
            .distinct()
            .join(seen, ["kind", "id"], "left_anti")
            .withColumn("hop", F.lit(hop))
        )
        if found == 0:
            break
        rounds.append(newest)
    return reduce(DataFrame.unionByName, rounds).where(F.col("hop") > 0)


def upstream_closure(
    tasks: DataFrame,
    processes: DataFrame,
    edges: DataFrame,
    start_process: str,
    dt: str,
    max_hops: int = Fixed.MAX_HOPS,
) -> DataFrame:
    """Distinct tasks reachable from the processes of a name, stamped with ``dt``."""
    starts = (
        processes.where(F.col("process_name") == start_process)
        .select(F.lit("process").alias("kind"), F.col("process_id").cast("string").alias("id"))
        .distinct()
    )
    reached = (
        reachable(edges, starts, max_hops)
        .where(F.col("kind") == "task")
        .select(F.col("id").alias("task_id"))
    )
    return tasks.join(reached, "task_id", "left_semi").select(
        F.lit(dt).cast("date").alias("dt"),
        *[F.col(name).cast("string").alias(name)
          for name in ("project_id", "process_id", "task_id",
                       "project_name", "process_name", "task_name")],
    )
