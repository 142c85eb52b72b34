"""Continuous collection of container state changes from log folders."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import StringType, StructField, StructType

from opdiag.schemas import CONTAINER_STATE
from opdiag.sources.logs import with_host

# Repeated lines, of one file or of rotated copies, agree in these columns.
IDENTITY = ["application_id", "container_id", "from_state", "to_state", "change_time", "server_ip"]


def stream_lines(
    spark: SparkSession, folder: str, name_glob: str = "*", files_per_batch: int | None = None
) -> DataFrame:
    """Lines of a growing log folder, with the host taken from the file name."""
    reader = spark.readStream.format("text").option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_host(reader.load(folder))


DAY = "day"


def published(
    spark: SparkSession, target: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Distinct collected changes, optionally of the days from ``since`` to ``until``.

    Repeats share their day, so a range of days reads only its partitions.
    """
    schema = StructType([*CONTAINER_STATE.fields, StructField(DAY, StringType())])
    rows = spark.read.schema(schema).parquet(target)
    if since is not None:
        rows = rows.where(F.col(DAY) >= since)
    if until is not None:
        rows = rows.where(F.col(DAY) <= until)
    return rows.dropDuplicates([*IDENTITY, DAY]).select(*CONTAINER_STATE.names)


def collect_changes(
    lines: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    once: bool = True,
    every: str = "1 hour",
) -> StreamingQuery:
    """Appends parsed changes to a parquet folder by day, each input file exactly once.

    No line is left out, however late its host delivers it: the query keeps no state and no
    watermark. ``published`` takes repeats away when the folder is read. ``once`` takes what has
    arrived since the last run and stops; otherwise the query runs on and triggers ``every`` so
    often.
    """
    day = F.left("change_time", F.lit(10)).alias(DAY)
    writer = (
        parse(lines).select(*CONTAINER_STATE.names, day)
        .writeStream.format("parquet").partitionBy(DAY)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


HORIZON_MS = 3_600_000  # how far back repeats are recognised, by event time
BUCKETS = 16  # parts that a host's containers are dealt out to
_STATE = "clock bigint, identities array<bigint>, times array<bigint>"
_FLAGGED = ", ".join(
    f"{field.name} {field.dataType.simpleString()}" for field in CONTAINER_STATE
) + f", late boolean, {DAY} string"


def first_seen(horizon_ms: int = HORIZON_MS):
    """Function of a keyed state that passes on each change once and flags late ones.

    The state is the newest event time of the key, its clock, and the identities of changes that are
    not older than the horizon before it. A change is late if it is older than the horizon before
    the clock that earlier batches have left; it can no longer be compared and passes on with
    ``late`` set, as does a change without a readable time. As the clock advances, identities behind
    the horizon are forgotten, so a state holds one horizon of changes.
    """

    def update(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clock, known, times = state.get if state.exists else (None, [], [])
        known, times = np.array(known, np.int64), np.array(times, np.int64)
        oldest = None if clock is None else clock - horizon_ms
        for frame in frames:
            at = frame["timestamp_ms"]
            late = at.isna() if oldest is None else at.isna() | (at < oldest)
            identity = frame["identity"].to_numpy()
            fresh = ~late & ~frame["identity"].duplicated() & ~np.isin(identity, known)
            if fresh.any():
                known = np.concatenate((known, identity[fresh]))
                times = np.concatenate((times, at[fresh].to_numpy(np.int64)))
                clock = max(int(times.max()), clock or 0)
            # a late line that another line of the frame repeats is one line
            frame = frame.assign(late=late)
            yield frame[fresh | (late & ~frame["identity"].duplicated())].drop(columns="identity")
        if clock is not None:
            kept = times >= clock - horizon_ms
            state.update((clock, known[kept].tolist(), times[kept].tolist()))

    return update


def distinct_changes(
    changes: DataFrame, horizon_ms: int = HORIZON_MS, part: Column | None = None
) -> DataFrame:
    """A stream of changes, each once, with ``late`` and the day; see ``first_seen``.

    The state is kept per host and ``part`` of its containers, so that a host with very many lines
    is spread. Lines of one container share a part.
    """
    part = part if part is not None else F.pmod(F.xxhash64("container_id"), F.lit(BUCKETS))
    keyed = changes.select(
        *CONTAINER_STATE.names, F.left("change_time", F.lit(10)).alias(DAY),
        F.xxhash64(*IDENTITY).alias("identity"),
        F.coalesce("server_ip", F.lit("")).alias("_host"), part.cast("string").alias("_part"),
    )
    return keyed.groupBy("_host", "_part").applyInPandasWithState(
        _in_order_of(first_seen(horizon_ms)), _FLAGGED, _STATE, "append", "NoTimeout"
    )


def _in_order_of(update):
    names = [*CONTAINER_STATE.names, "late", DAY]

    def apply(key, frames, state):
        for frame in update(key, frames, state):
            yield frame[names]

    return apply


def collect_distinct(
    lines: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    horizon_ms: int = HORIZON_MS,
    part: Column | None = None,
) -> StreamingQuery:
    """Appends what has arrived since the last run, without repeats, and stops.

    Late changes go to a part of the folder of their own. State and progress are kept in the
    checkpoint folder, so a restart goes on where the last run ended.
    """
    return (
        distinct_changes(parse(lines), horizon_ms, part)
        .writeStream.format("parquet").partitionBy("late", DAY)
        .option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def on_time(spark: SparkSession, target: str) -> DataFrame:
    """Changes that arrived in time, as collected: none is repeated."""
    return _flagged(spark, target).where("not late").select(*CONTAINER_STATE.names)


def late_changes(spark: SparkSession, target: str) -> DataFrame:
    """Changes that arrived late and are not among those in time: none is lost.

    Only here repeats are taken away on reading, from the late lines and the days they concern.
    """
    rows = _flagged(spark, target)
    late = rows.where("late").dropDuplicates([*IDENTITY, DAY])
    known = rows.where("not late").join(late.select(DAY).distinct(), DAY, "left_semi")
    same = [late[name].eqNullSafe(known[name]) for name in (*IDENTITY, DAY)]
    return late.join(known, same, "left_anti").select(*CONTAINER_STATE.names)


def _flagged(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(_FLAGGED).parquet(target)
