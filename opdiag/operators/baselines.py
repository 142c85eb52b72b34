"""Run baselines kept from day to day: the last runs of every task as a small state table.

A state has a row per task: process_id, task_name and ``last``, an array of its newest successful
runs in order of time. A day is judged from the state before it and the day's own runs; older runs
are never read again. Days are added in order of time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opdiag.defaults import Ours
from opdiag.functions.numbers import middle_of
from opdiag.operators.sized import join_lookup

TASK = ["process_id", "task_name"]
RUN = ["start_time", "attempt_id", "duration_s", "end_second"]
#: Parts that a task's runs of one hour are dealt out to before its last runs are chosen.
PARTS = 8


def successful(runs: DataFrame) -> DataFrame:
    """Runs that count, with the second of their own day at which they ended."""
    begun = F.timestamp_diff("SECOND", F.col("dt").cast("timestamp_ntz"), F.col("start_time"))
    return runs.where(F.col("state") == "SUCCESS").withColumn(
        "end_second", (begun + F.col("duration_s")).cast("bigint")
    )


def _newest(runs: DataFrame, count: int) -> DataFrame:
    """State of some runs: the newest ones of a task, in order of time.

    A task with a third of all runs is first cut down per hour and part, so that a task's list has
    ``count`` runs per hour and part at most.
    """
    part = F.pmod(F.xxhash64("attempt_id", F.lit(3)), F.lit(PARTS)).alias("_part")
    hour = F.date_trunc("hour", "start_time").alias("_hour")
    newest = Window.partitionBy(*TASK, "_hour", "_part").orderBy(
        F.desc("start_time"), F.desc("attempt_id")
    )
    last = F.sort_array(F.collect_list(F.struct(*RUN)), asc=False)
    return (
        runs.select(*TASK, *RUN, hour, part)
        .withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= count)
        .groupBy(*TASK).agg(F.reverse(F.slice(last, 1, count)).alias("last"))
    )


def state_of(runs: DataFrame, count: int = Ours.HISTORY_RUNS) -> DataFrame:
    """State after all of some runs; the beginning of the daily updates."""
    return _newest(successful(runs), count)


def _runs_of(state: DataFrame) -> DataFrame:
    return state.select(*TASK, F.explode("last").alias("run")).select(*TASK, "run.*")


def next_state(state: DataFrame, day: DataFrame, count: int = Ours.HISTORY_RUNS) -> DataFrame:
    """State after a further day; tasks that did not run keep theirs."""
    today = successful(day).select(*TASK, *RUN)
    return _newest(_runs_of(state).unionByName(today), count)


def _usual(state: DataFrame, today: DataFrame, value: str, count: int) -> DataFrame:
    """The day's runs with the median of ``value`` over the ``count`` runs before each.

    Runs are ordered within task and hour; an hour gets the last runs before it through a window
    with one short row per hour, where the state is the hour before all others.
    """
    order = ["start_time", "attempt_id"]
    hour = F.date_trunc("hour", "start_time").alias("_hour")
    rows = today.select("*", hour)
    per_hour = Window.partitionBy(*TASK, "_hour")
    back = F.row_number().over(per_hour.orderBy(*[F.desc(c) for c in order]))
    entry = F.struct(*order, value)
    last = (
        rows.withColumn("_back", back).where(F.col("_back") <= count)
        .groupBy(*TASK, "_hour").agg(F.sort_array(F.collect_list(entry)).alias("_last"))
    )
    kept = F.transform("last", lambda run: F.struct(run["start_time"], run["attempt_id"], run[value]))
    before_all = F.lit(None).cast("timestamp_ntz").alias("_hour")
    hours = last.unionByName(
        # only tasks with runs today are of interest
        state.join(last.select(*TASK).distinct(), TASK, "left_semi").select(
            *TASK, before_all, kept.cast(last.schema["_last"].dataType).alias("_last")
        )
    )
    chain = Window.partitionBy(*TASK).orderBy(F.col("_hour").asc_nulls_first()).rowsBetween(-count, -1)
    earlier = F.flatten(F.collect_list("_last").over(chain))
    carried = hours.select(*TASK, "_hour", earlier.alias("_c")).where("_hour is not null").select(
        *TASK, "_hour",
        F.explode(F.slice("_c", F.greatest(F.size("_c") - count, F.lit(0)) + 1, count)).alias("_c"),
    ).select(*TASK, "_hour", "_c.*", F.lit(False).alias("_own"))
    own = rows.select(*TASK, "_hour", *order, value, F.lit(True).alias("_own"))
    before = per_hour.orderBy("_own", *order).rowsBetween(-count, -1)
    usual = (
        own.unionByName(carried.select(*own.columns))
        .withColumn("_values", F.sort_array(F.collect_list(value).over(before)))
        .where("_own and size(_values) > 0")
        .select(*TASK, *order, middle_of(F.col("_values")).alias("usual"))
    )
    return join_lookup(today, usual, [*TASK, "attempt_id", "start_time"])


def _verdicts(judged: DataFrame, value: str, odd: Column, verdict: Column) -> DataFrame:
    return judged.where(odd).select(
        *TASK, "dt", "attempt_id", value, "usual", verdict.alias("verdict")
    )


def day_duration_anomalies(
    state: DataFrame,
    day: DataFrame,
    count: int = Ours.HISTORY_RUNS,
    high: float = Ours.DURATION_HIGH,
    low: float = Ours.DURATION_LOW,
) -> DataFrame:
    """Runs of a day far longer or shorter than the median of the task's preceding runs."""
    took, usual = F.col("duration_s"), F.col("usual")
    return _verdicts(
        _usual(state, successful(day), "duration_s", count), "duration_s",
        (took > high * usual) | (took < low * usual),
        F.when(took > usual, "long").otherwise("short"),
    )


def day_end_time_anomalies(
    state: DataFrame,
    day: DataFrame,
    count: int = Ours.HISTORY_RUNS,
    seconds: int = Ours.END_SHIFT_SECONDS,
) -> DataFrame:
    """Runs of a day that end far from the time at which the task's preceding runs ended."""
    shift = F.col("end_second") - F.col("usual")
    return _verdicts(
        _usual(state, successful(day), "end_second", count), "end_second",
        F.abs(shift) > seconds, F.when(shift > 0, "late").otherwise("early"),
    )
