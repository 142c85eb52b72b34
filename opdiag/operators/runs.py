"""Workflow-run diagnoses: day-over-day times, failures, and anomalies against history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opdiag.defaults import Fixed, Ours
from opdiag.functions.classes import as_date
from opdiag.functions.numbers import middle_of, ratio, round_half_up
from opdiag.functions.times import seconds_between
from opdiag.operators.sized import join_lookup

_NAMES = ["project_name", "process_name", "task_name"]


def named_instances(
    instances: DataFrame, definitions: DataFrame, projects: DataFrame
) -> DataFrame:
    """Task instances with process and project names."""
    processes = definitions.select(
        F.col("id").alias("process_definition_id"), F.col("name").alias("process_name"), "project_id"
    )
    named = projects.select(F.col("id").alias("project_id"), F.col("name").alias("project_name"))
    return (
        instances.withColumnRenamed("name", "task_name")
        .join(processes, "process_definition_id")
        .join(named, "project_id")
    )


def _before_cutoff(day: str, inclusive: bool, cutoff: str) -> Column:
    """Starts on ``day`` up to the cut-off, as a plain range that a scan can use.

    Times are cut to whole seconds first, so an inclusive limit covers its whole second.
    """
    midnight = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    limit = F.lit(f"{day} {cutoff}").cast("timestamp_ntz")
    if inclusive:
        limit = limit + F.expr("interval 1 second")
    return (F.col("start_time") >= midnight) & (F.col("start_time") < limit)


def first_attempts(named: DataFrame) -> DataFrame:
    """The first attempt per task name, with the minutes its whole instance took.

    Attempts are first folded per instance and then per task, both by aggregates that combine
    before the shuffle: a task with very many attempts is no hot spot. Attempts that start
    together are ordered by id.
    """
    order = F.struct("start_time", "id")
    instance = named.groupBy(*_NAMES, "process_instance_id").agg(
        F.min(
            F.struct("start_time", "id", "submit_time", "end_time", "retry_times")
        ).alias("first"),
        F.max_by("end_time", order).alias("last_end"),
    )
    earliest = F.min(F.struct("first", "last_end")).alias("a")
    taken = seconds_between(F.col("a.first.start_time"), F.col("a.last_end"))
    return (
        instance.groupBy(*_NAMES)
        .agg(earliest)
        .select(
            *_NAMES,
            *[F.col(f"a.first.{c}").alias(c)
              for c in ("submit_time", "start_time", "end_time", "retry_times")],
            round_half_up(taken / 60, 2).alias("taken_minute"),
        )
    )


def key_task_day_over_day(
    monitored: DataFrame,
    instances: DataFrame,
    definitions: DataFrame,
    projects: DataFrame,
    today: str,
    lastday: str,
    match_project: bool = False,
    cutoff: str = Fixed.CUTOFF,
) -> DataFrame:
    """Monitored tasks that start before the cut-off: their minutes against the previous day.

    The previous day's runs are found by task and process name alone, and may therefore fan out
    over projects; ``match_project`` adds the project.
    """
    named = named_instances(instances, definitions, projects)

    def of_day(day: str, inclusive: bool, keys: list[str]) -> DataFrame:
        attempts = first_attempts(named.where(_before_cutoff(day, inclusive, cutoff)))
        others = [c for c in _NAMES if c not in keys]
        watched = monitored.where(F.col("dt") == F.lit(day).cast("date")).select("dt", *_NAMES)
        return watched.join(attempts.drop(*others), keys)

    now = of_day(today, False, _NAMES)
    before = of_day(lastday, True, _NAMES if match_project else _NAMES[1:]).select(
        *_NAMES,
        F.col("start_time").alias("lastday_start_time"),
        F.col("taken_minute").alias("lastday_taken_minute"),
        F.col("retry_times").alias("lastday_retry_times"),
    )
    shift = seconds_between(F.col("lastday_start_time"), F.col("start_time")) - 86400
    change = ratio(
        F.col("taken_minute") - F.col("lastday_taken_minute"), F.col("lastday_taken_minute")
    )
    return now.join(before, _NAMES, "left").select(
        *_NAMES, "dt", "submit_time", "start_time", "end_time",
        "lastday_taken_minute", "taken_minute",
        shift.cast("int").alias("start_diff_second"),
        round_half_up(change, 4).alias("dod"),
        F.col("retry_times").cast("string").alias("retry_times"),
        F.col("lastday_retry_times").cast("string").alias("lastday_retry_times"),
    )


_INSTANCE = ["process_id", "task_name", "dt"]


def final_failures(runs: DataFrame) -> DataFrame:
    """Task instances whose last attempt failed."""
    last = F.max(F.struct("attempt_id", "state", "retry_times", "start_time", "duration_s"))
    return (
        runs.groupBy(*_INSTANCE)
        .agg(last.alias("last"))
        .where(F.col("last.state") == "FAILURE")
        .select(
            *_INSTANCE,
            *[F.col(f"last.{c}").alias(c)
              for c in ("attempt_id", "retry_times", "start_time", "duration_s")],
        )
    )


def first_failures(runs: DataFrame, retries: int = Fixed.FIRST_FAILURE_RETRIES) -> DataFrame:
    """Attempts that succeeded after more than ``retries`` retries."""
    return runs.where((F.col("state") == "SUCCESS") & (F.col("retry_times") > retries)).select(
        *_INSTANCE, "attempt_id", "retry_times", "start_time", "duration_s"
    )


def long_failures(
    runs: DataFrame, as_of: str | dt.date, days: int = Fixed.LONG_FAILURE_DAYS
) -> DataFrame:
    """Tasks with a final failure in the last ``days`` days, and on how many of them."""
    today = as_date(as_of)
    recent = runs.where((F.col("dt") > F.date_sub(today, days)) & (F.col("dt") <= today))
    return (
        final_failures(recent)
        .groupBy("process_id", "task_name")
        # one row per task and day remains, so rows are days
        .agg(F.count(F.lit(1)).alias("failed_days"), F.max("dt").alias("last_failed"))
    )


def long_running(runs: DataFrame, seconds: int = Fixed.LONG_RUN_SECONDS) -> DataFrame:
    """Attempts that ran longer than ``seconds``."""
    return runs.where(F.col("duration_s") > seconds).select(
        *_INSTANCE, "attempt_id", "state", "start_time", "duration_s"
    )


_TASK = ["process_id", "task_name"]


def _numbered(rows: DataFrame, value: str) -> DataFrame:
    return rows.select(
        *_TASK, F.date_trunc("hour", "start_time").alias("_hour"), "start_time", "attempt_id", value
    )


def _baseline(runs: DataFrame, value: str, count: int) -> DataFrame:
    """Per run the median of ``value`` over the ``count`` runs of the task before it, as ``usual``.

    Runs are ordered within their task and hour, so a task with a third of all runs is spread over
    its hours. What an hour needs from earlier ones, its last runs, is carried over: hours are
    chained by a window that has one short row per hour.
    """
    rows = _numbered(runs, value)
    order = ["start_time", "attempt_id"]
    hour = Window.partitionBy(*_TASK, "_hour")
    last = (
        rows.withColumn("_back", F.row_number().over(hour.orderBy(*[F.desc(c) for c in order])))
        .where(F.col("_back") <= count)
        .groupBy(*_TASK, "_hour")
        .agg(F.sort_array(F.collect_list(F.struct(*order, value))).alias("_last"))
    )
    # every hour in the table has a run, so ``count`` hours hold ``count`` runs
    chain = Window.partitionBy(*_TASK).orderBy("_hour").rowsBetween(-count, -1)
    carried = last.select(*_TASK, "_hour", F.flatten(F.collect_list("_last").over(chain)).alias("_c"))
    carried = carried.select(
        *_TASK, "_hour", F.explode(F.slice("_c", F.greatest(F.size("_c") - count, F.lit(0)) + 1, count))
        .alias("_c"),
    ).select(*_TASK, "_hour", "_c.*", F.lit(False).alias("_own"))
    before = hour.orderBy("_own", *order).rowsBetween(-count, -1)
    return (
        rows.withColumn("_own", F.lit(True)).unionByName(carried)
        .withColumn("_values", F.sort_array(F.collect_list(value).over(before)))
        .where("_own and size(_values) > 0")
        .withColumn("usual", middle_of(F.col("_values")))
        .select(*_TASK, "attempt_id", "start_time", "usual")
    )


def _judged(
    runs: DataFrame, since: str | None, until: str | None, history_days: int | None
) -> tuple[DataFrame, Column]:
    """Successful runs that matter for a range of days, and which of them are in the range."""
    day, wanted = F.col("dt"), F.lit(True)
    good = runs.where(F.col("state") == "SUCCESS")
    if until is not None:
        good, wanted = good.where(day <= as_date(until)), wanted & (day <= as_date(until))
    if since is not None:
        wanted = wanted & (day >= as_date(since))
        if history_days is not None:
            good = good.where(day >= F.date_sub(as_date(since), history_days))
    return good, wanted


def duration_anomalies(
    runs: DataFrame,
    count: int = Ours.HISTORY_RUNS,
    high: float = Ours.DURATION_HIGH,
    low: float = Ours.DURATION_LOW,
    since: str | None = None,
    until: str | None = None,
    history_days: int | None = Ours.HISTORY_DAYS,
) -> DataFrame:
    """Successful runs far longer or shorter than the median of the task's preceding runs.

    Days from ``since`` to ``until`` are judged, by default all. With ``history_days``
    only so many days before ``since`` are read; rare tasks then have fewer predecessors.
    """
    good, wanted = _judged(runs, since, until, history_days)
    took, usual = F.col("duration_s"), F.col("usual")
    return (
        join_lookup(
            good.where(wanted), _baseline(good, "duration_s", count),
            [*_TASK, "attempt_id", "start_time"],
        )
        .where((took > high * usual) | (took < low * usual))
        .select(
            *_INSTANCE, "attempt_id", "duration_s", "usual",
            F.when(took > usual, "long").otherwise("short").alias("verdict"),
        )
    )


def end_time_anomalies(
    runs: DataFrame,
    count: int = Ours.HISTORY_RUNS,
    seconds: int = Ours.END_SHIFT_SECONDS,
    since: str | None = None,
    until: str | None = None,
    history_days: int | None = Ours.HISTORY_DAYS,
) -> DataFrame:
    """Successful runs that end far from the time at which the task's preceding runs ended.

    An end is measured from the midnight of the run's own day, so that a run over midnight ends
    after 86,400 seconds. Ranges of days work as for ``duration_anomalies``.
    """
    good, wanted = _judged(runs, since, until, history_days)
    begun = F.timestamp_diff("SECOND", F.col("dt").cast("timestamp_ntz"), F.col("start_time"))
    good = good.withColumn("end_second", (begun + F.col("duration_s")).cast("bigint"))
    shift = F.col("end_second") - F.col("usual")
    return (
        join_lookup(
            good.where(wanted), _baseline(good, "end_second", count),
            [*_TASK, "attempt_id", "start_time"],
        )
        .where(F.abs(shift) > seconds)
        .select(
            *_INSTANCE, "attempt_id", "end_second", "usual",
            F.when(shift > 0, "late").otherwise("early").alias("verdict"),
        )
    )
