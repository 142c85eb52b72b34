"""Container state changes from resource-manager and node-manager log lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.functions.times import epoch_millis, parsed
from opdiag.schemas import CONTAINER_STATE

_CUT = "\u0001"

# The line formats.
_TIME = r"^(\d+-\d+-\d+\s\d+:\d+:\d+,\d+)"
_CONTAINER = r"container_{epoch}\d+_\d+_\d+_\d+"
_NODE_LINE = _TIME + r".*Container ({container}) transitioned from (\w+) to (\w+).*$"
_RESOURCE_LINE = _TIME + r".*({container}) Container Transitioned from (\w+) to (\w+).*$"
_STORED_LINE = _TIME + r".*Storing application with id (application_\d+_\d+).*$"
_FIRST_CONTAINER = "_01_000001"
_APPLICATION_FIELD = _CUT + r"application(_\d+_\d+)" + _CUT


def of_hour(lines: DataFrame, hour: str) -> DataFrame:
    """Lines whose time starts with ``yyyy-MM-dd HH``."""
    return lines.where(F.col("value").startswith(hour))


def _line(pattern: str, accept_epoch: bool) -> str:
    container = _CONTAINER.replace("{epoch}", r"(?:e\d+_)?" if accept_epoch else "")
    return pattern.replace("{container}", container)


def _changes(fields: DataFrame, zone: str, keep: Sequence[str]) -> DataFrame:
    """State changes from rows of ``f = [time, container, from, to]``."""
    container = F.col("f")[1]
    time = F.replace(F.col("f")[0], F.lit(","), F.lit("."))
    application = F.regexp_extract(container, r"container_((?:e\d+_)?)(\d+_\d+)_\d+_\d+", 2)
    return fields.where(F.size("f") == 4).select(
        F.concat(F.lit("application_"), application).alias("application_id"),
        container.alias("container_id"),
        F.col("f")[2].alias("from_state"),
        F.col("f")[3].alias("to_state"),
        time.alias("change_time"),
        epoch_millis(parsed(time), zone).alias("timestamp_ms"),
        "server_ip", *keep,
    ).select(*CONTAINER_STATE.names, *keep)


def nm_container_transitions(
    lines: DataFrame, zone: str = "UTC", accept_epoch: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Node-manager lines (``value``, ``server_ip``) as state changes; works on streams too.

    A cheap substring test drops most lines; one regex pass then cuts a line into its fields.
    ``accept_epoch`` also takes container ids with an epoch part; columns to ``keep`` stay.
    """
    cut = F.regexp_replace(
        "value", _line(_NODE_LINE, accept_epoch), _CUT.join(("$1", "$2", "$3", "$4"))
    )
    fields = lines.where(F.col("value").contains(" transitioned from ")).select(
        F.split(cut, _CUT).alias("f"), "server_ip", *keep
    )
    return _changes(fields, zone, keep)


def rm_container_transitions(
    lines: DataFrame, zone: str = "UTC", accept_epoch: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Resource-manager lines as state changes.

    Storing an application counts as INIT to NEW of its first container.
    """
    stored, moved = "Storing application with id ", " Container Transitioned from "
    started = F.regexp_replace("value", _STORED_LINE, _CUT.join(("$1", "$2", "INIT", "NEW")))
    cut = F.regexp_replace(
        started, _line(_RESOURCE_LINE, accept_epoch), _CUT.join(("$1", "$2", "$3", "$4"))
    )
    named = F.regexp_replace(
        cut, _APPLICATION_FIELD, f"{_CUT}container$1{_FIRST_CONTAINER}{_CUT}"
    )
    fields = lines.where(
        F.col("value").contains(stored) | F.col("value").contains(moved)
    ).select(F.split(named, _CUT).alias("f"), "server_ip", *keep)
    return _changes(fields, zone, keep)
