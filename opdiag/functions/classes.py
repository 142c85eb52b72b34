"""Size and temperature classes of files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from opdiag.defaults import MIB

# Class names, which are also the report's column names.
SIZE_CLASSES = ("big_dir_pro", "med_dir_pro", "sma_dir_pro", "emp_dir_pro")
ACCESS_CLASSES = ("heat_data_pro", "warm_data_pro", "cold_data_pro", "ext_cold_data_pro")


def as_date(day: str | dt.date) -> Column:
    return F.lit(str(day)).cast("date")


def size_class(filesize: Column) -> Column:
    """At least 1 GiB, at least 128 MiB, above zero, zero; NULL for NULL or negative sizes."""
    return (
        F.when(filesize >= 1024 * MIB, SIZE_CLASSES[0])
        .when(filesize >= 128 * MIB, SIZE_CLASSES[1])
        .when(filesize > 0, SIZE_CLASSES[2])
        .when(filesize == 0, SIZE_CLASSES[3])
    )


def access_class(accesstime: Column, as_of: str | dt.date) -> Column:
    """Days since the last access: up to 7 (or in the future), 90, 365, more; NULL if unknown."""
    age = F.datediff(as_date(as_of), accesstime.try_cast("date"))
    return (
        F.when(age <= 7, ACCESS_CLASSES[0])
        .when(age <= 90, ACCESS_CLASSES[1])
        .when(age <= 365, ACCESS_CLASSES[2])
        .when(age > 365, ACCESS_CLASSES[3])
    )
