"""Expressions over slash-separated file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opdiag.defaults import Fixed

DEPTH = 7


def path_parts(path: Column) -> Column:
    """Segments of a path; the first one is what stands before the first slash."""
    return F.split(path, "/")


def path_prefix(parts: Column, level: int) -> Column:
    """The first ``level`` segments as a path; NULL when the path is shorter."""
    lead = F.array_join(F.slice(parts, 2, level), "/")
    return F.when(F.size(parts) > level, F.concat(F.lit("/"), lead))


def path_prefixes(parts: Column, depth: int = DEPTH) -> list[Column]:
    return [path_prefix(parts, k).alias(f"p{k}") for k in range(1, depth + 1)]


def split_at(text: Column, pattern: str, index: int) -> Column:
    """Piece ``index`` (0-based) of ``text`` split by a regex; NULL when out of range."""
    return F.get(F.split(text, pattern), F.lit(index))


def warehouse_db(table_path: Column) -> Column:
    """Database name of ``/user/hive/warehouse/<db>.db/<table>``."""
    return split_at(split_at(table_path, "/", 4), "[.]", 0)


def warehouse_table(table_path: Column) -> Column:
    return split_at(table_path, "/", 5)


# The four spellings of a partition value (yyyyMM, yyyy-MM, yyyyMMdd, yyyy-MM-dd).
_PARTITION_VALUE = (
    "/[^/]+=((?:1|2)(?:[0-9]{5}|[0-9]{3}-[0-9]{2}|[0-9]{7}|[0-9]{3}-[0-9]{2}-[0-9]{2}))$"
)


# Fixed value: how a partition's value begins. The bar is a member of the class, not an alternative.
LEAD = "[1|2]"


def partition_value(partition_path: Column, lead: str = LEAD) -> Column:
    """Text after ``name=`` when it starts with ``lead``, else an empty string."""
    return F.regexp_extract(partition_path, f"/([^/]+)=({lead}.*)", 2)


def partition_date_text(partition_path: Column) -> Column:
    """Partition value as ``yyyy-MM-dd`` text, whichever spelling it has, else NULL.

    Without dashes a value has six or eight digits; a missing day becomes 01. Each step refers to
    its input once, so the regex is not repeated when Catalyst moves the expression into a filter.
    """
    value = F.get(F.regexp_extract_all(partition_path, F.lit(_PARTITION_VALUE), F.lit(1)), F.lit(0))
    digits = F.substring(F.concat(F.replace(value, F.lit("-"), F.lit("")), F.lit("01")), 1, 8)
    return F.regexp_replace(digits, "^(....)(..)(..)$", "$1-$2-$3")


def in_warehouse(third_level: Column) -> Column:
    return third_level == Fixed.WAREHOUSE
