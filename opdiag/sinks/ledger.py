"""Loading files exactly once: rows and a ledger of what they came from, committed together.

A load writes its rows to a folder of its own and then an entry per file and part into the ledger.
A reader takes only rows that the ledger names, so rows of a load that broke off do not count, and
running a load again changes nothing. A *part* is what a file can be reloaded by, such as an hour.
Of several loads of a part the newest counts: when a file has grown, the parts with other row
counts than before are loaded again, and only these. One load runs at a time per target.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.operators.sized import cut

ENTRIES = "load bigint, file string, modified timestamp, until string, part string, n bigint"

Reader = Callable[[list[str]], DataFrame]


def listed(
    spark: SparkSession, folder: str, glob: str | None = None, modified_after: str | None = None
) -> DataFrame:
    """Files below a folder (file, modified, bytes), from the listing alone."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(folder).select(
        F.col("path").alias("file"), F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


def entries(spark: SparkSession, target: str) -> DataFrame:
    """Committed entries: one per file and load (``part`` is null), and one per part loaded."""
    nothing = spark.range(0).select(F.from_json(F.lit("{}"), ENTRIES).alias("e")).select("e.*")
    nothing.drop("load").write.mode("ignore").parquet(f"{target}/ledger/load=0")
    return spark.read.schema(ENTRIES).parquet(f"{target}/ledger")


def _newest(known: DataFrame) -> DataFrame:
    """Per file and part the load that counts, and its rows."""
    last = F.max(F.struct("load", "n")).alias("last")
    return known.where("part is not null").groupBy("file", "part").agg(last).select(
        "file", "part", "last.load", "last.n"
    )


def load_new(
    spark: SparkSession,
    found: DataFrame,
    read: Reader,
    target: str,
    until: str = "",
    partition_by: Sequence[str] = (),
    folder: str | None = None,
) -> int:
    """Loads files that are new, have changed, or were read up to a lower ``until`` only.

    ``read`` gets file names and returns rows with the columns ``file`` and ``part``; it may leave
    out parts beyond ``until``, which a later load with a higher one then finds. Returns the number
    of files read. The driver sees file names, as it does for any scan.

    ``folder`` is what ``found`` lists whole, if it does. The first load then reads it by this one
    name. A file that arrives meanwhile is read too: its entries name what was read of it, and the
    next load, which finds no version of it, compares its rows with them.
    """
    known = entries(spark, target)
    number = (known.agg(F.max("load")).first()[0] or 0) + 1
    if folder is not None and number == 1:
        files, n = cut(found.select("file", "modified"))
        if n:
            _commit(spark, read([folder]), files, target, number, until, partition_by)
        return n
    versions = known.where("part is null").groupBy("file", "modified").agg(
        F.max("until").alias("until")
    )
    done = versions.where(F.col("until") >= until).select("file", "modified")
    before = known.groupBy("file").agg(F.max("load").alias("load"))
    todo = (
        found.join(done, ["file", "modified"], "left_anti").join(before, "file", "left")
        .select("file", "modified", F.col("load").isNotNull().alias("again")).collect()
    )
    if not todo:
        return 0
    frames = []
    if fresh := [row.file for row in todo if not row.again]:
        frames.append(read(fresh))
    if again := [row.file for row in todo if row.again]:
        rows = read(again)
        was = _newest(known).select("file", "part", F.col("n").alias("was"))
        counts = rows.groupBy("file", "part").agg(F.count(F.lit(1)).alias("now"))
        changed, _ = cut(
            counts.join(was, ["file", "part"], "left").where("was is null or was <> now")
            .select("file", "part")
        )
        frames.append(rows.join(changed, ["file", "part"], "left_semi"))
    files = spark.createDataFrame(
        [(row.file, row.modified) for row in todo], "file string, modified timestamp"
    )
    whole = reduce(DataFrame.unionByName, frames)
    _commit(spark, whole, files, target, number, until, partition_by)
    return len(todo)


def _commit(
    spark: SparkSession,
    whole: DataFrame,
    files: DataFrame,
    target: str,
    number: int,
    until: str,
    partition_by: Sequence[str],
) -> None:
    """Writes a load's rows and then the entries of its files (file, modified) and their parts."""
    path = f"{target}/rows/load={number}"
    whole.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    parts = (
        spark.read.schema(whole.schema).parquet(path).groupBy("file", "part")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    none = F.lit(None)
    made = files.select(
        "file", "modified", F.lit(until).alias("until"), none.cast("string").alias("part"),
        none.cast("bigint").alias("n"),
    ).unionByName(parts.select(
        "file", none.cast("timestamp").alias("modified"), none.cast("string").alias("until"),
        "part", "n",
    ))
    made.coalesce(1).write.mode("overwrite").parquet(f"{target}/ledger/load={number}")


def loaded(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """Rows that the ledger names, with ``file`` and ``part``.

    ``schema`` is that of the rows with their partition columns. A committed load's entries name
    all of its rows, so its folder is read whole, and only rows that a later load has replaced are
    looked up; where no file has been loaded again there is no join.
    """
    whole = f"{schema}, file string, part string, load bigint"
    known = entries(spark, target).where("part is not null")
    loads = [row.load for row in known.select("load").distinct().collect()]
    if not loads:
        return spark.createDataFrame([], whole).drop("load")
    stored = spark.read.schema(whole).parquet(f"{target}/rows").where(
        F.col("load").isin(loads) & F.col("file").isNotNull() & F.col("part").isNotNull()
    )
    replaced, n = cut(
        known.groupBy("file", "part")
        .agg(F.max("load").alias("last"), F.collect_set("load").alias("loads"))
        .select("file", "part", F.explode(F.array_remove("loads", F.col("last"))).alias("load"))
    )
    if n:
        stored = stored.join(replaced, ["file", "part", "load"], "left_anti")
    return stored.drop("load")
