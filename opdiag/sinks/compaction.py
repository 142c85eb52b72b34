"""Merging the small files of a parquet folder to a byte target.

Sizes come from the files' metadata. Files below the target are packed in order of their names into
bins of about the target's size, each within one partition folder, and only they are rewritten, a
task per bin; large files are not touched. The rewritten files wait in a hidden folder until a
journal of the moves is complete. A run that breaks off before that has changed nothing; one that
breaks off later is finished by the next. Readers should not start while the moves are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opdiag.defaults import Ours
from opdiag.sinks.files import Files

#: Share of the target from which on a file counts as large enough.
ENOUGH = 0.75
_HIDDEN = "_compaction"
_MOVES = "bin bigint, folder string, file string"


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def small_files(
    spark: SparkSession, folder: str, file_bytes: int = Ours.FILE_BYTES
) -> DataFrame:
    """``file, folder, bytes, bin`` of the files that are to be merged; bins have two at least.

    Only files' metadata is read. A bin holds ``file_bytes`` at most, but for its last file.
    """
    files = (
        _stored(spark, folder).where(F.col("_metadata.file_size") < int(ENOUGH * file_bytes))
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .distinct().withColumn("folder", F.regexp_replace("file", "/[^/]+$", ""))
    )
    in_folder = Window.partitionBy("folder").orderBy("file")
    before = F.sum("bytes").over(in_folder) - F.col("bytes")
    packed = files.withColumn("part", F.floor(before / file_bytes))
    together = Window.partitionBy("folder", "part")
    return packed.withColumn("n", F.count(F.lit(1)).over(together)).where("n > 1").select(
        "file", "folder", "bytes", F.concat_ws("#", "folder", F.col("part").cast("string")).alias("bin")
    )


def _finish(spark: SparkSession, folder: str) -> None:
    """Makes the moves of the journal, if there is one; each may have been made before."""
    files, hidden = Files(spark, folder), f"{folder}/{_HIDDEN}"
    if files.exists(f"{hidden}/journal/_SUCCESS"):
        moves = spark.read.schema(_MOVES).json(f"{hidden}/journal").collect()
        for number in sorted({move.bin for move in moves}):
            own = [move for move in moves if move.bin == number]
            for staged in files.matching(f"{hidden}/staged/bin={number}/part-*"):
                # files of one task share their name
                name = staged.rsplit("/", 1)[1]
                files.move(staged, f"{own[0].folder}/bin-{number}-{name}")
            for move in own:
                files.delete(move.file)
    files.delete(hidden, folder=True)


def compact(
    spark: SparkSession, folder: str, file_bytes: int = Ours.FILE_BYTES
) -> tuple[int, int]:
    """Merges small files; returns how many went and how many took their place.

    The driver sees the names of small files, as it does whenever they are listed. A bin is written
    by one task, so files come out at about the target.
    """
    _finish(spark, folder)
    small = small_files(spark, folder, file_bytes).collect()
    if not small:
        return 0, 0
    numbers = {name: number for number, name in enumerate(sorted({row.bin for row in small}))}
    moves = spark.createDataFrame(
        [(numbers[row.bin], row.folder, row.file) for row in small], _MOVES
    )
    stored = _stored(spark, folder)
    above = set(folder.split("/"))
    below = [part for part in small[0].folder.split("/") if "=" in part and part not in above]
    partitions = {part.split("=")[0] for part in below}
    columns = [name for name in stored.columns if name not in partitions]
    rows = (
        stored.where(F.col("_metadata.file_size") < int(ENOUGH * file_bytes))
        .select(*columns, F.col("_metadata.file_path").alias("_file"))
        .join(moves.select(F.col("file").alias("_file"), F.col("bin").alias("_bin")), "_file")
        .drop("_file").withColumnRenamed("_bin", "bin")
    )
    hidden = f"{folder}/{_HIDDEN}"
    rows.repartition(max(len(numbers), 1), "bin").write.partitionBy("bin").parquet(f"{hidden}/staged")
    moves.coalesce(1).write.json(f"{hidden}/journal")
    _finish(spark, folder)
    return len(small), len(numbers)
