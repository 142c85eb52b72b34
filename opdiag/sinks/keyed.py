"""Tables with a primary key whose changes are appended, merged when read, and folded now and then.

The base is bucketed and sorted by the key, changes lie beside it in small files. A change costs its
own size: no partition is read or rewritten for it. Reading joins base and changes by the key, which
moves the changes but not the base. ``fold`` writes base and changes into the next base. The key is
one text made of all key columns, in which NULL is a value like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.sinks.files import Files

BUCKETS = 64
_KEY = "_key"


class KeyedTable:
    """A keyed table at a location; ``name`` is the catalog name that its bases begin with."""

    def __init__(
        self, spark: SparkSession, name: str, location: str, keys: Sequence[str],
        version: str = "insert_time", buckets: int = BUCKETS,
    ):
        self.spark, self.name, self.location = spark, name, location.rstrip("/")
        self.keys, self.version, self.buckets = list(keys), version, buckets
        self._files = Files(spark, location)

    def _key(self) -> Column:
        return F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false"}).alias(_KEY)

    def _latest(self, rows: DataFrame, order: Sequence[str]) -> DataFrame:
        """One row per key, the highest in ``order``; combined before the shuffle."""
        rest = [name for name in rows.columns if name not in {_KEY, *order}]
        latest = F.max(F.struct(*order, *rest)).alias("latest")
        return rows.groupBy(_KEY).agg(latest)

    def generation(self) -> int:
        """Number of the base that counts: the newest that was written to its end."""
        done = self._files.matching(f"{self.location}/base/generation=*/_SUCCESS")
        return max((int(path.split("generation=")[1].split("/")[0]) for path in done), default=-1)

    def _base_name(self, generation: int) -> str:
        return f"{self.name}_base_{generation}"

    def _write_base(self, rows: DataFrame, generation: int) -> None:
        name = self._base_name(generation)
        self.spark.sql(f"drop table if exists {name}")
        path = f"{self.location}/base/generation={generation}"
        self._files.delete(path, folder=True)
        (
            rows.repartition(self.buckets, _KEY).write.format("parquet").option("path", path)
            .bucketBy(self.buckets, _KEY).sortBy(_KEY).saveAsTable(name)
        )

    def create(self, rows: DataFrame) -> None:
        """Writes the first base: the latest row per key."""
        kept = self._latest(rows.select(self._key(), "*"), [self.version])
        self._write_base(kept.select(_KEY, "latest.*").select(_KEY, *rows.columns), 0)

    def upsert(self, changes: DataFrame) -> None:
        """Appends the latest change per key."""
        base = self.generation()
        folder = f"{self.location}/changes/base={base}"
        loads = self._files.matching(f"{folder}/load=*")
        number = 1 + max((int(path.rsplit("=", 1)[1]) for path in loads), default=0)
        kept = self._latest(changes.select(self._key(), "*"), [self.version])
        kept.select(_KEY, "latest.*").write.parquet(f"{folder}/load={number}")

    def _pieces(self) -> tuple[DataFrame, DataFrame | None]:
        generation = self.generation()
        base = self.spark.table(self._base_name(generation))
        folder = f"{self.location}/changes/base={generation}"
        if not self._files.matching(f"{folder}/load=*/_SUCCESS"):
            return base, None
        # a load that broke off has no success mark
        done = [path.rsplit("/", 1)[0] for path in self._files.matching(f"{folder}/load=*/_SUCCESS")]
        changes = self.spark.read.schema(base.schema).option("basePath", folder).parquet(*done)
        load = F.regexp_extract("_metadata.file_path", r"/load=(\d+)/", 1).cast("int").alias("_load")
        return base, changes.select("*", load)

    def _merged(self) -> DataFrame:
        base, changes = self._pieces()
        if changes is None:
            return base
        new = self._latest(changes, [self.version, "_load"]).withColumnRenamed("latest", "new")
        old = base.select(_KEY, F.struct(*[name for name in base.columns if name != _KEY]).alias("old"))
        joined = old.hint("merge").join(new, _KEY, "full")
        names = [name for name in base.columns if name != _KEY]
        # on a tie the change replaces the row
        newer = F.col("new").isNotNull() & (
            F.col("old").isNull() | ~F.coalesce(
                F.col(f"old.{self.version}") > F.col(f"new.{self.version}"),
                F.col(f"new.{self.version}").isNull() & F.col(f"old.{self.version}").isNotNull(),
            )
        )
        return joined.select(_KEY, *[
            F.when(newer, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
            for name in names
        ])

    def read(self) -> DataFrame:
        """The latest row per key."""
        return self._merged().drop(_KEY)

    def fold(self) -> None:
        """Writes base and changes into the next base; readers see one or the other.

        The old base and its changes stay until the fold after this one.
        """
        generation = self.generation()
        self._write_base(self._merged(), generation + 1)
        older = generation - 1
        if older < 0:
            return
        self.spark.sql(f"drop table if exists {self._base_name(older)}")
        for path in (f"base/generation={older}", f"changes/base={older}"):
            self._files.delete(f"{self.location}/{path}", folder=True)
