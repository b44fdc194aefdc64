"""Partitioned tables whose partitions are replaced or added to all at once, or not at all.

    <path>/version=<n>-<id>/<partitions>/*.parquet     rows
    <path>/_manifests/<n>-<id>[-all]/                  the partitions a version holds, and whether it adds to them

A write makes a version of its own and then a manifest of the partitions it touched,
which counts from the moment its ``_SUCCESS`` marker is there.  A partition is its newest
replacing version and the versions added after it.  Every ``ALL_EVERY`` writes the
manifest names all partitions, so that readers look at a few manifests only, and then
open the folders of the versions those name.  A writer that is lost leaves the table as
it was, and what it left behind is removed by a later one.  One writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructType

from tickbars.schemas import with_fields
from tickbars.session import files_of

KEPT_STATES = 2  # readers of the state before may still be at work
ALL_EVERY = 16
ALL = "-all"


@dataclass(frozen=True)
class VersionedTable:
    """A table at *path* with *schema* (partition columns, all strings, last)."""

    path: str
    schema: StructType
    partitions: tuple[str, ...]

    def _found(self, spark: SparkSession, pattern: str) -> list:
        """Paths below the table that match *pattern*, in order."""
        files, path = files_of(spark, f"{self.path}/{pattern}")
        return sorted((f.getPath() for f in files.globStatus(path) or []), key=lambda p: p.toString())

    def _committed(self, spark: SparkSession) -> list[str]:
        return [p.getParent().getName() for p in self._found(spark, "_manifests/*/_SUCCESS")]

    def _resolved(self, spark: SparkSession, names: list[str]) -> DataFrame:
        """Partitions and the versions that make them up, as of the last of the manifests *names*."""
        schema = StructType([self.schema[p] for p in self.partitions])
        schema = schema.add("version", StringType()).add("added", BooleanType())
        if not names:
            return spark.createDataFrame([], schema)
        since = max((i for i, n in enumerate(names) if n.endswith(ALL)), default=0)
        rows = spark.read.schema(schema).parquet(*[f"{self.path}/_manifests/{n}" for n in names[since:]])
        if since == len(names) - 1:
            return rows  # one manifest of all partitions is resolved already
        base = F.max(F.when(~F.col("added"), F.col("version")))
        pieces = F.collect_set(F.struct("version", "added"))
        parts = rows.groupBy(*self.partitions).agg(base.alias("_base"), pieces.alias("_pieces"))
        live = F.filter("_pieces", lambda v: v["version"] >= F.coalesce("_base", F.lit("")))
        return parts.select(*self.partitions, F.inline(live))

    def manifest(self, spark: SparkSession) -> DataFrame:
        """The partitions of the table, and the versions that hold each."""
        return self._resolved(spark, self._committed(spark))

    def _rows(self, spark: SparkSession, versions: list[str]) -> DataFrame:
        """The files of some versions, with the columns of the table and ``version``."""
        schema = with_fields(self.schema, version=StringType())
        folders = [f"{self.path}/version={v}" for v in versions]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.path).parquet(*folders)

    def read(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """The rows, or those of the partitions *where* holds (a condition on partition columns).

        Only folders of versions that hold such a partition are listed, and filters on
        partition columns skip directories within.  Empty when nothing was written.
        """
        rows, manifest = self._named(spark, where)
        return rows.join(manifest, [*self.partitions, "version"], "left_semi").select(*self.schema.names)

    def _named(self, spark: SparkSession, where: Column | None) -> tuple[DataFrame, DataFrame]:
        """The files of the versions that hold a wanted partition, and the manifest of those partitions."""
        manifest = self.manifest(spark)
        manifest = manifest if where is None else manifest.where(where)
        versions = sorted(r.version for r in manifest.select("version").distinct().collect())
        rows = self._rows(spark, versions)
        return (rows if where is None else rows.where(where)), manifest

    def pieces(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """:meth:`read` with ``pieces``: of how many versions the row's partition is made."""
        rows, manifest = self._named(spark, where)
        named = manifest.groupBy(*self.partitions).agg(
            F.collect_set("version").alias("_versions"), F.count(F.lit(1)).alias("pieces")
        ).select(*self.partitions, "pieces", F.explode("_versions").alias("version"))
        return rows.join(named, [*self.partitions, "version"]).select(*self.schema.names, "pieces")

    def replace(self, rows: DataFrame) -> None:
        """Put *rows* in the place of the partitions they belong to; other partitions stay.

        *rows* may read this table.  They are written in the order and
        distribution they have.
        """
        self._write(rows, added=False)

    def add(self, rows: DataFrame) -> None:
        """Add *rows* to the partitions they belong to; nothing that is there is read or written again."""
        self._write(rows, added=True)

    def _write(self, rows: DataFrame, added: bool) -> None:
        spark = rows.sparkSession
        names = self._committed(spark)
        started = [p.getName().removeprefix("version=") for p in self._found(spark, "version=*")]
        number = max((int(n.split("-")[0]) for n in [*names, *started]), default=0) + 1
        version = f"{number:010d}-{uuid.uuid4().hex[:12]}"
        rows.withColumn("version", F.lit(version)).write.mode("append").option("compression", "snappy").partitionBy(
            "version", *self.partitions
        ).parquet(self.path)
        if not self._found(spark, f"version={version}"):
            return  # no rows
        fresh = self._rows(spark, [version]).select(*self.partitions, "version").distinct().withColumn("added", F.lit(added))
        since = next((i for i, n in enumerate(reversed(names)) if n.endswith(ALL)), len(names))
        old = self._resolved(spark, names)
        touched = fresh.persist()  # found from the files once
        if not names or since >= ALL_EVERY or old.count() <= 2 * fresh.count():
            if not added:
                old = old.join(fresh.select(*self.partitions), list(self.partitions), "left_anti")
            fresh, version = old.unionByName(fresh), version + ALL
        fresh.write.parquet(f"{self.path}/_manifests/{version}")
        touched.unpersist()
        self._clean(spark, [*names, version])

    def _clean(self, spark: SparkSession, names: list[str]) -> None:
        """Remove manifests that no kept state needs, and versions that none of those names."""
        if not names[-1].endswith(ALL) or len(names) == 1:
            return
        states = [self._resolved(spark, names[: len(names) - i]).select("version") for i in range(min(KEPT_STATES, len(names)))]
        used = {r.version for r in reduce(DataFrame.unionByName, states).distinct().collect()}
        first = max((i for i, n in enumerate(names[: max(1, len(names) + 1 - KEPT_STATES)]) if n.endswith(ALL)), default=0)
        stale = [p for p in self._found(spark, "_manifests/*") if p.getName() not in names[first:]]
        stale += [p for p in self._found(spark, "version=*") if p.getName().removeprefix("version=") not in used]
        for path in stale:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
