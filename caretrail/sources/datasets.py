"""Stored datasets that are kept current for a part of their keys.

A dataset lies in a fixed number of partitions by a hash of its key, so the rows of some keys are replaced by rewriting their partitions
only; the files of all others stay as they are. The new partitions are written aside in full first (staged) and then put in place by
Spark's dynamic partition overwrite. After a lost driver `recover` puts a complete staged write in place again, which gives the same
rows, and throws an incomplete one away; so the old rows are there until the new ones are safe. A staged write also keeps a second
writer out: it fails before it has changed anything. Readers see a partition as it was or as it is, not all partitions change at once.

The log is a dataset of its own that is only added to. A run's line says which span of source change times it took in: from the end
of the last run's span (or the fallback) up to the end its own caller fixed before reading, so a row that arrives during a run belongs to the next one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from caretrail.session import cut_lineage
from caretrail.sources.sinks import conform

LOG_SCHEMA = "logged timestamp, dataset string, run string, changed_from timestamp, changed_to timestamp, seconds double, rows_written bigint"
BEGINNING = datetime(1900, 1, 1)


class Datasets:
    """Datasets below one root folder."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 200):
        self.spark, self.root, self.parts = spark, root.rstrip("/"), parts

    # files

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _there(self, path: str) -> bool:
        place, files = self._files(path)
        return files.exists(place)

    def _remove(self, path: str) -> None:
        place, files = self._files(path)
        files.delete(place, True)

    def _folders(self, path: str) -> set[str]:
        place, files = self._files(path)
        return {s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()} if files.exists(place) else set()

    # partitions

    @property
    def part_column(self) -> str:
        """The number of partitions is in the column's name, so a dataset is never read or written with another one."""
        return f"part_of_{self.parts}"

    def part(self, key: Sequence[str]) -> Column:
        return F.pmod(F.hash(*key), F.lit(self.parts)).alias(self.part_column)

    def exists(self, name: str) -> bool:
        return self._there(f"{self.path(name)}/_SUCCESS")

    def read(self, name: str) -> DataFrame:
        return self._stored(name).drop(self.part_column)

    def _stored(self, name: str) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path(name)}.schema").schema  # a dataset may be without rows
        return self.spark.read.schema(schema.add(self.part_column, IntegerType())).parquet(self.path(name))

    def files(self, name: str) -> DataFrame:
        """(part, file) of every file with rows."""
        return self._stored(name).select(F.col(self.part_column).alias("part"), F.col("_metadata.file_path").alias("file")).distinct()

    # writing

    def create(self, name: str, df: DataFrame, key: Sequence[str]) -> int:
        """Write a whole dataset in place of what there is; returns the rows."""
        df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.path(name)}.schema")
        return self._publish(name, df, key, None)

    def replace(self, name: str, keys: DataFrame, new: DataFrame, key: Sequence[str]) -> int:
        """Rows of the given keys go, whether or not they come back in `new`, which holds rows of these keys only.

        Returns the rows of the partitions written.
        """
        stored = self._stored(name)
        keys = keys.select(*[F.col(k).cast(stored.schema[k].dataType).alias(k) for k in key])  # a hash is one of a type
        touched = [r[0] for r in keys.select(self.part(key)).distinct().collect()]  # at most as many as there are partitions
        if not touched:
            return 0
        kept = stored.filter(F.col(self.part_column).isin(touched)).drop(self.part_column)
        return self._publish(name, kept.join(keys, list(key), "left_anti").unionByName(conform(new, kept.schema)), key, touched)

    def _publish(self, name: str, df: DataFrame, key: Sequence[str], touched: list[int] | None) -> int:
        staged = f"{self.path(name)}.staged"
        which = self.spark.createDataFrame([(p,) for p in touched or range(self.parts)], "part int")
        which.coalesce(1).write.mode("errorifexists").parquet(f"{staged}/touched")
        out = df.withColumn(self.part_column, self.part(key))
        # Rebalanced by partition: small ones share a task, and one with a hot key is divided over several.
        out.hint("rebalance", self.part_column).write.mode("errorifexists").partitionBy(self.part_column).parquet(f"{staged}/rows")
        rows = self.spark.read.parquet(f"{staged}/rows").count() if self._folders(f"{staged}/rows") else 0  # told by the file footers
        self.recover(name)
        return rows

    def recover(self, name: str) -> None:
        """Put a complete staged write in place, or throw an incomplete one away. For the writer, or after one was lost."""
        staged, place, column = f"{self.path(name)}.staged", self.path(name), self.part_column
        if self._there(f"{staged}/rows/_SUCCESS"):
            filled = self._folders(f"{staged}/rows")
            if filled:
                rows = self.spark.read.parquet(f"{staged}/rows").hint("rebalance", column)
                rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(column).parquet(place)
            # Partitions that have lost all their rows are no part of what is written.
            touched = {f"{column}={r[0]}" for r in self.spark.read.parquet(f"{staged}/touched").collect()}
            for folder in (touched - filled) & self._folders(place):
                self._remove(f"{place}/{folder}")
            marker, files = self._files(f"{place}/_SUCCESS")
            files.create(marker, True).close()
        if self._there(staged):
            self._remove(staged)

    # the log

    @property
    def _log(self) -> str:
        return f"{self.root}/_runs"

    def log(self, name: str, run: str, changed_from: datetime, changed_to: datetime, seconds: float, rows: int) -> None:
        line = [(datetime.now(), name, run, changed_from, changed_to, float(seconds), int(rows))]
        self.spark.createDataFrame(line, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self._log)

    def runs(self, name: str) -> DataFrame:
        if not self._there(self._log):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self._log).filter(F.col("dataset") == name)

    def mark(self, name: str, fallback: datetime = BEGINNING) -> datetime:
        """Up to where the changes of the sources are taken in; the fallback before the first run."""
        return self.runs(name).agg(F.max("changed_to")).first()[0] or fallback

    def has_run(self, name: str, run: str) -> bool:
        return not self.runs(name).filter(F.col("run") == run).isEmpty()

    def bring_up_to(
        self,
        name: str,
        until: datetime,
        changed: Callable[[datetime, datetime], DataFrame],
        build: Callable[[DataFrame | None], DataFrame],
        key: Sequence[str] = ("person_id",),
        run: str | None = None,
        fallback: datetime = BEGINNING,
    ) -> int:
        """One run: rebuild the keys whose sources changed from the last mark up to `until`, or everything the first time.

        `changed(since, until)` gives keys, `build(keys)` their rows from the sources as they are now. The keys are written once, as they
        are read by every source of the rebuild and by the delete. A run that is already in the log does nothing, so a repeated one leaves the same files.
        """
        run = run or until.isoformat()
        if self.exists(name) and self.has_run(name, run):
            return 0
        start, since = time.monotonic(), self.mark(name, fallback)
        if not self.exists(name):
            rows = self.create(name, build(None), key)
        else:
            keys = cut_lineage(changed(since, until).select(*key).distinct())
            rows = self.replace(name, keys, build(keys), key)
        self.log(name, run, since, until, time.monotonic() - start, rows)
        return rows
